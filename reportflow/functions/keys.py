"""Key building (P5 composite keys, X4 composite cell identity)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def composite_key(*parts, sep: str = "-") -> Column:
    """Parts joined by ``sep``; a null part makes the whole key null.

    Deliberately ``concat`` and not ``concat_ws``: the latter skips nulls.
    """
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p))
    return F.concat(*cols)


def cell_identity(node, cell, factor: int = 256) -> Column:
    """``node * factor + cell`` over numeric text, as BIGINT text; null in, null out.

    ``try_cast`` is used on purpose: Spark does not fix the evaluation order of
    a plan, and a pushed-down predicate may evaluate this expression on rows a
    later filter removes (a report's own header row, for instance).  A failing
    ANSI cast there would abort a correct job.  Non-numeric ids therefore give
    null here; ``invalid_identity`` flags them for an explicit check.
    """
    n, c = _c(node).try_cast("bigint"), _c(cell).try_cast("bigint")
    return (n * F.lit(factor) + c).cast("string")


def invalid_identity(node, cell) -> Column:
    """True where a present id part is not an integer (the reference rejects such reports)."""
    def bad(x):
        return _c(x).isNotNull() & _c(x).try_cast("bigint").isNull()
    return bad(node) | bad(cell)
