"""Snapshot merge with a defined keep-last rule (U1, operator part).

The existing rows in scope and the incoming delivery are unioned; per key the
last row in (sort columns nulls last, batch, seq) order wins, so an incoming
row beats an existing one on a tie and a later file row beats an earlier one.
Rows whose key is null are dropped.  The pick keeps one row per key and task before
the shuffle, so hot keys never concentrate in one task.

``merge_keyed`` gives the same for a table that is stored in buckets of its key: the
two sides are joined, so that only the delivery is shuffled, to the table's buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.operators.dedup import keep_last, nulls_last_key
from reportflow.operators.gates import date_prefix_predicate

BATCH, SEQ = "__batch", "__seq"


def _with_order(df: DataFrame, batch: int, seq: str | None, seq_type: str) -> DataFrame:
    s = F.col(f"`{seq}`") if seq and seq in df.columns else F.lit(None).cast(seq_type)
    return df.withColumns({BATCH: F.lit(batch), SEQ: s})


def merge_snapshot(existing: DataFrame | None, incoming: DataFrame, key: str,
                   sort_cols: Sequence[str], seq: str | None = None,
                   scope: str = "report_date", date_col: str | None = None,
                   report_date: str | None = None, on_create: str = "clean") -> DataFrame:
    """The new table content after merging ``incoming`` into ``existing``.

    ``scope='report_date'`` merges only existing rows whose ``date_col`` starts
    with ``report_date`` (rows of other dates leave the new snapshot);
    ``scope='all'`` merges the whole table.  With no existing table,
    ``on_create='as_is'`` stores the delivery untouched, ``'clean'`` applies
    the same keep-last and null-key rules.
    """
    cols = [c for c in incoming.columns if c != seq]
    seq_type = dict(incoming.dtypes)[seq] if seq else "bigint"
    if existing is None:
        if on_create == "as_is":
            return incoming.select(*[F.col(f"`{c}`") for c in cols])
        parts = _with_order(incoming, 1, seq, seq_type)
    else:
        if scope == "report_date":
            if not (date_col and report_date):
                raise ValueError("scope='report_date' needs date_col and report_date")
            existing = existing.where(date_prefix_predicate(existing, date_col, report_date))
        elif scope != "all":
            raise ValueError(f"unknown scope {scope!r}")
        parts = (_with_order(existing.select(*[F.col(f"`{c}`") for c in cols]), 0, None, seq_type)
                 .unionByName(_with_order(incoming, 1, seq, seq_type).select(*cols, BATCH, SEQ)))
    parts = parts.where(F.col(f"`{key}`").isNotNull())
    merged = keep_last(parts, [key], order_by=[*sort_cols, BATCH], seq=SEQ)
    return merged.select(*[F.col(f"`{c}`") for c in cols])


def merge_keyed(existing: DataFrame, incoming: DataFrame, key: str, sort_cols: Sequence[str],
                seq: str | None = None) -> DataFrame:
    """The content of ``merge_snapshot(..., scope='all')`` as a join on the key.

    Of each side the last row per key takes part; where both have one, the incoming
    row wins unless the existing one is later by the sort columns (nulls last).
    """
    cols = [c for c in incoming.columns if c != seq]
    old = keep_last(existing.select(*[F.col(f"`{c}`") for c in cols]).where(F.col(f"`{key}`").isNotNull()),
                    [key], order_by=sort_cols)
    new = keep_last(incoming.where(F.col(f"`{key}`").isNotNull()), [key], order_by=sort_cols, seq=seq)
    old = old.select(*[F.col(f"`{c}`").alias(f"__old{i}") for i, c in enumerate(cols)], F.lit(True).alias("__had"))
    new = new.select(*[F.col(f"`{c}`").alias(f"__new{i}") for i, c in enumerate(cols)], F.lit(True).alias("__has"))
    k = cols.index(key)
    both = old.join(new, F.col(f"__old{k}") == F.col(f"__new{k}"), "full")
    of = lambda side: nulls_last_key([F.col(f"__{side}{cols.index(c)}") for c in sort_cols])     # noqa: E731
    wins = F.col("__had").isNull() | (F.col("__has").isNotNull() & (of("new") >= of("old")))
    return both.select(*[F.when(wins, F.col(f"__new{i}")).otherwise(F.col(f"__old{i}")).alias(c)
                         for i, c in enumerate(cols)])
