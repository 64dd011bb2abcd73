"""Running totals over groups of any size, as two levels of windows.

A plain ``sum(...) over (partition by group order by ...)`` sends a group to one
task.  Here every group is cut into ranges of the order (``position``, an
integer column that never falls along the order): totals per range are
aggregated first, the offsets of the ranges come from a window over those
totals, and a second window runs inside each range.  With about sqrt(n) ranges
both levels see about sqrt(n) rows at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shuffle_key(*parts: Column) -> Column:
    """A reproducible random order: md5 over the parts as text."""
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def key_range(key: Column, ranges: int) -> Column:
    """Which of ``ranges`` equal ranges of the md5 space a key lies in."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    return F.shiftright(head * F.lit(ranges).cast("bigint"), 32)


def range_count(rows: int) -> int:
    """About sqrt(rows) ranges: equal work for both levels."""
    return max(1, min(int(rows ** 0.5) + 1, 1 << 20))


def running_total(df: DataFrame, group: list[str], position: str, order: list,
                  value: str, out: str, extra: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the total of ``value`` over the group up to and with the row.

    ``extra`` (one row per group, keyed by ``group``) is joined to the totals
    per range, so that facts about a group reach its rows without a join on the
    group alone.
    """
    cells = df.groupBy(*group, position).agg(F.sum(value).alias("_cell"))
    before = W.partitionBy(*group) if group else W.partitionBy()
    before = before.orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("_offset", F.coalesce(F.sum("_cell").over(before), F.lit(0)))
    if extra is not None:
        cells = _join_null_safe(cells, extra, group)
    rows = _join_null_safe(df, cells.drop("_cell"), [*group, position])
    inside = W.partitionBy(*group, position).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(out, F.col("_offset") + F.sum(value).over(inside)).drop("_offset")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, "inner").drop(*[f"_r_{k}" for k in keys])
