"""Filters and gates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.functions.commands import CONFIG_ECHO


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``keys`` is null (F1)."""
    return df.na.drop(how="any", subset=list(keys))


def drop_matching(df: DataFrame, column: str, pattern: str = CONFIG_ECHO) -> DataFrame:
    """Drop rows whose ``column`` matches ``pattern``; nulls are kept (F2)."""
    return df.where(~F.coalesce(F.col(f"`{column}`").rlike(pattern), F.lit(False)))


def complete_row_gate(df: DataFrame, group: Sequence[str],
                      columns: Sequence[str] | None = None, few: bool = False) -> DataFrame:
    """Keep every row of a group iff at least one of its rows has no null.

    The per-group flag is a map-side-combined aggregate (one row per group)
    semi-joined back; with ``few`` groups (files) it is joined where the rows lie,
    so that no task holds a whole group.
    """
    group = list(group)
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in group]
    complete = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in cols])
    ok = (df.groupBy(*group).agg(F.max(complete.cast("int")).alias("__ok"))
          .where(F.col("__ok") == 1).drop("__ok"))
    return df.join(F.broadcast(ok) if few else ok, on=group, how="left_semi")


def _prefix_range(prefix: str):
    """Half-open [start, end) dates for a yyyy, yyyy-MM or yyyy-MM-dd prefix."""
    parts = prefix.split("-")
    try:
        if len(parts) == 1 and len(parts[0]) == 4:
            y = int(parts[0])
            return dt.date(y, 1, 1), dt.date(y + 1, 1, 1)
        if len(parts) == 2 and len(parts[1]) == 2:
            y, m = int(parts[0]), int(parts[1])
            return dt.date(y, m, 1), (dt.date(y + 1, 1, 1) if m == 12 else dt.date(y, m + 1, 1))
        if len(parts) == 3 and len(parts[2]) == 2:
            d = dt.date(int(parts[0]), int(parts[1]), int(parts[2]))
            return d, d + dt.timedelta(days=1)
    except ValueError:
        return None
    return None


def date_prefix_predicate(df: DataFrame, column: str, prefix: str) -> Column:
    """``column`` rendered as ``yyyy-MM-dd...`` starts with ``prefix``.

    On a text column this is ``startswith`` (pushed to Parquet as a prefix
    filter).  On a date or timestamp column a whole year/month/day prefix becomes
    a range predicate, which Parquet row-group statistics and partition pruning
    can use; any other prefix falls back to formatting the value.
    """
    c = F.col(f"`{column}`")
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return c.startswith(prefix)
    rng = _prefix_range(prefix)
    if rng is not None and isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        start, end = rng
        if isinstance(dtype, T.DateType):
            return (c >= F.lit(start)) & (c < F.lit(end))
        kind = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
        return ((c >= F.lit(start.isoformat()).cast(kind)) & (c < F.lit(end.isoformat()).cast(kind)))
    fmt = "yyyy-MM-dd" if isinstance(dtype, T.DateType) else "yyyy-MM-dd HH:mm:ss"
    return F.date_format(c, fmt).startswith(prefix)


def date_slice(df: DataFrame, column: str, prefix: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Projection plus date-prefix predicate (S9 + F5)."""
    out = df.where(date_prefix_predicate(df, column, prefix))
    return out.select(*[F.col(f"`{c}`") for c in columns]) if columns else out


# Gate comparison per report family.  Families not listed
# (NETWORKS, PKI and every generic report) accept only a strictly newer date.
INCLUSIVE_FAMILIES = ("WEEKPLAN", "EXTERNALS", "HCMD")


def watermark_gate(deliveries: DataFrame, last_success: DataFrame,
                   name: str = "report_name", oss: str = "oss",
                   date: str = "report_date") -> DataFrame:
    """Deliveries with ``last_date`` and an ``accepted`` flag.

    ``last_success`` is the output of ``ledger.last_success``.  No history
    accepts; otherwise the report date must be newer than the last successful
    date (or equal, for inclusive families).
    """
    d = deliveries.withColumns({
        "__name": F.upper(F.col(name)), "__oss": F.upper(F.col(oss))})
    ls = last_success.select(F.col("report_name").alias("__name"),
                             F.col("report_oss").alias("__oss"),
                             F.col("last_date"))
    joined = d.join(ls, on=["__name", "__oss"], how="left")
    inclusive = F.col("__name").isin(*INCLUSIVE_FAMILIES)
    rd = F.col(date)
    accepted = (F.col("last_date").isNull()
                | F.when(inclusive, rd >= F.col("last_date")).otherwise(rd > F.col("last_date")))
    return (joined.withColumn("accepted", F.coalesce(accepted, F.lit(False)))
            .drop("__name", "__oss"))
