"""Null-safe joins.

The report rules come from pandas, whose merges match a null key with a null
key.  Every join here therefore uses ``<=>`` (``eqNullSafe``), which Spark still
plans as an equi-join (hash or sort-merge), never as a nested loop.  Both sides
are aliased so that joining two slices of one table is unambiguous.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MERGE = "_merge"
L, R = "__l", "__r"


def _q(alias: str, c: str) -> Column:
    return F.col(f"{alias}.`{c}`")


def _cond(lk: Sequence[str], rk: Sequence[str]) -> Column:
    cond = None
    for a, b in zip(lk, rk, strict=True):
        c = _q(L, a).eqNullSafe(_q(R, b))
        cond = c if cond is None else cond & c
    return cond


def enrich(left: DataFrame, right: DataFrame, left_on: Sequence[str],
           right_on: Sequence[str], how: str = "full") -> DataFrame:
    """Join on differently named keys, both key columns kept.

    Column names of the two sides must not collide; select the side columns
    first.
    """
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"overlapping columns {sorted(overlap)}; select or rename first")

    def project(joined: DataFrame, _mode: str) -> DataFrame:
        return joined.select(*[_q(L, c).alias(c) for c in left.columns],
                             *[_q(R, c).alias(c) for c in right.columns])

    if how in ("full", "outer", "full_outer"):
        return _full_outer(left, right, left_on, project, right_on)
    return project(left.alias(L).join(right.alias(R), _cond(left_on, right_on), how), how)


def _key_col(k: str, how: str) -> Column:
    if how in ("full", "outer", "full_outer"):
        return F.coalesce(_q(L, k), _q(R, k)).alias(k)
    if how in ("right", "right_outer"):
        return _q(R, k).alias(k)
    return _q(L, k).alias(k)


def _suffix_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                 suffixes=("_x", "_y"), markers: bool = False) -> DataFrame:
    """Join on shared key names with coalesced keys and pandas-style suffixes."""
    lrest = [c for c in left.columns if c not in keys]
    rrest = [c for c in right.columns if c not in keys]
    clash = set(lrest) & set(rrest)
    if markers:
        left = left.withColumn("__in_l", F.lit(True))
        right = right.withColumn("__in_r", F.lit(True))

    def project(joined: DataFrame, mode: str) -> DataFrame:
        out = [_key_col(k, mode) for k in keys]
        out += [_q(L, c).alias(c + suffixes[0] if c in clash else c) for c in lrest]
        out += [_q(R, c).alias(c + suffixes[1] if c in clash else c) for c in rrest]
        if markers:
            in_l, in_r = _q(L, "__in_l").isNotNull(), _q(R, "__in_r").isNotNull()
            out.append(F.when(in_l & in_r, F.lit("both"))
                       .when(in_l, F.lit("left_only")).otherwise(F.lit("right_only"))
                       .alias(MERGE))
        return joined.select(*out)

    if how in ("full", "outer", "full_outer"):
        return _full_outer(left, right, keys, project)
    return project(left.alias(L).join(right.alias(R), _cond(keys, keys), how), how)


def _full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], project,
                right_keys: Sequence[str] | None = None) -> DataFrame:
    """Full outer join as (left outer join) + (right rows without a partner).

    Same rows as a full outer join, but both parts are joins whose large side
    AQE can split when a key is skewed (it cannot split a full outer join), and
    a filter on a left-side column later in the plan prunes the second part.
    """
    rk = list(right_keys) if right_keys is not None else list(keys)
    matched = left.alias(L).join(right.alias(R), _cond(keys, rk), "left")
    right_only = right.alias(R).join(left.alias(L), _cond(keys, rk), "left_anti")
    both = matched.select(*[_q(L, c).alias(f"__l_{c}") for c in left.columns],
                          *[_q(R, c).alias(f"__r_{c}") for c in right.columns])
    orphans = right_only.select(*[F.lit(None).cast(t).alias(f"__l_{c}") for c, t in left.dtypes],
                                *[_q(R, c).alias(f"__r_{c}") for c in right.columns])
    u = both.unionByName(orphans)
    # expose the two sides as structs named like the aliases, for the shared projection
    # (Catalyst folds the struct field accesses back into plain columns)
    sides = u.select(F.struct(*[F.col(f"`__l_{c}`").alias(c) for c in left.columns]).alias(L),
                     F.struct(*[F.col(f"`__r_{c}`").alias(c) for c in right.columns]).alias(R))
    return project(sides, "full")


def outer_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  how: str = "full") -> DataFrame:
    """Join on shared key names, keys coalesced, clashing names suffixed."""
    return _suffix_join(left, right, list(keys), how)


def natural_outer(left: DataFrame, right: DataFrame, how: str = "full") -> DataFrame:
    """Null-safe natural join on every common column, in left order."""
    rset = set(right.columns)
    keys = [c for c in left.columns if c in rset]
    if not keys:
        raise ValueError("no common columns")
    return _suffix_join(left, right, keys, how)


def diff_join(df1: DataFrame, df2: DataFrame, on: Sequence[str],
              which: str | None = None) -> DataFrame:
    """Rows of a full outer join with a ``_merge`` marker.

    ``which=None`` keeps rows found on exactly one side; otherwise one of
    ``left_only``, ``right_only``, ``both``.  One-sided requests are planned as
    an anti join (only the other side's keys are shuffled) instead of a full
    outer join, and ``None`` as the union of both anti joins.
    """
    keys = list(on)
    if which is None:
        # rows on exactly one side = left-only rows + right-only rows: two anti joins
        # (each shuffles only the other side's keys), no full join whose matches are discarded
        return (diff_join(df1, df2, keys, "left_only")
                .unionByName(diff_join(df1, df2, keys, "right_only")))
    if which == "both":
        return _suffix_join(df1, df2, keys, "inner", markers=True)
    if which not in ("left_only", "right_only"):
        raise ValueError(f"unknown which={which!r}")
    keep, other = (df1, df2) if which == "left_only" else (df2, df1)
    other_keys = other.select(*[F.col(f"`{k}`") for k in keys])
    kept = keep.alias(L).join(other_keys.alias(R), _cond(keys, keys), "left_anti")
    lrest = [c for c in df1.columns if c not in keys]
    rrest = [c for c in df2.columns if c not in keys]
    clash = set(lrest) & set(rrest)
    t1, t2 = dict(df1.dtypes), dict(df2.dtypes)
    out = [F.col(f"`{k}`") for k in keys]
    for c in lrest:
        v = F.col(f"`{c}`") if which == "left_only" else F.lit(None).cast(t1[c])
        out.append(v.alias(c + "_x" if c in clash else c))
    for c in rrest:
        v = F.col(f"`{c}`") if which == "right_only" else F.lit(None).cast(t2[c])
        out.append(v.alias(c + "_y" if c in clash else c))
    out.append(F.lit(which).alias(MERGE))
    return kept.select(*out)
