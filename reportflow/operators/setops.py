"""Appends (V1, V2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append(*frames: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Union by column name; with ``allow_missing`` absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
