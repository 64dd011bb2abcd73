"""Projection and composition."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_fixed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Select and reorder to a fixed list; a missing column is an error."""
    cols = list(columns)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map, all names at once; names absent from the frame are ignored."""
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, sep: str = "_") -> DataFrame:
    return df.toDF(*[f"{prefix}{sep}{c}" for c in df.columns])


def unprefix_columns(df: DataFrame, prefix: str, sep: str = "_") -> DataFrame:
    p = f"{prefix}{sep}"
    return df.toDF(*[c[len(p):] if c.startswith(p) else c for c in df.columns])


def stamp(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Provenance columns (region, report date, insert time) as literals."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v)
                           for k, v in values.items()})


def relabel(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Columns back to readable labels in a fixed order: ``(column, label)`` pairs."""
    return df.select(*[F.col(f"`{c}`").alias(label) for c, label in pairs])


def all_text(df: DataFrame) -> DataFrame:
    """Every column cast to text; nulls stay null."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*list(columns))
