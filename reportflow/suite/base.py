"""Registry of the suite queries, their DuckDB oracles and shared input recipes.

A *recipe* turns the supplied TPC-H-like tables into rows shaped like a report
(sites, cells, command logs, a ledger, ...).  Recipes only rename, re-type and
inject nulls; they are written once in the SQL subset Spark and DuckDB share,
with ``{table}`` placeholders.  Spark runs them with ``spark.sql(text,
table=DataFrame)``; the oracle inlines them as CTEs over the pre-registered
views.  The query itself then runs the library operator on the recipe output
(Spark) or its hand-written SQL equivalent (oracle).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.spec import DERIVED, ReportSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DOCS: dict[str, str] = {}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        DOCS[name] = (fn.__doc__ or "").strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def recipe(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a recipe in Spark with its ``{table}`` placeholders bound to Parquet scans."""
    names = set(_PLACEHOLDER.findall(sql))
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def reported(df: DataFrame, spec: ReportSpec, *others: DataFrame) -> DataFrame:
    """Recipe rows as a whole report: contract columns that the recipe leaves out (and ``others`` lack) are null."""
    have = {c for x in (df, *others) for c in x.columns}
    absent = [c.source for c in spec.columns if c.source != DERIVED and c.source not in have]
    return df.withColumns({c: F.lit(None).cast("string") for c in dict.fromkeys(absent)}) if absent else df


def duck(sql: str) -> str:
    """The recipe text for DuckDB (placeholders become the registered views)."""
    return _PLACEHOLDER.sub(r"\1", sql)


def with_ctes(ctes: dict[str, str], body: str) -> str:
    """``WITH name AS (recipe), ... body`` for an oracle."""
    parts = ",\n".join(f"{n} AS (\n{duck(s)}\n)" for n, s in ctes.items())
    return f"WITH {parts}\n{body}"


# ---- SQL spellings of the library's scalar rules, for the oracles -----------------

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def sql_sw_merge(h: str, s: str, p: str) -> str:
    """Oracle spelling of the software merge over three (already filled) fields."""
    chosen = (f"(CASE WHEN COALESCE({h},'UNKNOWN') <> 'UNKNOWN' THEN COALESCE({h},'UNKNOWN') "
              f"WHEN COALESCE({s},'UNKNOWN') <> 'UNKNOWN' THEN COALESCE({s},'UNKNOWN') "
              f"WHEN COALESCE({p},'UNKNOWN') <> 'UNKNOWN' THEN COALESCE({p},'UNKNOWN') END)")
    tok = f"regexp_extract({chosen}, '([vV]{WORD}*)', 1)"
    return (f"(CASE WHEN {chosen} IS NULL OR {tok} = '' THEN 'UNKNOWN' "
            f"ELSE regexp_replace({tok}, '(V{WORD}+)SP(\\p{{Nd}}+)', '\\1SPC\\2') END)")


def sql_digits(x: str) -> str:
    return f"regexp_replace({x}, '\\P{{Nd}}', '', 'g')"


def sql_strip_zeros(x: str) -> str:
    return f"regexp_replace({x}, '^0+', '')"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+\\z', '', 'g')"


def sql_key(*parts: str) -> str:
    return " || '-' || ".join(parts)
