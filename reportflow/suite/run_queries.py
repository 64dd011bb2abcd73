"""Whole runs with awkward deliveries: same-named generic reports, bad and re-sent deliveries,
quoted line breaks.  Report files are laid down from the supplied tables; expected columns are
spelled out in the oracles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from reportflow.plans.ingest import Warehouse, ingest
from reportflow.session import scratch_path
from reportflow.sources.reports import scan_reports
from reportflow.suite import landing
from reportflow.suite.base import duck, query, recipe, sql_key, with_ctes
from reportflow.suite.files import CELL_REPORT_COLS, CELLS_2G

NOW = dt.datetime(2024, 1, 2, 6, 0, 0)
REGIONS = ["REGION_A", "REGION_B"]


def _land(spark, d, rows_sql, cols, preamble=()):
    base = scratch_path(spark, "run")
    lines = landing.report_lines(recipe(spark, d, rows_sql), "file", "line_no", cols, ",", list(preamble),
                                 ",".join(cols))
    landing.write_files(spark, lines, f"{base}/landing")
    return base


def _run(spark, base, *deliveries):
    subjects = spark.createDataFrame([(s, f"{base}/landing/{f}", i) for i, (s, f) in enumerate(deliveries)],
                                     "subject string, folder string, arrival long")
    ingest(spark, subjects, f"{base}/warehouse", REGIONS, NOW)


# ---- two regions, two runs, one file name ------------------------------------------------------

PLAN_ROWS = """
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END || '/plan-' || CAST(o_custkey % 4 DIV 2 AS STRING)
       || '.csv' AS file, o_orderkey AS line_no, CAST(o_orderkey AS STRING) AS week,
       o_orderpriority AS owner, o_orderstatus AS state
FROM {orders}
"""


def q_generic_regions(spark, d):
    """R20+U2: generic reports of two regions with the same file names, in two runs: all rows stay."""
    base = _land(spark, d, PLAN_ROWS, ["week", "owner", "state"])
    for region in "AB":
        _run(spark, base, (f"[Report][REGION_{region}][Rota][2024-01-02]", region))
    rows = spark.read.parquet(Warehouse(f"{base}/warehouse").append_path("rota"))
    return rows.select("week", "owner", "state", "oss", "source_file",
                       F.col("report_date").cast("string").alias("report_date"))


query("q_generic_regions", """
SELECT CAST(o_orderkey AS VARCHAR) AS week, o_orderpriority AS owner, o_orderstatus AS state,
       CASE WHEN o_custkey % 2 = 0 THEN 'REGION_A' ELSE 'REGION_B' END AS oss,
       'plan-' || CAST((o_custkey % 4) // 2 AS VARCHAR) || '.csv' AS source_file, '2024-01-02' AS report_date
FROM orders""")(q_generic_regions)

# ---- a good, a bad and a re-sent delivery ----------------------------------------------------------

REGION_CELLS = CELLS_2G.replace(
    "SELECT o_orderkey AS _seq,",
    "SELECT CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END || '/2G_Cell_List.csv' AS file,\n"
    "  o_orderkey AS line_no, o_orderkey AS _seq,", 1)


def q_partial_failure(spark, d):
    """R21+U3: one region is good; the other lacks a contract column, is logged 500 and sent again.

    Ledger rows with the number of cells that the table then holds for the region.
    """
    base = _land(spark, d, REGION_CELLS, CELL_REPORT_COLS, ["2G cell export"])
    short = [c for c in CELL_REPORT_COLS if c != "bsc_name"]
    bad = landing.report_lines(recipe(spark, d, REGION_CELLS).where("file LIKE 'b/%'").withColumn(
        "file", F.regexp_replace("file", "^b/", "bad/")), "file", "line_no", short, ",", ["2G cell export"],
        ",".join(short))
    landing.write_files(spark, bad, f"{base}/landing")
    _run(spark, base, ("[Report][REGION_A][NETWORKS][2024-01-02]", "a"),
         ("[Report][REGION_B][NETWORKS][2024-01-02]", "bad"), ("[Report][REGION_B][NETWORKS][2024-01-02]", "b"))
    wh = Warehouse(f"{base}/warehouse")
    held = wh.table(spark, "huawei_2g_cell").read().groupBy(F.col("huawei_2g_cell_oss").alias("report_oss")).agg(
        F.count(F.lit(1)).alias("cells"))
    return (wh.ledger(spark).read().join(held, "report_oss")
            .select("report_name", "report_oss", "error_code", "description", "cells"))


query("q_partial_failure", with_ctes({"c": CELLS_2G}, f"""
, r AS (SELECT *, o.o_custkey % 2 AS region
        FROM c JOIN (SELECT o_orderkey, o_custkey FROM orders) o ON c._seq = o.o_orderkey)
, k AS (SELECT region, bsc_name || '-' || ({sql_key('mcc', 'mnc', 'cell_lac', 'cell_ci')}) AS unique_id FROM r)
, w AS (SELECT unique_id, max(region) AS region FROM k WHERE unique_id IS NOT NULL GROUP BY 1)
, n AS (SELECT region, count(*) AS cells FROM w GROUP BY 1)
SELECT 'NETWORKS' AS report_name, CASE WHEN region = 0 THEN 'REGION_A' ELSE 'REGION_B' END AS report_oss,
       '200' AS error_code, '' AS description, cells FROM n
UNION ALL
SELECT 'NETWORKS', 'REGION_B', '500', 'Code Bug', cells FROM n WHERE region = 1"""))(q_partial_failure)

# ---- line breaks inside quotes ------------------------------------------------------------------------

NOTE_ROWS = """
SELECT 'notes-' || CAST(o_custkey % 3 AS STRING) || '.csv' AS file, o_orderkey AS line_no,
       CAST(o_orderkey AS STRING) AS id,
       CASE WHEN o_orderkey % 5 = 0 THEN 'first, line' || chr(10) || 'second "line"' || chr(10) || chr(10) || o_orderpriority
            ELSE o_orderpriority END AS note, o_orderstatus AS state
FROM {orders}
"""


def q_scan_multiline(spark, d):
    """Quoted fields with line breaks, quotes and delimiters, in files read by several tasks."""
    base = _land(spark, d, NOTE_ROWS, ["id", "note", "state"], ["Notes"])
    return scan_reports(spark, f"{base}/landing", preamble=1).select("id", "note", "state", "_file")


query("q_scan_multiline", f"""
SELECT id, note, state, file AS _file FROM ({duck(NOTE_ROWS)})""")(q_scan_multiline)
