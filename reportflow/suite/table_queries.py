"""Tables and outputs over several runs: dated snapshots, changing columns, the ledger in segments,
ordered exports, archived deliveries.  Inputs are recipes over the supplied tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from reportflow.operators.gates import date_slice
from reportflow.plans import pipelines
from reportflow.plans import specs as S
from reportflow.plans.ingest import Warehouse, ingest
from reportflow.session import scratch_path
from reportflow.sinks.export import write_export
from reportflow.sinks.ledger import LedgerTable
from reportflow.sinks.snapshot import KeyedTable, SnapshotTable, read_append
from reportflow.sources.reports import scan_reports
from reportflow.suite import landing
from reportflow.suite.base import ORACLES, query, recipe, reported, sql_key, with_ctes
from reportflow.suite.files import CELL_REPORT_COLS, CELLS_2G
from reportflow.suite.ledger_queries import LEDGER, TODAY
from reportflow.suite.relational import EXISTING, INCOMING
from reportflow.suite.run_queries import REGION_CELLS, REGIONS

NOW = dt.datetime(2024, 1, 2, 6, 0, 0)
CELL = "huawei_2g_cell_"
UNIQUE = f"bsc_name || '-' || ({sql_key('mcc', 'mnc', 'cell_lac', 'cell_ci')})"

# ---- snapshots by report date ------------------------------------------------------------------

DATED_CELLS = CELLS_2G.replace("SELECT o_orderkey AS _seq,", "SELECT o_orderkey % 3 AS day, o_orderkey AS _seq,", 1)
DAYS = ("2024-01-02", "2024-01-03", "2024-02-01")


def q_dated_slices(spark, d):
    """S9+F5+D4: cells of three report dates in one table; two of the dates read by partition."""
    tbl = SnapshotTable(spark, scratch_path(spark, "tables", "dated"))
    cells = reported(recipe(spark, d, DATED_CELLS), S.CELL_2G)
    for i, day in enumerate(DAYS):
        staged = pipelines.cell_2g(cells.where(F.col("day") == i).drop("day"), "REGION_A", day)
        pipelines.load(staged, tbl, report_date=day)
    rows = date_slice(tbl.read_dates(), "report_date", "2024-01")
    return rows.select(F.col(f"{CELL}unique_id").alias("unique_id"), F.col(f"{CELL}name").alias("name"),
                       F.col(f"{CELL}update_date").alias("update_date"),
                       F.col("report_date").cast("string").alias("report_date"))


query("q_dated_slices", with_ctes({"c": DATED_CELLS}, f"""
, k AS (SELECT *, {UNIQUE} AS unique_id,
               CASE day WHEN 0 THEN '{DAYS[0]}' WHEN 1 THEN '{DAYS[1]}' END AS report_date
        FROM c WHERE day < 2)
SELECT unique_id, cell_name AS name, report_date AS update_date, report_date
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id, report_date
                           ORDER BY routing_area IS NULL DESC, routing_area DESC, _seq DESC) = 1"""))(q_dated_slices)

# ---- a table in buckets of its key -----------------------------------------------------------------


def q_keyed_merge(spark, d):
    """U1 (scope all): a delivery merged into a table kept in buckets, which is not shuffled for it."""
    tbl = KeyedTable(spark, scratch_path(spark, "tables", "keyed"), "cust", buckets=8)
    tbl.merge(recipe(spark, d, EXISTING), ["update_date"])
    tbl.merge(recipe(spark, d, INCOMING), ["update_date"], seq="file_seq")
    return tbl.read()


query("q_keyed_merge", ORACLES["q_snapshot_upsert_all_dates"])(q_keyed_merge)

# ---- a report whose columns change ---------------------------------------------------------------

SHIFT_ROWS = """
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END || '/shifts.csv' AS file, o_orderkey AS line_no,
       CAST(o_orderkey AS STRING) AS week, o_orderpriority AS owner, o_orderstatus AS state, o_clerk AS deputy
FROM {orders}
""".replace("o_clerk", "'D' || CAST(o_custkey AS STRING)")


def q_generic_changed(spark, d):
    """U2+R20: a generic report loses one column and gains another; the table keeps them all."""
    base = scratch_path(spark, "run")
    rows = recipe(spark, d, SHIFT_ROWS)
    for region, cols in (("a", ["week", "owner", "state"]), ("b", ["week", "state", "deputy"])):
        lines = landing.report_lines(rows.where(f"file = '{region}/shifts.csv'"), "file", "line_no", cols, ",", [],
                                     ",".join(cols))
        landing.write_files(spark, lines, f"{base}/landing-{region}")
        subjects = spark.createDataFrame(
            [(f"[Report][REGION_{region.upper()}][Shifts][2024-01-02]", f"{base}/landing-{region}/{region}", 1)],
            "subject string, folder string, arrival long")
        ingest(spark, subjects, f"{base}/warehouse", REGIONS, NOW)
    return read_append(spark, Warehouse(f"{base}/warehouse").append_path("shifts")).select(
        "week", "owner", "state", "deputy", "oss")


query("q_generic_changed", with_ctes({"r": SHIFT_ROWS}, """
SELECT week, CASE WHEN file LIKE 'a/%' THEN owner END AS owner, state,
       CASE WHEN file LIKE 'b/%' THEN deputy END AS deputy,
       CASE WHEN file LIKE 'a/%' THEN 'REGION_A' ELSE 'REGION_B' END AS oss
FROM r"""))(q_generic_changed)

# ---- the ledger over three runs --------------------------------------------------------------------

RUNS_LEDGER = LEDGER.replace("SELECT CASE o_orderpriority", "SELECT o_custkey % 3 AS run, CASE o_orderpriority", 1)
THRESHOLD = 20


def q_ledger_runs(spark, d):
    """U3+U4+A2: three runs append their rows and release the reports that are ready by then."""
    led = LedgerTable(spark, scratch_path(spark, "ledger"))
    rows = recipe(spark, d, RUNS_LEDGER)
    for run in range(3):
        led.append(rows.where(F.col("run") == run).drop("run"), TODAY, THRESHOLD)
        if run == 1:
            led.compact()
    return led.read()


_PENDING = f"report_date >= DATE '{TODAY.isoformat()}' AND error_code = '200' AND email_sent = 0"


def _ready(run: int, earlier: list[int]) -> str:
    unsent = "".join(f" AND NOT (run <= {k} AND report_name IN (SELECT report_name FROM ready{k}))" for k in earlier)
    return (f"ready{run} AS (SELECT report_name FROM l WHERE run <= {run} AND {_PENDING}{unsent} "
            f"GROUP BY report_name HAVING count(*) >= {THRESHOLD})")


query("q_ledger_runs", with_ctes({"l": RUNS_LEDGER}, f"""
, {_ready(0, [])}, {_ready(1, [0])}, {_ready(2, [0, 1])}
SELECT report_name, report_oss, report_date, error_code, error_type, description, ingest_date,
       CAST(CASE WHEN {_PENDING} AND (run <= 0 AND report_name IN (SELECT report_name FROM ready0)
                 OR run <= 1 AND report_name IN (SELECT report_name FROM ready1)
                 OR run <= 2 AND report_name IN (SELECT report_name FROM ready2)) THEN 1
            ELSE email_sent END AS INTEGER) AS email_sent
FROM l"""))(q_ledger_runs)

# ---- exports in order -----------------------------------------------------------------------------


def q_ordered_export(spark, d):
    """O1+U5: the cell export read back file by file in the order of the names; place of every row."""
    staged = pipelines.cell_2g(reported(recipe(spark, d, CELLS_2G), S.CELL_2G), "REGION_A", "2024-01-02")
    rows = staged.rows.withColumn("__key", F.col(f"{CELL}unique_id")).withColumn("__rac", F.col(f"{CELL}rac"))
    out = pipelines.export(rows, staged.spec, keep=("__key", "__rac", pipelines.ORDER))
    root = scratch_path(spark, "exports")
    write_export(out, root, partitions={"oss": "REGION_A"}, order_by=["__key", "__rac", pipelines.ORDER])
    lines = scan_reports(spark, f"{root}/oss=REGION_A", preamble=0, sep=",", pattern="*.csv")
    files = lines.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.expr("sum(n) OVER (ORDER BY _file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0))
    files = files.select("_file", before.alias("before"))       # one row per file
    return lines.join(files, "_file").select(
        F.col("cell_name").alias("name"), (F.col("before") + F.col("_seq.line")).cast("bigint").alias("place"))


query("q_ordered_export", with_ctes({"c": CELLS_2G}, f"""
SELECT cell_name AS name, row_number() OVER (ORDER BY {UNIQUE} NULLS LAST, routing_area NULLS LAST, _seq) AS place
FROM c"""))(q_ordered_export)

# ---- an archived delivery ----------------------------------------------------------------------------

ZIPPED_CELLS = REGION_CELLS.replace(
    "SELECT CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END || '/2G_Cell_List.csv' AS file,",
    "SELECT CASE WHEN o_custkey % 2 = 0 THEN 'a/one.zip/2G_Cell_List.csv'\n"
    "            ELSE 'b/two.zip/cells/2G_Cell_List.csv' END AS file,", 1)


def q_zip_delivery(spark, d):
    """S7+R21: two regional deliveries arrive as ZIP archives, one with its report in a subfolder."""
    base = scratch_path(spark, "run")
    lines = landing.report_lines(recipe(spark, d, ZIPPED_CELLS), "file", "line_no", CELL_REPORT_COLS, ",",
                                 ["2G cell export"], ",".join(CELL_REPORT_COLS))
    landing.write_archives(spark, lines, f"{base}/landing")
    subjects = spark.createDataFrame(
        [(f"[Report][REGION_{r.upper()}][NETWORKS][2024-01-02]", f"{base}/landing/{r}", i)
         for i, r in enumerate("ab")], "subject string, folder string, arrival long")
    ingest(spark, subjects, f"{base}/warehouse", REGIONS, NOW)
    rows = Warehouse(f"{base}/warehouse").table(spark, S.CELL_2G.table).read()
    return rows.select(*[F.col(f"{CELL}{c}").alias(c) for c in ("unique_id", "name", "rac", "oss")])


query("q_zip_delivery", with_ctes({"c": CELLS_2G}, f"""
, k AS (SELECT c.*, {UNIQUE} AS unique_id, o.o_custkey % 2 AS region
        FROM c JOIN (SELECT o_orderkey, o_custkey FROM orders) o ON c._seq = o.o_orderkey)
SELECT unique_id, cell_name AS name, routing_area AS rac,
       CASE WHEN region = 0 THEN 'REGION_A' ELSE 'REGION_B' END AS oss
FROM k WHERE unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY region DESC, routing_area IS NULL DESC,
                                                           routing_area DESC, _seq DESC) = 1"""))(q_zip_delivery)
