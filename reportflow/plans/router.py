"""Router helpers (R21 gate, S6 file dispatch).

``route_deliveries`` parses and gates every delivery of a run (many reports,
regions and dates) against the ledger in one set of Spark jobs;
``plans.ingest.ingest`` runs the accepted deliveries and writes their ledger
rows.  ``allowed_files`` / ``dispatch_scan`` read only allow-listed report
files and tag rows with their target table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.plans import specs
from reportflow.sources.reports import FILE, list_files, listing, scan_reports


def spec_table(spark: SparkSession, family: str | None = None) -> DataFrame:
    """The report registry as a small DataFrame (file name, family, target table)."""
    rows = [(s.file_name, s.family, s.table) for s in specs.REGISTRY.specs.values()
            if family is None or s.family == family]
    if family in (None, "NETWORKS"):
        rows.append((specs.NODEB_INFO, "NETWORKS", None))
    return spark.createDataFrame(rows, "file_name string, family string, target_table string")


def allowed_files(spark: SparkSession, landing: str, family: str = "NETWORKS") -> DataFrame:
    """Files of a landing folder that the family's allow-list knows.

    The registry has a fixed, small number of entries, so it is broadcast.
    """
    known = spec_table(spark, family)
    if family == "NETWORKS":
        known = known.where(F.col("file_name").isin(*specs.NETWORK_FILES))
    files = listing(spark, landing)
    return files.join(F.broadcast(known), files["name"] == known["file_name"], "inner") \
        .select("path", "name", "family", "target_table")


def preambles(family: str) -> dict[str, int]:
    """Allow-listed file names of a family with the preamble lines of each."""
    known = {s.file_name: s.preamble for s in specs.REGISTRY.for_family(family)}
    if family == "NETWORKS":
        known = {n: known.get(n, 0) for n in specs.NETWORK_FILES}
    return known


def dispatch_scan(spark: SparkSession, landing: str, family: str = "NETWORKS") -> DataFrame:
    """Only allow-listed files, in one scan, each after its own preamble; rows tagged with their table."""
    lines = preambles(family)
    paths = [p for p in list_files(spark, landing) if p.rsplit("/", 1)[-1] in lines]
    if not paths:
        raise FileNotFoundError(f"no allow-listed files under {landing}")
    rows = scan_reports(spark, paths, preamble=lines)
    known = spec_table(spark, family).select(F.col("file_name").alias(FILE), "target_table")
    return rows.join(F.broadcast(known), on=FILE, how="left")


def route_deliveries(subjects: DataFrame, ledger_df: DataFrame, regions: list[str],
                     subject_col: str = "subject") -> DataFrame:
    """Parse subjects, gate them against the ledger and describe each delivery.

    ``subjects`` holds the subject, the delivery folder and the arrival order
    (``arrival``).  Output: the parsed subject, ``report_date``, ``family``,
    ``status`` (``ok`` / quarantine reason), ``last_date`` and ``accepted``.
    """
    from reportflow.plans.ingest import gate_deliveries
    if subject_col != "subject":
        subjects = subjects.withColumnRenamed(subject_col, "subject")
    return gate_deliveries(subjects, ledger_df, regions)
