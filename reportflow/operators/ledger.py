"""Ingestion ledger: last success, batch completeness, ledger rows, mark sent.

(A1, A2, U3, U4.)  The ledger is an append table with one row per delivery.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.functions.dates import report_date as parse_report_date

LEDGER_SCHEMA = T.StructType([
    T.StructField("report_name", T.StringType()),
    T.StructField("report_oss", T.StringType()),
    T.StructField("report_date", T.DateType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("ingest_date", T.TimestampNTZType()),   # wall clock
    T.StructField("email_sent", T.IntegerType()),
])

# Ledger outcome codes.
SUCCESS = ("200", "SUCCESS", "")
FAILURE = ("500", "INTERNAL ERROR", "Code Bug")
READY_THRESHOLD = 2
# The report families whose dumps are released after enough deliveries.
RELEASED_REPORTS = ("NETWORKS", "EXTERNALS", "PKI")


def last_success(ledger: DataFrame) -> DataFrame:
    """Latest successful report date per (report, region), names upper-cased (A1)."""
    return (ledger.where(F.col("error_code") == "200")
            .groupBy(F.upper("report_name").alias("report_name"),
                     F.upper("report_oss").alias("report_oss"))
            .agg(F.max("report_date").alias("last_date")))


def _pending(today) -> Column:
    return ((F.col("report_date") >= F.lit(today)) & (F.col("error_code") == "200")
            & (F.col("email_sent") == 0))


def batch_ready(ledger: DataFrame, today: dt.date,
                threshold: int = READY_THRESHOLD) -> DataFrame:
    """Unsent successes dated today or later per report and readiness (A2)."""
    return (ledger.where(_pending(today)).groupBy("report_name")
            .agg(F.count(F.lit(1)).alias("pending"))
            .withColumn("ready", F.col("pending") >= threshold))


def ledger_rows(outcomes: DataFrame, now: dt.datetime, name: str = "report_name",
                oss: str = "oss", date_text: str = "report_date_text",
                ok: str = "ok") -> DataFrame:
    """One ledger row per delivery outcome.

    Names are upper-cased, the date text is parsed (ISO or day-first) and the
    outcome becomes ``200/SUCCESS`` or ``500/INTERNAL ERROR/Code Bug``.
    """
    good = F.col(ok)
    return outcomes.select(
        F.upper(F.col(name)).alias("report_name"),
        F.upper(F.coalesce(F.col(oss), F.lit(""))).alias("report_oss"),
        parse_report_date(F.col(date_text)).alias("report_date"),
        F.when(good, F.lit(SUCCESS[0])).otherwise(F.lit(FAILURE[0])).alias("error_code"),
        F.when(good, F.lit(SUCCESS[1])).otherwise(F.lit(FAILURE[1])).alias("error_type"),
        F.when(good, F.lit(SUCCESS[2])).otherwise(F.lit(FAILURE[2])).alias("description"),
        F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("ingest_date"),
        F.lit(0).cast("int").alias("email_sent"),
    )


def mark_sent(ledger: DataFrame, today: dt.date, threshold: int = READY_THRESHOLD,
              reports: tuple[str, ...] | None = None) -> DataFrame:
    """The ledger with ``email_sent=1`` on pending rows of ready reports (U4).

    ``reports`` limits the step to the named reports (those whose dumps are
    released, and only when one of their deliveries was just loaded).
    """
    ready = batch_ready(ledger, today, threshold).where("ready")
    if reports is not None:
        ready = ready.where(F.col("report_name").isin(*reports))
    ready = ready.select("report_name", F.lit(True).alias("__ready"))
    out = ledger.join(ready, on="report_name", how="left")
    flag = F.when(_pending(today) & F.coalesce(F.col("__ready"), F.lit(False)), F.lit(1)) \
        .otherwise(F.col("email_sent")).cast("int")
    return out.withColumn("email_sent", flag).drop("__ready").select(*ledger.columns)
