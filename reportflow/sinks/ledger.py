"""The ledger as a table of run segments.

Every run commits one segment: its own rows, and marks that say which reports were
released (``report_name``, pending rows of that date or later).  A segment is
visible once its rows have their ``_SUCCESS``, so a lost run leaves nothing, and
what a run writes does not grow with the ledger's history.  Reading applies each
mark to the pending rows of its own and earlier segments, which is what rewriting
their ``email_sent`` would give.  ``compact`` folds segments into one.

There is one writer at a time, as for snapshot tables.  A ledger that was kept as a
snapshot table before stands for what came before the first segment.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.operators import ledger
from reportflow.session import hadoop_fs
from reportflow.sinks.snapshot import SnapshotTable

PREFIX = "seg-"
SEGMENT = "segment"
_ROWS = T.StructType([*ledger.LEDGER_SCHEMA.fields, T.StructField(SEGMENT, T.LongType())])
_MARKS = f"report_name string, since date, {SEGMENT} bigint"


class LedgerTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def segments(self) -> list[str]:
        """Names of the committed segments, oldest first: seg-<number>[-<tag>]."""
        fs, jp = hadoop_fs(self.spark, self.root)
        if not fs.exists(jp):
            return []
        found = [st.getPath() for st in fs.listStatus(jp) if st.isDirectory()]
        names = sorted(p.getName() for p in found
                       if p.getName().startswith(PREFIX) and fs.exists(p.suffix("/rows/_SUCCESS")))
        # a compacted segment stands for all of its number and below
        bases = [n for n in names if n.endswith("-base")]
        return [n for n in names if not bases or n == bases[-1] or _number(n) > _number(bases[-1])]

    def has(self, tag: str) -> bool:
        """Whether a run with the tag was committed."""
        fs, jp = hadoop_fs(self.spark, f"{self.root}/_tags/{tag}")
        return any(n.endswith(f"-{tag}") for n in self.segments()) or fs.exists(jp)

    def read(self) -> DataFrame | None:
        """All rows, with ``email_sent`` as the marks leave it."""
        names, old = self.segments(), self._before_segments()
        if not names and old is None:
            return None
        rows = old
        if names:
            rows = self.spark.read.schema(_ROWS).parquet(*[f"{self.root}/{n}/rows" for n in names])
            rows = rows if old is None else rows.unionByName(old)
        fs, _ = hadoop_fs(self.spark, self.root)
        marked = [p for p in (f"{self.root}/{n}/marks" for n in names) if fs.exists(hadoop_fs(self.spark, p)[1])]
        if marked:
            # one row per released report, of which there is a handful
            marks = self.spark.read.schema(_MARKS).parquet(*marked).groupBy("report_name").agg(
                F.collect_list(F.struct("since", SEGMENT)).alias("marks"))
            rows = rows.join(marks, "report_name", "left")
            hit = F.exists("marks", lambda m: (F.col("report_date") >= m["since"]) & (F.col(SEGMENT) <= m[SEGMENT]))
            sent = (F.col("error_code") == "200") & F.coalesce(hit, F.lit(False))
            rows = rows.withColumn("email_sent", F.when(sent, F.lit(1)).otherwise(F.col("email_sent")).cast("int"))
        return rows.select(*ledger.LEDGER_SCHEMA.names)

    def _before_segments(self) -> DataFrame | None:
        if any(n.endswith("-base") for n in self.segments()):
            return None                     # folded in
        old = SnapshotTable(self.spark, self.root).read()
        return None if old is None else old.select(*ledger.LEDGER_SCHEMA.names, F.lit(0).cast("bigint").alias(SEGMENT))

    def append(self, rows: DataFrame, today: dt.date | None = None, threshold: int = ledger.READY_THRESHOLD,
               reports: tuple[str, ...] | None = None, tag: str | None = None) -> None:
        """Commit a run's rows; with ``today``, also mark the reports that reached the threshold."""
        names = self.segments()
        number = _number(names[-1]) + 1 if names else 1
        path = f"{self.root}/{PREFIX}{number:020d}" + (f"-{tag}" if tag else "")
        if today is not None:
            before = self.read()
            pending = rows if before is None else before.unionByName(rows)
            ready = ledger.batch_ready(pending, today, threshold).where("ready")
            if reports is not None:
                ready = ready.where(F.col("report_name").isin(*reports))
            ready.select("report_name", F.lit(today).alias("since"), F.lit(number).cast("bigint").alias(SEGMENT)) \
                .coalesce(1).write.mode("overwrite").parquet(f"{path}/marks")
        rows.select(*ledger.LEDGER_SCHEMA.names, F.lit(number).cast("bigint").alias(SEGMENT)) \
            .write.mode("errorifexists").parquet(f"{path}/rows")

    def compact(self) -> int:
        """Fold all segments into one (their tags stay known); returns how many there were."""
        names = self.segments()
        if len(names) < 2:
            return len(names)
        fs, _ = hadoop_fs(self.spark, self.root)
        number = _number(names[-1])
        for n in names:
            parts = n.split("-", 2)
            if len(parts) == 3 and parts[2] != "base":
                fs.mkdirs(hadoop_fs(self.spark, f"{self.root}/_tags/{parts[2]}")[1])
        self.read().withColumn(SEGMENT, F.lit(number).cast("bigint")).write.parquet(
            f"{self.root}/{PREFIX}{number:020d}-base/rows")
        for n in names:
            fs.delete(hadoop_fs(self.spark, f"{self.root}/{n}")[1], True)
        return len(names)


def _number(name: str) -> int:
    return int(name.split("-")[1])
