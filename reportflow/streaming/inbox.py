"""Consume-once landing folder.

Deliveries land as files in a folder.  A Structured Streaming file source with
``trigger(availableNow=True)`` processes every file not seen before, recording
progress in a checkpoint.  The rows go either to Spark's file sink (exactly
once: its commit log ignores a replayed batch's files) or, through
``foreachBatch``, to a routing function (``ingest_stream`` runs each batch of
delivery manifests through ``plans.ingest.ingest``).  Re-running on the same
checkpoint processes only new files, and a run lost half-way resumes from the
last committed batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def consume_once(spark: SparkSession, landing: str, schema: T.StructType, checkpoint: str,
                 sink: str | None = None, route: Callable[[DataFrame, int], None] | None = None,
                 fmt: str = "parquet", sink_format: str = "parquet", options: dict | None = None,
                 max_files_per_trigger: int | None = None) -> None:
    """Process every not-yet-seen file under ``landing`` once, then stop.

    With ``sink`` the rows go to Spark's file sink, which is exactly-once: its
    own commit log under ``sink/_spark_metadata`` ignores files of a batch that
    was replayed after a failure.  With ``route`` each micro-batch is handed
    to a function (``foreachBatch``), e.g. a report pipeline.
    """
    if (sink is None) == (route is None):
        raise ValueError("give exactly one of sink= or route=")
    # a file counts as new however old it is: without this, files a week older than the newest are skipped
    reader = spark.readStream.format(fmt).schema(schema).option("maxFileAge", "36500d")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink is not None:
        w = w.format(sink_format).option("path", sink).outputMode("append")
    else:
        w = w.foreachBatch(route)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


MANIFEST_SCHEMA = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("arrival", T.LongType()),
])


def ingest_stream(spark: SparkSession, manifests: str, warehouse_root: str, regions: list[str],
                  checkpoint: str, clock: Callable[[], object], today=None) -> None:
    """Every delivery manifest landing under ``manifests`` is ingested once.

    A manifest is a JSON-lines file of (subject, folder, arrival), one line per
    delivery (the mail-box loop of the reference becomes a landing folder).
    Each micro-batch of new manifests runs ``plans.ingest.ingest``; the
    checkpoint makes a restarted stream skip manifests already handled.  The
    ledger segment that a batch commits carries the batch's number, so a batch
    replayed after its commit is skipped.
    """
    from reportflow.plans.ingest import Warehouse, ingest

    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:8]

    def route(batch: DataFrame, batch_id: int) -> None:
        tag = f"{stream}-{batch_id}"
        if batch.isEmpty() or Warehouse(warehouse_root.rstrip("/")).ledger(spark).has(tag):
            return
        ingest(spark, batch, warehouse_root, regions, clock(), today=today, batch=tag)

    consume_once(spark, manifests, MANIFEST_SCHEMA, checkpoint, route=route, fmt="json")
