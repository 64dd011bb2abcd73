"""Readable exports (U5): relabelled CSV, partitioned by report and region.

The reference appends each delivery to one CSV per report file.  Here every
(report, region, date) delivery is a partition written with a header; writing
the same delivery again replaces only its partition (dynamic overwrite), so
re-runs are idempotent and regions export in parallel.

With ``order_by`` rows are range-partitioned and sorted by (partition columns,
order) before the write: inside a partition, the files in the order of their names
hold the rows in order, and a partition with most of the rows is still written by
many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.operators.project import relabel
from reportflow.spec import ReportSpec


def readable(df: DataFrame, spec: ReportSpec, extra: dict | None = None) -> DataFrame:
    """Table rows (prefixed columns) -> readable labels in export order."""
    out = relabel(df, spec.export_pairs())
    for label, expr in (extra or {}).items():
        out = out.withColumn(label, expr)
    return out


def write_export(df: DataFrame, root: str, partitions: dict[str, str] | None = None,
                 partition_by: list[str] | None = None, order_by: Sequence[str] = ()) -> None:
    """Write ``df`` as headed CSV under ``root``, replacing its own partitions.

    ``order_by`` columns (nulls last) order the rows; those that ``df`` holds under a
    name starting with ``__`` are not written.
    """
    parts = dict(partitions or {})
    out = df.withColumns({k: F.lit(v) for k, v in parts.items()}) if parts else df
    keys = list(parts) + [p for p in (partition_by or []) if p not in parts]
    if order_by:
        order = [*[F.col(f"`{k}`").asc() for k in keys], *[F.asc_nulls_last(f"`{c}`") for c in order_by]]
        out = out.repartitionByRange(*order).sortWithinPartitions(*order)
        out = out.drop(*[c for c in order_by if c.startswith("__")])
    elif keys:
        # few files per partition, and a hot partition still split across tasks (AQE)
        out = out.hint("rebalance", *keys)
    w = out.write.option("header", True)
    if keys:
        w = w.partitionBy(*keys).option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        w = w.mode("overwrite")
    w.csv(root)
