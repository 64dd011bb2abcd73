"""Snapshot tables (U1 write side, S9 by date) and append tables.

A snapshot table is a folder of immutable versions.  Every merge writes a new
version folder; a version becomes visible only once Spark's job commit has
written its ``_SUCCESS`` marker, so a failed or lost job never exposes partial
data and a table is never overwritten while it is being read (the folder being
read and the folder being written are different).  Versions are numbered, and
"current" is the committed one of the largest number.  There is one writer per
table at a time: a second one that commits the same number fails.

Tables scoped by report date keep a partition per date, ``report_date=<date>``, with
the versions of that date inside.  "Current" is the version committed last, of
whatever date; ``read_dates`` reads any dates with partition pruning.

Tables merged over all dates are kept in buckets of their key (``KeyedTable``), so
that a merge shuffles the delivery only and not the table.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.operators.upsert import merge_keyed, merge_snapshot
from reportflow.session import hadoop_fs

VERSION_PREFIX = "snap-"
DATE = "report_date"


class Version(NamedTuple):
    name: str                   # snap-<number>-<random>[-<tag>]
    date: str | None            # of its partition
    path: str
    committed: bool

    @property
    def number(self) -> int:
        return int(self.name[len(VERSION_PREFIX):].split("-", 1)[0])


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _list(self) -> list[Version]:
        """All version folders, by number."""
        fs, jp = hadoop_fs(self.spark, self.root)
        if not fs.exists(jp):
            return []
        out = []

        def look(folder, date: str | None) -> None:
            for st in fs.listStatus(folder):
                name = st.getPath().getName()
                if not st.isDirectory():
                    continue
                if name.startswith(VERSION_PREFIX):
                    done = fs.exists(st.getPath().suffix("/_SUCCESS"))
                    out.append(Version(name, date, st.getPath().toString(), done))
                elif date is None and name.startswith(f"{DATE}="):
                    look(st.getPath(), name.split("=", 1)[1])

        look(jp, None)
        return sorted(out, key=lambda v: (v.number, v.name))

    def _committed(self) -> list[Version]:
        return [v for v in self._list() if v.committed]

    def versions(self) -> list[str]:
        return [v.name for v in self._committed()]

    def current_path(self) -> str | None:
        v = self._committed()
        return v[-1].path if v else None

    def read(self) -> DataFrame | None:
        p = self.current_path()
        return self.spark.read.parquet(p) if p else None

    def dates(self) -> list[str]:
        """Report dates that the table holds."""
        return sorted({v.date for v in self._committed() if v.date is not None})

    def read_dates(self) -> DataFrame | None:
        """The newest version of every report date, with the partition column ``report_date``.

        Filters on ``report_date`` prune partitions: other dates are not read.
        """
        newest = {v.date: v.path for v in self._committed() if v.date is not None}
        if not newest:
            return None
        schema = self.spark.read.parquet(newest[max(newest)]).schema
        if DATE not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(DATE, T.DateType())])
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*newest.values())

    def has(self, tag: str) -> bool:
        """Whether a committed version carries the tag (see ``commit``)."""
        return any(v.endswith(f"-{tag}") for v in self.versions())

    def commit(self, df: DataFrame, tag: str | None = None, report_date: str | None = None) -> str:
        """Write a new version; ``tag`` becomes part of its name, and so is committed with it.

        ``report_date`` puts it in the partition of that date.
        """
        before = self._list()
        number = before[-1].number + 1 if before else 1
        name = f"{VERSION_PREFIX}{number:020d}-{uuid.uuid4().hex[:8]}" + (f"-{tag}" if tag else "")
        path = f"{self.root}/{DATE}={report_date}/{name}" if report_date else f"{self.root}/{name}"
        self._write(df, path)
        if any(v.number == number and v.name != name for v in self._committed()):
            fs, jp = hadoop_fs(self.spark, path)
            fs.delete(jp, True)             # the content of the other one is not in ours
            raise RuntimeError(f"another writer committed version {number} of {self.root}; merge again")
        return path

    def _write(self, df: DataFrame, path: str) -> None:
        df.write.mode("errorifexists").parquet(path)

    def retain(self, keep: int = 3) -> list[str]:
        """Delete committed versions older than the newest ``keep`` and failed writes.

        Of a dated table, ``keep`` versions of each date stay.  The current version is
        always kept; a folder without ``_SUCCESS`` that is older than the current
        version is a failed or abandoned write.  Run it when no write to the table
        is in progress.  Returns the removed version names.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        found = self._list()
        committed = [v for v in found if v.committed]
        if not committed:
            return []
        kept = {v.name for d in {v.date for v in committed}
                for v in [x for x in committed if x.date == d][-keep:]}
        removed = []
        fs, _ = hadoop_fs(self.spark, self.root)
        for v in found:
            if v.name in kept or (v.number, v.name) >= (committed[-1].number, committed[-1].name):
                continue           # kept, or possibly a write still in progress
            _, path = hadoop_fs(self.spark, v.path)
            fs.delete(path, True)
            removed.append(v.name)
        return sorted(removed)

    def upsert(self, incoming: DataFrame, key: str, sort_cols, seq: str | None = None,
               scope: str = "report_date", date_col: str | None = None,
               report_date: str | None = None, on_create: str = "clean") -> DataFrame:
        """Merge a delivery into the current version and commit the result."""
        merged = merge_snapshot(self.read(), incoming, key, sort_cols, seq=seq, scope=scope,
                                date_col=date_col, report_date=report_date,
                                on_create=on_create)
        path = self.commit(merged, report_date=report_date if scope == "report_date" else None)
        return self.spark.read.parquet(path)


class KeyedTable(SnapshotTable):
    """A snapshot table whose versions are stored in buckets of their key.

    The number of buckets is part of a version's name.  Spark knows buckets from a
    catalog only, so a version is named there for the moment in which it is written
    or opened, as an external table, and dropped again.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int | None = None):
        super().__init__(spark, root)
        self.key = key
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _named(self, make) -> DataFrame | None:
        name = f"keyed_{uuid.uuid4().hex}"
        try:
            return make(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _write(self, df: DataFrame, path: str) -> None:
        self._named(lambda name: df.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
                    .option("path", path).mode("errorifexists").saveAsTable(name))

    def commit(self, df: DataFrame, tag: str | None = None, report_date: str | None = None) -> str:
        if report_date is not None:
            raise ValueError("a keyed table holds all dates")
        return super().commit(df, f"{tag}-b{self.buckets}" if tag else f"b{self.buckets}")

    def has(self, tag: str) -> bool:
        return any(v.rsplit("-b", 1)[0].endswith(f"-{tag}") for v in self.versions())

    def read(self) -> DataFrame | None:
        """The current version; Spark knows that it is partitioned by its key."""
        found = self._committed()
        if not found:
            return None
        path, mark = found[-1].path, found[-1].name.rsplit("-", 1)[-1]
        plain = self.spark.read.parquet(path)
        if not (mark.startswith("b") and mark[1:].isdigit()):
            return plain                    # written as a plain snapshot
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)

        def opened(name: str) -> DataFrame:
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) "
                           f"SORTED BY (`{self.key}`) INTO {mark[1:]} BUCKETS LOCATION '{path}'")
            return self.spark.table(name)

        return self._named(opened)

    def merge(self, incoming: DataFrame, sort_cols, seq: str | None = None) -> str:
        """Merge a delivery over all dates and commit; the existing rows are not shuffled."""
        existing = self.read()
        if existing is None:
            merged = merge_snapshot(None, incoming, self.key, sort_cols, seq=seq, scope="all")
        else:
            merged = merge_keyed(existing, incoming, self.key, sort_cols, seq=seq)
        return self.commit(merged)


# ---- append tables -----------------------------------------------------------------------------

COLUMNS = "_columns"            # hidden from Spark's readers, as it starts with an underscore


def _stored_columns(spark: SparkSession, root: str) -> dict[str, T.DataType]:
    """Columns of all deliveries so far, in the order in which they first came."""
    fs, jp = hadoop_fs(spark, f"{root.rstrip('/')}/{COLUMNS}")
    if not fs.exists(jp):
        return {}
    lists = sorted(st.getPath().toString() for st in fs.listStatus(jp)
                   if st.isDirectory() and fs.exists(st.getPath().suffix("/_SUCCESS")))
    out: dict[str, T.DataType] = {}
    for path in lists:                                  # one per delivery that brought new columns
        for r in spark.read.schema("value string").text(path).collect():
            for f in T.StructType.fromJson(json.loads(r["value"])).fields:
                out.setdefault(f.name, f.dataType)
    return out


def append_table(df: DataFrame, root: str, partition_by: list[str] | None = None,
                 replace_partitions: bool = False) -> None:
    """Append ``df`` to a Parquet table, creating it if absent.

    Deliveries may bring other columns than earlier ones: the table keeps a list of
    its columns, written before the rows and only when some are new, and
    ``read_append`` reads all of them, null where a delivery lacks one.  A column
    that comes back with another type is an error.

    With ``replace_partitions`` the partitions present in ``df`` are replaced
    (dynamic partition overwrite), which makes a re-sent delivery idempotent.
    """
    spark = df.sparkSession
    if replace_partitions and not partition_by:
        raise ValueError("replace_partitions needs partition_by")
    known = _stored_columns(spark, root)
    other = [f"{f.name}: {known[f.name].simpleString()}, now {f.dataType.simpleString()}" for f in df.schema.fields
             if f.name in known and known[f.name] != f.dataType]
    if other:
        raise ValueError(f"columns of {root} changed their type: {other}")
    if any(c not in known for c in df.columns):
        nth = len(known)
        spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(
            f"{root.rstrip('/')}/{COLUMNS}/{nth:06d}-{uuid.uuid4().hex[:8]}")
    w = df.write
    if partition_by:
        # few files per partition, and a hot partition still split across tasks (AQE)
        w = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    if replace_partitions:
        w = w.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        w = w.mode("append")
    w.parquet(root)


def read_append(spark: SparkSession, root: str) -> DataFrame:
    """All rows of an append table with the columns of all its deliveries.

    The schema comes from the stored column list, so no file footers are read for
    it; a table without one (written by other means) is read with merged schemas.
    """
    known = _stored_columns(spark, root)
    if not known:
        return spark.read.option("mergeSchema", "true").parquet(root)
    schema = T.StructType([T.StructField(n, t) for n, t in known.items()])
    return spark.read.schema(schema).parquet(root).select(*[F.col(f"`{c}`") for c in known])


def new_table_root(spark: SparkSession, *parts: str) -> str:
    from reportflow.session import scratch_path
    return scratch_path(spark, *parts)
