"""Write report-shaped text files from a DataFrame (test-input builder).

Used by the suite to lay down delivered reports (preamble lines, a header, CSV
rows, an optional footer) from the supplied tables, under the shared scratch
folder.  It is a Spark job: lines are ranged by (file, line) and written in that
order by as many tasks as they fill.  A report that one task wrote is renamed to
its file name; one that several tasks wrote is delivered in parts, a folder of
that name (``sources.reports.PARTS``).  Both are metadata operations only.
"""

from __future__ import annotations

import io
import uuid
import zipfile
import zlib
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportflow.session import hadoop_fs
from reportflow.sources.reports import PARTS

CSV_OPTS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "quote": '"', "escape": '"'}
# Lines that one task sorts and writes.
LINES_PER_TASK = 250_000


def report_lines(rows: DataFrame, file_col: str, order_col: str, value_cols: Sequence[str],
                 sep: str, preamble: Sequence[str], header: str,
                 footer: str | None = None, bare: Sequence[str] = ()) -> DataFrame:
    """(file, line_no, line) for every line of every report file; ``bare`` ones have no preamble.

    Data lines are CSV-encoded with Spark's ``to_csv`` (quoting as needed);
    preamble, header and footer lines are generated once per file from a
    per-file aggregate (no cross join).
    """
    opts = dict(CSV_OPTS, sep=sep)
    data = rows.select(F.col(file_col).alias("file"), F.col(order_col).cast("bigint").alias("n"),
                       F.to_csv(F.struct(*[F.col(c) for c in value_cols]), opts).alias("line"))
    per_file = rows.groupBy(F.col(file_col).alias("file")).agg(F.count(F.lit(1)).alias("cnt"))
    fixed = [F.struct(F.lit(-1000 + i).cast("bigint").alias("n"), F.lit(t).alias("line"))
             for i, t in enumerate([*preamble, header])]
    if footer is not None:
        fixed.append(F.struct(F.lit(2**62).cast("bigint").alias("n"),
                              F.concat(F.lit(footer), F.col("cnt").cast("string")).alias("line")))
    extra = per_file.select("file", F.explode(F.array(*fixed)).alias("x")).select(
        "file", "x.n", "x.line")
    if bare:
        extra = extra.where(~F.col("file").isin(*bare) | (F.col("n") >= -1000 + len(preamble)))
    return data.unionByName(extra)


def _ranged(lines: DataFrame, lines_per_task: int) -> DataFrame:
    """Lines in the order of (file, n), over as many tasks as they fill."""
    tasks = max(1, -(-lines.count() // lines_per_task))
    return lines.repartitionByRange(tasks, "file", "n").sortWithinPartitions("file", "n")


def write_files(spark: SparkSession, lines: DataFrame, root: str, lines_per_task: int = LINES_PER_TASK) -> list[str]:
    """Write one report per ``file`` value under ``root``, large ones in parts; return the paths.

    A ``file`` value may contain ``/`` (a sub-folder per delivery).
    """
    return _deliver(spark, _ranged(lines, lines_per_task), root)


def _deliver(spark: SparkSession, ordered: DataFrame, root: str) -> list[str]:
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    ordered.select("file", "line").write.partitionBy("file").text(staging)
    fs, jstaging = hadoop_fs(spark, staging)
    out = []
    for st in fs.listStatus(jstaging):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith("file=")):
            continue
        target_name = unquote(name.split("=", 1)[1])
        parts = [p for p in fs.listStatus(st.getPath()) if p.getPath().getName().startswith("part-")]
        target = st.getPath().getParent().getParent().suffix("/" + target_name)
        fs.mkdirs(target.getParent())
        if len(parts) > 1:
            fs.create(st.getPath().suffix("/" + PARTS)).close()
        if not fs.rename(parts[0].getPath() if len(parts) == 1 else st.getPath(), target):
            raise RuntimeError(f"{target_name} cannot be delivered to {root}")
        out.append(target.toString())
    return sorted(out)


CHUNK = 1 << 22


def _deflated(batches):
    """(file, n, size, crc, data): lines in order as deflated chunks, each but for its last byte.

    A chunk ends as its text does, with a line break: an uncompressed block of that one
    byte.  So chunks follow each other in the lines of a text file, which adds the breaks.
    """
    import pyarrow as pa
    open_file, first, text = None, 0, []

    def chunk():
        raw = "".join(text).encode()
        z = zlib.compressobj(wbits=-15)
        data = z.compress(raw[:-1]) + z.flush(zlib.Z_SYNC_FLUSH) + b"\x00\x01\x00\xfe\xff"
        return pa.RecordBatch.from_arrays(
            [pa.array([open_file]), pa.array([first], pa.int64()), pa.array([len(raw)], pa.int64()),
             pa.array([zlib.crc32(raw)], pa.int64()), pa.array([data], pa.binary())],
            ["file", "n", "size", "crc", "data"])

    size = 0
    for batch in batches:
        for file, n, line in zip(*(batch.column(c).to_pylist() for c in ("file", "n", "line")), strict=True):
            if text and (file != open_file or size >= CHUNK):
                yield chunk()
                text, size = [], 0
            if not text:
                open_file, first = file, n
            text.append(line + "\n")
            size += len(line) + 1
    if text:
        yield chunk()


def _crc_joined(crc: int, other: int, size: int) -> int:
    """The CRC of two byte strings, from those of each and the size of the second."""
    def times(matrix, v):
        out = 0
        for row in matrix:
            if v & 1:
                out ^= row
            v >>= 1
        return out

    shift = [0xEDB88320, *(1 << i for i in range(31))]         # one zero bit more
    for _ in range(3):
        shift = [times(shift, row) for row in shift]            # a zero byte
    while size:
        if size & 1:
            crc = times(shift, crc)
        size >>= 1
        shift = [times(shift, row) for row in shift]
    return crc ^ other


FINAL = b"\x03\x00"             # an empty last block ends a member


class _Tail(io.BytesIO):
    """What follows the first ``start`` bytes of a file."""

    def __init__(self, start: int):
        super().__init__()
        self.start = start

    def tell(self):
        return super().tell() + self.start

    def seek(self, at, whence=0):
        return super().seek(at - self.start if whence == 0 else at, whence) + self.start


def _framed(key, pdf):
    """(file, n, member, head): what precedes each member's first chunk, and the archive's directory."""
    import pandas as pd
    rows, infos, at, end = [], [], 0, b""
    for i, (member, part) in enumerate(pdf.sort_values(["member", "n"]).groupby("member")):
        info = zipfile.ZipInfo(member)
        info.compress_type, info.header_offset = zipfile.ZIP_DEFLATED, at
        info.file_size, info.compress_size = int(part["size"].sum()), int(part["stored"].sum()) + len(FINAL)
        for crc, size in zip(part["crc"], part["size"], strict=True):
            info.CRC = _crc_joined(getattr(info, "CRC", 0) or 0, int(crc), int(size))
        head = info.FileHeader()
        rows.append((key[0], i, member, end + head))
        infos.append(info)
        at, end = at + len(head) + info.compress_size, FINAL
    tail = _Tail(at)
    with zipfile.ZipFile(tail, "w") as zf:
        zf.filelist.extend(infos)
        zf.comment = b"\n"
    rows.append((key[0], len(infos), None, end + tail.getvalue()[:-1]))
    return pd.DataFrame(rows, columns=["file", "place", "member", "head"])


def write_archives(spark: SparkSession, lines: DataFrame, root: str, lines_per_task: int = LINES_PER_TASK) -> list[str]:
    """Lay report lines (``archive/member`` as file) down as ZIP archives.

    Lines are deflated in chunks by as many tasks as they fill.  One task per archive
    then puts its chunks, a few megabytes each, into one file.  The text writer ends
    a file with a line break; it is the archive's comment.
    """
    staged = f"{root.rstrip('/')}/_chunks-{uuid.uuid4().hex}"
    _ranged(lines, lines_per_task).select("file", "n", "line").mapInArrow(
        _deflated, "file string, n bigint, size bigint, crc bigint, data binary").write.parquet(staged)
    archive = F.regexp_extract("file", r"^(.*\.zip)/", 1)
    chunks = spark.read.parquet(staged).select(archive.alias("file"), F.regexp_replace("file", r"^.*\.zip/", "").alias("member"),
                                               "n", "size", "crc", "data", (F.length("data") + 1).alias("stored"))
    frames = F.broadcast(chunks.drop("data").groupBy("file").applyInPandas(
        _framed, "file string, place int, member string, head binary"))
    first = F.row_number().over(Window.partitionBy("file", "member").orderBy("n")) == 1
    starts = chunks.select("file", "member", "n").withColumn("first", first).where("first").drop("first")
    heads = starts.join(frames, ["file", "member"]).select("file", "member", "n", "head")
    body = (chunks.join(F.broadcast(heads), ["file", "member", "n"], "left")
            .join(frames.drop("head"), ["file", "member"])
            .select("file", "place", "n", F.concat(F.coalesce("head", F.lit(b"")), "data").alias("bytes")))
    ends = frames.where("member IS NULL").select("file", "place", F.lit(0).cast("bigint").alias("n"), F.col("head").alias("bytes"))
    ordered = body.unionByName(ends).repartition("file").sortWithinPartitions("file", "place", "n")
    return _deliver(spark, ordered.select("file", F.col("bytes").cast("string").alias("line")), root)
