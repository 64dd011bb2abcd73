"""Archive members (S7): expand ZIP deliveries and guard against path escapes.

``stage_members`` reads each archive once, by as many tasks as it has splits, into
slices of 64 KB in the scratch folder.  One task parses an archive's directory, and
the slices are cut where members begin and end.  So no task holds an archive or a
member, which may have any size; only bytes without a line break are one row.  From
there names are listed without touching contents, and ``member_lines`` inflates only
the members that are wanted, each in a task of its own choosing, so that one large
archive is inflated by many tasks.  These steps run in Python, some slices or a piece
of a member at a time.

``guard`` decides, all-or-nothing per archive, whether every member stays
inside the destination folder once the path is resolved; the check is a Column
expression (a fold over path segments), so it runs in the JVM over any number
of members.
"""

from __future__ import annotations

import bz2
import codecs
import io
import lzma
import zipfile
import zlib
from itertools import chain, groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.session import hadoop_fs, scratch_path

MEMBER_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def _members(batches):
    import pandas as pd
    cols = ["archive", "member", "size", "content"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows = []
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for info in zf.infolist():
                    if not info.is_dir():
                        rows.append((path, info.filename, info.file_size, zf.read(info)))
            yield pd.DataFrame(rows, columns=cols)     # one archive's members at a time


def expand_archives(spark: SparkSession, paths: str | list[str],
                    pattern: str = "*.zip") -> DataFrame:
    """One row per archive member: (archive path, member name, size, bytes)."""
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
           .load(paths).select("path", "content"))
    return raw.mapInPandas(_members, MEMBER_SCHEMA)


STORED, DEFLATED, BZIPPED, LZMA = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA
PIECE = 1 << 22                 # of a member's contents
SLICE = 1 << 16                 # of an archive: Spark's sorts, Parquet pages and readers hold many rows
ROW = 1 << 10                   # what Python gets as a row: an Arrow batch has 10,000
TAIL = 1 << 17                  # more than an archive's end record with its comment and zip64 records
ROW_GROUP = 1 << 23             # what a reader of slices takes at once


def _runs(batches, names: list[str]):
    """Rows of the same key put together, of one batch at most: (key, their data)."""
    import numpy as np
    for batch in batches:
        keys, data = [batch.column(c) for c in names], batch.column("data").cast(pa.large_binary())
        at = np.frombuffer(data.buffers()[1], np.int64)[data.offset:].tolist()
        raw = memoryview(data.buffers()[2] or b"")
        begin = 0
        for end in sorted({x for c in keys for x in pc.run_end_encode(c).run_ends.to_pylist()}):
            yield tuple(c[begin].as_py() for c in keys), raw[at[begin]:at[end]]
            begin = end


def _pieces(batches):
    """(archive, size, block, place, n, data): files in slices, their lines put together; ``place`` is in the split."""
    names = ["archive", "size", "block", "place", "n", "data"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    last, place = None, 0
    for key, data in _runs(batches, names[:3]):
        if key != last:
            last, place = key, 0
        parts = [bytes(data[i:i + SLICE]) for i in range(0, len(data), SLICE)]
        columns = [*([k] * len(parts) for k in key), [place + i for i in range(0, len(data), SLICE)], [len(x) for x in parts], parts]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        place += len(data)


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(spark: SparkSession, paths: list[str], folder: str) -> DataFrame:
    """(archive, size, at, n, data): the bytes of files in slices, by as many tasks as the files have splits.

    Spark's text reader cuts files of any kind at line breaks, and so by many tasks.
    What it leaves out is known: the breaks, and a byte order mark that begins a file.
    """
    lines = spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("archive"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("data"))
    pieces = _staged(lines.mapInArrow(
        _pieces, "archive string, size bigint, block bigint, place bigint, n bigint, data binary"), f"{folder}/pieces")
    whole = Window.partitionBy("archive")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = pieces.groupBy("archive", "size", "block").agg(F.sum("n").alias("total")).select(
        "archive", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"),
        (F.col("size") - F.sum("total").over(whole)).alias("lacks"))
    # A file's last line has one byte too many if it ends without a break.
    start = (F.when(F.col("lacks").isin(0, -1), 0).when(F.col("lacks").isin(3, 2), 3).otherwise(F.raise_error(
        F.concat(F.lit("file changed while it was read: "), F.col("archive"))).cast("int")))
    splits = _staged(splits.select("archive", "block", (F.col("before") + start).alias("before")), f"{folder}/splits")
    at = F.col("before") + F.col("place")
    return pieces.join(F.broadcast(splits), ["archive", "block"]).select(
        "archive", "size", at.alias("at"), F.least("n", F.col("size") - at).alias("n"), "data").where("n > 0")


class _Before(Exception):
    """A file was read where it is not at hand."""


class _End(io.BytesIO):
    """A file of which only the end is at hand: what follows its first ``start`` bytes."""

    def __init__(self, pdf):
        data = [x[:int(n)] for _, n, x in sorted(zip(pdf["at"], pdf["n"], pdf["data"], strict=True))
                ] if pdf["at"].notna().all() else []
        super().__init__(b"".join(data))
        self.start = int(pdf["at"].min()) if data else 0
        self.size = self.start + sum(map(len, data))
        self.place = 0

    def tell(self):
        return self.place

    def seek(self, at, whence=0):
        at += (0, self.place, self.size)[whence]
        if at < 0:
            raise OSError(f"no place {at} in a file")
        self.place = at
        return at

    def read(self, n=-1):
        if self.place < self.start and n != 0:
            raise _Before(self.place)
        super().seek(self.place - self.start)
        data = super().read(n)
        self.place += len(data)
        return data


def _directory_start(key, pdf):
    """(archive, start): where what its directory is read from begins in an archive."""
    import pandas as pd
    end = _End(pdf)
    try:
        with zipfile.ZipFile(end) as zf:
            start = zf.start_dir
    except _Before as x:
        start = x.args[0]
    return pd.DataFrame([(key[0], min(start, end.size - TAIL))], columns=["archive", "start"])


def _directory(key, pdf):
    """(archive, member, method, crc, stored, head): the directory of an archive; ``head`` is the place of a member's header."""
    import pandas as pd
    rows = []
    with zipfile.ZipFile(_End(pdf)) as zf:
        for info in zf.infolist():
            if info.is_dir():
                continue
            if info.flag_bits & 1:
                raise RuntimeError(f"{key[0]}: member {info.filename} is encrypted")
            if info.compress_type not in (STORED, DEFLATED, BZIPPED, LZMA):
                raise NotImplementedError(f"{key[0]}: member {info.filename} has compression method {info.compress_type}")
            rows.append((key[0], info.filename, info.compress_type, info.CRC, info.compress_size, info.header_offset))
    return pd.DataFrame(rows, columns=["archive", "member", "method", "crc", "stored", "head"])


def _parts(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """The parts of ranges (archive, begin, end, ...) that lie in one slice each, with their place and data."""
    # A slice reaches into the next cell at most.
    cells = F.sequence(F.expr(f"begin div {SLICE} - 1"), F.expr(f"(end - 1) div {SLICE}"))
    ranges = ranges.where("begin < end").withColumn("cell", F.explode(cells))
    found = pieces.drop("size").withColumn("cell", F.expr(f"at div {SLICE}")).withColumnRenamed("archive", "__archive")
    found = ranges.hint("merge").join(found, (F.col("archive") == F.col("__archive")) & (ranges["cell"] == found["cell"]) &
                        (F.col("begin") < F.col("at") + F.col("n")) & (F.col("at") < F.col("end")))
    place = F.greatest("begin", "at")
    length = F.least("end", F.col("at") + F.col("n")) - place
    return found.select(*[c for c in ranges.columns if c != "cell"], place.alias("place"), F.substring(
        "data", (place - F.col("at") + 1).cast("int"), length.cast("int")).alias("data"))


def stage_members(spark: SparkSession, paths: list[str], staged: str | None = None) -> DataFrame:
    """(archive, member, method, crc, slice, data): compressed members of ZIP files, read once.

    A member has at least one slice, of number 0; the others have that of their first byte in the member.
    They are written to ``staged``, or else to a folder of their own in the scratch folder.
    """
    folder = scratch_path(spark, "archives")
    archives = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("archive"), F.col("length").alias("size"))
    pieces = _placed(spark, paths, folder)
    bytes_ = pieces.select("archive", "at", "n", "data")

    def ends(start, of: DataFrame) -> DataFrame:        # an archive without bytes takes part, and is none
        return of.join(bytes_.withColumnRenamed("archive", "__archive"), (F.col("archive") == F.col("__archive")) & (
            F.col("at") + F.col("n") > start), "left").groupBy("archive")

    starts = ends(F.col("size") - TAIL, archives).applyInPandas(_directory_start, "archive string, start bigint")
    listed = _staged(ends(F.col("start"), starts).applyInPandas(
        _directory, "archive string, member string, method int, crc bigint, stored bigint, head bigint"), f"{folder}/directory")
    # A local header is 30 bytes, with the lengths of its name and extra field at 26.
    heads = listed.select("archive", "head", (F.col("head") + 26).alias("begin"), (F.col("head") + 30).alias("end")).distinct()
    of_head = F.sort_array(F.collect_list(F.struct("place", F.hex("data").alias("hex"))))
    lengths = _parts(pieces, heads).groupBy("archive", "head").agg(
        F.rpad(F.concat_ws("", F.transform(of_head, lambda x: x["hex"])), 8, "0").alias("hex"))

    def number(at: int):
        return F.coalesce(F.conv(F.concat(F.substring("hex", at + 2, 2), F.substring("hex", at, 2)), 16, 10).cast("bigint"), F.lit(0))

    begin = F.col("head") + 30 + number(1) + number(5)
    members = _staged(listed.join(lengths, ["archive", "head"], "left").join(archives, "archive").select(
        "archive", "member", "method", "crc", begin.alias("begin"),
        F.least(begin + F.col("stored"), "size").alias("end")), f"{folder}/members")
    names = ["archive", "member", "method", "crc"]
    slices = _parts(pieces, members).select(*names, (F.col("place") - F.col("begin")).alias("slice"), "data").unionByName(
        members.where("begin >= end").select(*names, F.lit(0).cast("bigint").alias("slice"), F.lit(b"").alias("data")))
    # Many tasks write the members of one archive, and many a large one.
    out = _staged(slices.repartition("archive", "member", "slice"), staged or scratch_path(spark, "members"))
    fs, path = hadoop_fs(spark, folder)
    fs.delete(path, True)
    return out


def _drained(z, slices):
    for data in slices:
        if z.eof:
            break
        yield z.decompress(data, PIECE)
        while not z.eof and not z.needs_input:
            yield z.decompress(b"", PIECE)


def _inflated(method: int, slices):
    """Pieces of a member's contents, from its slices in order."""
    if method == DEFLATED:
        z = zlib.decompressobj(-15)
        for data in slices:
            yield z.decompress(data, PIECE)
            while z.unconsumed_tail:            # a part of one slice, so its copies stay small
                yield z.decompress(z.unconsumed_tail, PIECE)
        yield z.flush()
    elif method == BZIPPED:
        yield from _drained(bz2.BZ2Decompressor(), slices)
    elif method == LZMA:
        slices, head = iter(slices), b""        # a version, the size of the properties and these
        for data in slices:
            head += data
            size = 4 + int.from_bytes(head[2:4], "little")
            if len(head) > size:
                kind = lzma._decode_filter_properties(lzma.FILTER_LZMA1, head[4:size])
                yield from _drained(lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[kind]), chain([head[size:]], slices))
                break
    else:
        yield from slices


def _line_batches(batches):
    """Numbered lines of members, whose slices come in order, a piece of a few megabytes at a time."""
    columns = ["archive", "member", "number", "line"]
    slices = ((key, data[i:i + SLICE]) for key, data in _runs(batches, ["archive", "member", "method", "crc"])
              for i in range(0, max(len(data), 1), SLICE))
    for (archive, member, method, crc), of_member in groupby(slices, key=lambda s: s[0]):
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        newlines = io.IncrementalNewlineDecoder(decoder, translate=True)
        rest, number, check = "", 0, 0

        def rows(lines, number, archive=archive, member=member):
            return pa.RecordBatch.from_arrays(
                [pa.array([archive] * len(lines), pa.string()), pa.array([member] * len(lines), pa.string()),
                 pa.array(range(number, number + len(lines)), pa.int64()), pa.array(lines, pa.string())], columns)

        for piece in _inflated(method, (data for _, data in of_member)):
            check = zlib.crc32(piece, check)
            lines = (rest + newlines.decode(piece)).split("\n")
            rest = lines.pop()
            if lines:
                yield rows(lines, number)
                number += len(lines)
        if check != crc:
            raise ValueError(f"{archive}: member {member} is damaged")
        rest += newlines.decode(b"", final=True)
        if rest:
            lines = rest.split("\n")
            yield rows(lines if lines[-1] else lines[:-1], number)


def member_lines(members: DataFrame) -> DataFrame:
    """(archive, member, number, line): the text lines of staged members."""
    keys = ["archive", "member", "method", "crc"]
    starts = F.sequence(F.lit(1), F.greatest(F.length("data"), F.lit(1)), F.lit(ROW))
    ordered = members.select(*keys, "slice", "data").repartition("archive", "member").sortWithinPartitions(*keys, "slice")
    return ordered.select(*keys, "data", F.explode(starts).alias("start")).select(
        *keys, F.substring("data", F.col("start"), F.lit(ROW)).alias("data")).mapInArrow(
            _line_batches, "archive string, member string, number bigint, line string")


def _segments(path: Column) -> Column:
    return F.split(path, "/")


def resolved(member: Column, dest: str) -> Column:
    """Segments of ``dest/member`` after resolving ``.``, ``..`` and empty parts.

    An absolute member ignores ``dest``; ``..`` at the root stays at the root.
    """
    dest_segs = [s for s in dest.split("/") if s not in ("", ".")]
    base = F.when(member.startswith("/"), F.array().cast("array<string>")).otherwise(
        F.array(*[F.lit(s) for s in dest_segs]).cast("array<string>"))
    start = F.array().cast("array<string>")
    segs = F.concat(base, _segments(member))

    def step(acc: Column, x: Column) -> Column:
        return (F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                .when((x == "") | (x == "."), acc)
                .otherwise(F.concat(acc, F.array(x))))
    return F.aggregate(segs, start, step)


def member_is_safe(member: Column, dest: str) -> Column:
    """True iff ``dest/member`` resolves to ``dest`` or to a path below it."""
    dest_segs = [s for s in dest.split("/") if s not in ("", ".")]
    res = resolved(member, dest)
    n = len(dest_segs)
    prefix = F.array(*[F.lit(s) for s in dest_segs]).cast("array<string>")
    return (F.size(res) >= n) & (F.slice(res, 1, n) == prefix) if n else F.lit(True)


def guard(members: DataFrame, dest: str, archive: str = "archive",
          member: str = "member") -> DataFrame:
    """Per archive: member count, unsafe count and whether the archive is accepted.

    One unsafe member rejects the whole archive.
    """
    unsafe = (~member_is_safe(F.col(member), dest)).cast("int")
    return (members.groupBy(archive)
            .agg(F.count(F.lit(1)).alias("members"), F.sum(unsafe).alias("unsafe_members"))
            .withColumn("accepted", F.col("unsafe_members") == 0))


def accepted_members(members: DataFrame, dest: str, archive: str = "archive",
                     member: str = "member") -> DataFrame:
    """Members of accepted archives only (all-or-nothing per archive)."""
    verdict = guard(members, dest, archive, member).where("accepted").select(archive)
    return members.join(verdict, on=archive, how="left_semi")
