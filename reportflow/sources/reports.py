"""Report scans (S1-S6): delimited reports with preambles and footers.

All values are read as text, and the input is read where it lies, never copied.
The place of a line is its split's start (``_metadata.file_block_start``) and its
order in the split.  A scan has these steps, all of them Spark jobs:

1. Lines per split are counted.  Of these counts (one row per split) running sums
   give every line of a file its number, however the file was split.
2. Per file: the header (the first non-blank line after the file's preamble,
   whatever its length), the place of the last non-blank lines (footer), whether a
   line leaves a quote open, and the first lines, from which the delimiter is
   sniffed.  Only these facts are kept, as small tables in the scratch folder, so
   that Spark knows their size.
3. The rows: one scan over all files, joined to the facts of each split, parsed once
   per line; columns are chosen by the file's header layout.  A record with more
   fields than its header is an error; with fewer, the missing fields are null.

A record is one line, or several if a quoted field holds line breaks.  In files
with a line that leaves a quote open, each line is a function from "inside quotes"
to "inside quotes"; these are composed inside each split and then over the splits
of the file, so a file of any size is cut into records by many tasks.  A task meets
the lines of a split in their order, and joins those of a record as it reads them;
only records that reach over splits are shuffled.

A report may be delivered in parts: a folder with its file name that holds the marker
``_PARTS`` and Spark's part files.  It is one file, whose lines run on from part to part.

Files have their own preamble each: ``preamble`` is a number or a mapping from file
names to numbers.  The driver lists folders and gets one row per distinct header
layout.  Lines of a split are numbered by ``monotonically_increasing_id``; should a
later read of a split number them differently (another split size set in between),
the scan fails rather than give other rows.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportflow.functions.text import normalise_headers
from reportflow.session import hadoop_fs, scratch_path
from reportflow.sources.archive import member_lines, stage_members

# The text tokens a pandas-1.x CSV read turns into nulls.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null")

FILE, PATH, SEQ = "_file", "_path", "_seq"
BLOCK, ROW, LINE, TEXT = "__block", "__row", "__line", "__text"
READ, START, KIND = "__read", "__start", "__kind"       # the file that was read, the split's start in it
PART, MEMBER = 1, 2             # kinds of what is read, beside whole files
PARTS = "_PARTS"                # hidden from Spark's readers, as it starts with an underscore
PART_SPAN = 1 << 40             # more than the bytes of any part
MEMBER_LINES = 200_000          # lines of an archive member that count as one split
_GLOB = re.compile(r"([\\*?\[\]{}])")


def list_files(spark: SparkSession, paths: str | Sequence[str],
               pattern: str = "*") -> list[str]:
    """File paths under directories, globs or files (driver-side listing only)."""
    return sorted(_listed(spark, paths, pattern))


def _listed(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> dict[str, bool]:
    """File paths, and whether each is a report in parts."""
    out: dict[str, bool] = {}
    for p in [paths] if isinstance(paths, str) else list(paths):
        fs, jp = hadoop_fs(spark, p)
        if fs.exists(jp):                    # a path that exists is meant literally
            found = [fs.getFileStatus(jp)] if fs.exists(jp.suffix(f"/{PARTS}")) else fs.listStatus(jp)
        else:
            found = fs.globStatus(jp)
        for st in found or []:
            name = st.getPath().getName()
            if fnmatch.fnmatchcase(name, pattern) and (
                    st.isFile() or fs.exists(st.getPath().suffix(f"/{PARTS}"))):
                out[st.getPath().toString()] = not st.isFile()
    hidden = [p for p in out if p.rsplit("/", 1)[-1].startswith(("_", "."))]
    if hidden:
        raise ValueError(f"Spark does not read files whose names start with _ or .: {sorted(hidden)[:5]}")
    return out


def literal(path: str) -> str:
    """A path for Spark's readers with its glob characters escaped."""
    return _GLOB.sub(r"\\\1", path)


def sniff_sep(first_lines: str, candidates: str = ",;") -> str:
    """Delimiter from the first two lines, as a CSV sniffer restricted to ``,;``."""
    try:
        return csv.Sniffer().sniff(first_lines, candidates).delimiter
    except csv.Error:
        counts = {c: first_lines.count(c) for c in candidates}
        return max(counts, key=counts.get)


def report_sep(line0: str | None, line1: str | None, header: str | None) -> str:
    """Delimiter of a report from its first two lines, or its header if they are preamble."""
    header = header or ""
    sep = sniff_sep("\n".join(x for x in (line0, line1) if x is not None) or ",")
    if sep not in header and max(header.count(c) for c in ",;") > 0:
        sep = max(",;", key=header.count)
    return sep


_FACTS = f"{PATH} string, {FILE} string, top bigint, tail bigint, head string, sep string, open int"


def _sniff(batches):
    for pdf in batches:
        seps = [report_sep(a, b, h) for a, b, h in zip(pdf["l0"], pdf["l1"], pdf["head"], strict=True)]
        opens = [a if s == "," else b for s, a, b in zip(seps, pdf["open0"], pdf["open1"], strict=True)]
        yield pdf[[PATH, FILE, "top", "tail", "head"]].assign(sep=seps, open=[int(x == 1) for x in opens])


def decoded_name(c: Column) -> Column:
    """File names in ``_metadata`` are URI-encoded; decode them (a literal ``+`` stays)."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def null_tokens(df: DataFrame, columns: Iterable[str] | None = None,
                tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Map pandas' default null tokens to null on the given (default: all) columns."""
    cols = set(columns) if columns is not None else set(df.columns)
    known = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)

    def spelt(name: str) -> str:
        c = "`" + name.replace("`", "``") + "`"
        return f"CASE WHEN {c} NOT IN ({known}) THEN {c} END AS {c}" if name in cols else c

    return df.selectExpr(*[spelt(c) for c in df.columns])


def _lines(spark: SparkSession, paths: list[str], names: Sequence[str] | None,
           members: DataFrame | None = None, parted: Iterable[str] = ()) -> DataFrame:
    """Physical lines of files and archive members with (file read, split, place in the split).

    What follows from these is worked out once a split (``_named``), not once a line.
    """
    parted = set(parted)
    zipped = [p for p in paths if p.lower().endswith(".zip")]
    plain = [p for p in paths if not p.lower().endswith(".zip")
             and (names is None or p.rsplit("/", 1)[-1] in names)]
    parts = []
    for kind, own in enumerate(([p for p in plain if p not in parted], [p for p in plain if p in parted])):
        if own:
            parts.append(spark.read.text([literal(p) for p in own]).select(
                F.col("_metadata.file_path").alias(READ), F.col("_metadata.file_block_start").alias(START),
                F.lit(kind).alias(KIND), F.monotonically_increasing_id().alias(ROW), F.col("value").alias(TEXT)))
    if zipped:
        if members is None:
            members = stage_members(spark, [literal(p) for p in zipped])
        if names is not None:                       # before anything is inflated
            members = members.where(F.element_at(F.split("member", "/"), -1).isin(*names))
        # A member is inflated by one task, so once only; later passes read its lines by many.
        inflated = _kept(member_lines(members), maxRecordsPerFile=MEMBER_LINES)
        parts.append(inflated.select(
            F.concat("archive", F.lit("!/"), "member").alias(READ),
            (F.col("number") - F.col("number") % MEMBER_LINES).alias(START), F.lit(MEMBER).alias(KIND),
            F.col("number").alias(ROW), F.col("line").alias(TEXT)))
    if not parts:
        raise FileNotFoundError(f"no files of the wanted names: {sorted(names or [])[:5]}")
    return reduce(DataFrame.unionByName, parts)


def _named(splits: DataFrame) -> DataFrame:
    """Splits with their report's path and file name, and their place in it."""
    part = F.regexp_extract(READ, r"/part-(\d+)[^/]*$", 1)
    x = splits.withColumn(PATH, F.when(F.col(KIND) == PART, F.regexp_replace(READ, "/[^/]*$", "")).otherwise(F.col(READ)))
    name = F.element_at(F.split(PATH, "/"), -1)
    return x.withColumns({
        FILE: F.when(F.col(KIND) == MEMBER, name).otherwise(decoded_name(name)),
        BLOCK: F.when(F.col(KIND) == PART, part.cast("bigint") * PART_SPAN + F.col(START)).otherwise(F.col(START))})


def _kept(df: DataFrame, **options) -> DataFrame:
    """A table written to the scratch folder; of a small one, Spark then knows the size."""
    path = scratch_path(df.sparkSession, "scan")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _quoted(sep: str) -> str:
    return rf"(^|{re.escape(sep)})\"[^\"]*+(?:\"\"[^\"]*+)*+\""


def _by_sep(seps: Sequence[str], make) -> Column:
    out = None
    for s in seps:
        out = F.when(F.col("sep") == s, make(s)) if out is None else out.when(F.col("sep") == s, make(s))
    return out


def _without_quoted(text: Column, sep: str) -> Column:
    """The text with each complete quoted field replaced by ``x``."""
    return F.when(text.contains('"'), F.regexp_replace(text, _quoted(sep), "$1x")).otherwise(text)


def _open_quote(text: Column, sep: str) -> Column:
    return F.regexp_replace(text, _quoted(sep), "$1x").rlike(rf"(^|{re.escape(sep)})\"").cast("int")


def _leaves_open(text: Column, sep: str) -> Column:
    """1 if a line that starts outside quotes ends inside them."""
    return F.when(text.contains('"'), _open_quote(text, sep)).otherwise(0)


def _stays_open(text: Column, sep: str) -> Column:
    """1 if a line that starts inside quotes ends inside them."""
    close = r"^[^\"]*+(?:\"\"[^\"]*+)*+\""
    rest = F.concat(F.lit("x"), F.regexp_replace(text, close, ""))
    return F.when(~text.rlike(close), 1).otherwise(_open_quote(rest, sep))


# What a line does: where it ends if it starts outside quotes (0) plus twice where if it starts inside (1).
FLIPS, KEEPS = 1, 2
NEVER = (1 << 63) - 1           # a line number that no file reaches


def _effect(seps: Sequence[str]) -> Column:
    text = F.col(TEXT)
    return F.when(text.contains('"'), _by_sep(seps, lambda s: _open_quote(text, s) + 2 * _stays_open(text, s))
                  ).otherwise(KEEPS).alias("effect")


def _states(effects: np.ndarray, start: int) -> np.ndarray:
    """The state after each line: that of the last line that sets it, flipped as often as lines since do."""
    flips = np.cumsum(effects == FLIPS)
    at = np.maximum.accumulate(np.where((effects == FLIPS) | (effects == KEEPS), -1, np.arange(len(effects))))
    return np.where(at < 0, start + flips, effects[at] // 3 + flips - flips[at]) & 1


_ENDS = "split bigint, end0 int, end1 int, closed bigint, open0 bigint, open1 bigint"


def _split_ends(batches):
    """What the lines of each split do together, if it starts outside (0) or inside (1) quotes.

    Its end from either start, the line that closes a quote open at its start, and the
    line (from either start) that begins the record still open at its end.
    """
    schema = pa.schema([(c, pa.int32() if t == "int" else pa.int64()) for c, t in (x.split() for x in _ENDS.split(", "))])
    run, last, met = None, -1, set()
    for batch in batches:
        split, line, effect = (batch.column(c).to_numpy() for c in ("split", LINE, "effect"))
        done = []
        cuts = [0, *(np.flatnonzero(np.diff(split)) + 1), len(split)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if run is None or run["split"] != split[a]:
                if run is not None:
                    done.append(run)
                    met.add(run["split"])
                run, last = {"split": int(split[a]), "end0": 0, "end1": 1, "closed": None, "open0": None, "open1": None}, -1
            if run["split"] in met or line[a] <= last or (np.diff(line[a:b]) <= 0).any():
                raise RuntimeError("lines of a split were read out of order")
            last = line[b - 1]
            for start in (0, 1):
                after = _states(effect[a:b], run[f"end{start}"])
                opens = np.flatnonzero(np.diff(after, prepend=run[f"end{start}"]) == 1)
                if len(opens):
                    run[f"open{start}"] = int(line[a + opens[-1]])
                if start and run["closed"] is None and not after.all():
                    run["closed"] = int(line[a + after.argmin()])
                run[f"end{start}"] = int(after[-1])
        yield pa.RecordBatch.from_pylist(done, schema)
    if run is not None:
        yield pa.RecordBatch.from_pylist([run], schema)


def _joined(batches):
    """Lines in order, which begin and end outside quotes, joined to records with the number of their first line."""
    columns, held, state = ["split", LINE, TEXT], [], 0
    for batch in batches:
        after = _states(batch.column("effect").to_numpy(), state)
        if not len(after):
            continue
        state = int(after[-1])
        ends = np.flatnonzero(after == 0) + 1
        batch = batch.select(columns)
        if not len(ends):
            held.append(batch)
            continue
        before = sum(b.num_rows for b in held)
        whole = pa.Table.from_batches([*held, batch.slice(0, ends[-1])]).combine_chunks()
        held = [batch.slice(ends[-1])] if ends[-1] < batch.num_rows else []
        if before or len(ends) < whole.num_rows:
            begins = np.concatenate([[0], ends[:-1] + before])
            split, line, text = (whole.column(c).combine_chunks() for c in columns)
            text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
            goes_on = np.ones(whole.num_rows, bool)
            goes_on[begins] = False
            goes_on = goes_on[1:]
            if ((np.diff(line.to_numpy()) != 1) | (np.diff(split.to_numpy()) != 0))[goes_on].any():
                raise RuntimeError("lines of a split were read out of order")
            lists = pa.ListArray.from_arrays(pa.array(np.append(begins, whole.num_rows), pa.int32()), text)
            whole = pa.table([split.take(pa.array(begins)), line.take(pa.array(begins)),
                              pc.binary_join(lists, "\n")], columns)
        yield from whole.to_batches()
    if held:
        raise RuntimeError("lines of a split were read out of order")


def _in_order(x: DataFrame, staged: bool) -> DataFrame:
    """Each split in one task and in its order: so files are read, but staged members lie in files that cut their splits."""
    return x.repartition("split").sortWithinPartitions("split", LINE) if staged else x


def _cut_splits(lines: DataFrame, splits: DataFrame, seps: Sequence[str], staged: bool) -> DataFrame:
    """The splits of files with open quotes, and what of them belongs to records that reach over splits.

    Lines up to ``head_to`` belong to the record begun at line ``carry``, in a split before;
    lines from ``tail_from`` on to a record that goes on in the next split.
    """
    x = _numbered(lines, F.broadcast(splits), "preamble", "sep", "split").where(F.col(LINE) >= F.col("preamble"))
    # Lines without a quote keep the state.  (A filter on the effect would work it out once more.)
    x = x.where(F.col(TEXT).contains('"')).select("split", LINE, _effect(seps))
    x = splits.join(_in_order(x, staged).mapInArrow(_split_ends, _ENDS), "split", "left")
    x = x.withColumns({"end0": F.coalesce("end0", F.lit(0)), "end1": F.coalesce("end1", F.lit(1))})
    before = W.partitionBy(PATH).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    flips = F.sum(F.when(F.col("end0") > F.col("end1"), 1).otherwise(0)).over(before)
    x = x.withColumn("flips", F.coalesce(flips, F.lit(0)))
    x = x.withColumn("set", F.when(F.col("end0") == F.col("end1"), (F.col("end0") + F.col("flips")) % 2))
    x = x.withColumn("start", (F.coalesce(F.last("set", ignorenulls=True).over(before), F.lit(0)) + F.col("flips")) % 2)
    inside = F.col("start") == 1
    x = x.withColumns({"end": F.when(inside, F.col("end1")).otherwise(F.col("end0")),
                       "head_to": F.when(inside, F.coalesce("closed", F.lit(NEVER))).otherwise(-1)})
    begun = F.when(F.col("end") == 1, F.when(inside, F.col("open1")).otherwise(F.col("open0")))
    x = x.withColumn("begun", begun).withColumn("carry", F.last("begun", ignorenulls=True).over(before))
    cut = _kept(x.select(*splits.columns, "end", "head_to", "carry", F.coalesce("begun", F.lit(NEVER)).alias("tail_from")))
    # A quote that the file never closes would swallow its rest: an error, as in the reference's reader.
    ends = cut.groupBy(PATH).agg(F.max_by("end", BLOCK).alias("end")).where("end = 1").select(PATH).limit(1).collect()
    if ends:
        raise ValueError(f"quoted field without an end in {ends[0][0]}")
    return cut


def _records(lines: DataFrame, cut: DataFrame, seps: Sequence[str], staged: bool) -> DataFrame:
    """Lines of files with open quotes joined to records: (path, file, line, text)."""
    facts = ("preamble", "sep", "split", "head_to", "carry", "tail_from")
    number = F.col(LINE)
    x = _numbered(lines, F.broadcast(cut), *facts).where(
        (number >= F.col("preamble")) & (number > F.col("head_to")) & (number < F.col("tail_from")))
    x = _in_order(x.select("split", LINE, _effect(seps), TEXT), staged).mapInArrow(
        _joined, f"split bigint, {LINE} bigint, {TEXT} string")
    within = x.join(F.broadcast(cut.select("split", PATH, FILE)), "split").select(PATH, FILE, LINE, TEXT)
    reaching = cut.where((F.col("head_to") >= 0) | (F.col("tail_from") < NEVER))
    pieces = _numbered(lines, F.broadcast(reaching), *facts).where(
        (number >= F.col("preamble")) & ((number <= F.col("head_to")) | (number >= F.col("tail_from"))))
    record = F.when(number <= F.col("head_to"), F.col("carry")).otherwise(F.col("tail_from"))
    over = pieces.groupBy(PATH, FILE, record.alias("record")).agg(F.concat_ws("\n", F.transform(
        F.sort_array(F.collect_list(F.struct(LINE, TEXT))), lambda r: r[TEXT])).alias(TEXT))
    return within.unionByName(over.select(PATH, FILE, F.col("record").alias(LINE), TEXT))


SPLITS = ("lo", "n", "before")


def _numbered(lines: DataFrame, splits: DataFrame, *facts: str) -> DataFrame:
    """Lines with their number in the file and the facts of their split."""
    place = F.col(ROW) - F.col("lo")
    number = F.when(place.between(0, F.col("n") - 1), place + F.col("before")).otherwise(F.raise_error(F.concat(
        F.lit("lines were numbered differently before, read with the same settings: "), F.col(PATH))).cast("bigint"))
    x = lines.drop(KIND).join(splits.select(READ, START, PATH, FILE, *SPLITS, *facts), [READ, START])
    x = x.withColumn(LINE, number).drop(READ, START, ROW, *SPLITS)
    first = (F.col(LINE) == 0) & F.startswith(F.col(TEXT), F.lit("\ufeff"))
    return x.withColumn(TEXT, F.when(first, F.substring(TEXT, 2, 1 << 30)).otherwise(F.col(TEXT)))


def _filled(text: str) -> Column:
    return F.ltrim(F.col(text), F.lit(" \t")) != ""


def _tail(records: DataFrame, footer: int) -> DataFrame:
    """(path, tail): the line at which the last ``footer`` records of a file begin."""
    if footer == 1:
        return records.groupBy(PATH).agg(F.max(LINE).alias("tail"))
    nth = F.row_number().over(W.partitionBy(PATH).orderBy(F.col(LINE).desc()))
    return (records.select(PATH, LINE).withColumn("nth", nth).where(F.col("nth") <= footer)
            .groupBy(PATH).agg(F.min(LINE).alias("tail")))


def _preambles(spark: SparkSession, preamble: int | Mapping[str, int]) -> tuple[Column, DataFrame | None]:
    """The preamble column, and the file table (name, lines) it comes from."""
    if isinstance(preamble, int):
        return F.lit(preamble), None
    return F.col("lines"), spark.createDataFrame(sorted(preamble.items()), f"{FILE} string, lines int")


def report_records(spark: SparkSession, paths: str | Sequence[str], preamble: int | Mapping[str, int] = 1,
                   footer: int = 0, sep: str | None = None, pattern: str = "*", multiline: bool = True,
                   names: Sequence[str] | None = None,
                   members: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list]:
    """Data records (path, file, layout, line, text), the headers of all files, and the layouts.

    Headers are rows (path, file, sep, header); a record's ``layout`` is the index
    of its file's (sep, header) in the layouts.  Blank records, headers and the last
    ``footer`` records of each file are left out.
    """
    listed = _listed(spark, paths, pattern)
    files = sorted(listed)
    if not files:
        raise FileNotFoundError(f"no report files under {paths}")
    if names is None and not isinstance(preamble, int):
        names = sorted(preamble)
    lines = _lines(spark, files, names, members, [p for p in files if listed[p]])
    splits = _named(lines.groupBy(READ, START, KIND).agg(F.min(ROW).alias("lo"), F.count(F.lit(1)).alias("n")))
    before = W.partitionBy(PATH).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    own, file_table = _preambles(spark, preamble)
    if file_table is not None:
        splits = splits.join(file_table, FILE)
    splits = _kept(splits.select(READ, START, PATH, FILE, BLOCK, F.monotonically_increasing_id().alias("split"), "lo", "n",
                                 own.alias("preamble"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))

    kinds = [",", ";"] if sep is None else [sep]
    body = (F.col(LINE) >= F.col("preamble")) & _filled(TEXT)
    x = _numbered(lines, splits, "preamble")
    # The list makes this a hash aggregate; strings alone would sort all lines by file first.
    facts = x.groupBy(PATH, FILE).agg(
        F.collect_list(F.when(F.col(LINE) <= 1, F.struct(LINE, TEXT))).alias("first"),
        F.min(F.when(body, F.col(LINE))).alias("top"), F.min_by(TEXT, F.when(body, F.col(LINE))).alias("head"),
        F.max(F.when(body, F.col(LINE)) if footer == 1 else F.lit(None).cast("bigint")).alias("tail"),
        *[F.max(F.when(body, _leaves_open(F.col(TEXT), k)).otherwise(0)).alias(f"open{i}")
          for i, k in enumerate(kinds)])
    if footer > 1:
        facts = facts.drop("tail").join(_tail(x.where(body), footer), PATH, "left")
    if sep is None:
        facts = facts.select("*", F.get(F.filter("first", lambda r: r[LINE] == 0), 0)[TEXT].alias("l0"),
                             F.get(F.filter("first", lambda r: r[LINE] == 1), 0)[TEXT].alias("l1"))
        facts = facts.drop("first").mapInPandas(_sniff, _FACTS)
    else:
        facts = facts.select(PATH, FILE, "top", "tail", "head", F.lit(sep).alias("sep"), F.col("open0").alias("open"))
    facts = _kept(facts)

    heads = facts.where(F.col("head").isNotNull()).select(PATH, FILE, "sep", F.col("head").alias("header"))
    head_goes_on = _by_sep(kinds, lambda k: _leaves_open(F.col("head"), k)).alias("goes_on")
    kinds_found = facts.select("sep", "head", "open", head_goes_on).distinct().collect()
    opened = multiline and any(r["open"] == 1 for r in kinds_found)
    layouts = sorted({(r["sep"], r["head"]) for r in kinds_found if r["head"] is not None})
    if opened:                              # there the header and the footer are records
        mine = facts.where("open = 1")
        seps = sorted({r["sep"] for r in kinds_found if r["open"] == 1})
        staged = any(p.lower().endswith(".zip") for p in files)
        cut_splits = _cut_splits(lines, splits.join(mine.select(PATH, "sep"), PATH), seps, staged)
        wide = _records(lines, cut_splits, seps, staged).where(_filled(TEXT))
        cut = mine.select(PATH, FILE, "sep", F.col("head").alias("header"), "top")
        if any(r["open"] == 1 and r["goes_on"] == 1 for r in kinds_found):
            long = mine.where(head_goes_on == 1).select(PATH, "top")
            long = wide.join(F.broadcast(long), PATH).where(F.col(LINE) == F.col("top")).select(PATH, TEXT)
            cut = cut.join(long, PATH, "left").withColumn("header", F.coalesce(TEXT, "header")).drop(TEXT)
        cut = _kept(cut.join(_tail(wide, footer), PATH, "left") if footer else
                    cut.withColumn("tail", F.lit(None).cast("bigint")))
        heads = heads.join(cut.select(PATH), PATH, "left_anti").unionByName(cut.select(*heads.columns))
        layouts = sorted((r[0], r[1]) for r in heads.select("sep", "header").distinct().collect())
    if not layouts:
        raise ValueError(f"no header found in the files under {paths}")
    table = spark.createDataFrame([(s, h, i) for i, (s, h) in enumerate(layouts)],
                                  "sep string, header string, layout int")
    of_file = heads.join(table, ["sep", "header"]).select(PATH, "layout")
    inside = (F.col(LINE) > F.col("top")) & (F.col("tail").isNull() | (F.col(LINE) < F.col("tail")))
    columns = [PATH, FILE, "layout", LINE, TEXT]
    tops = facts if not opened else facts.join(cut.select(PATH), PATH, "left_anti")
    plain = _kept(splits.join(tops.select(PATH, "top", "tail").join(of_file, PATH), PATH))
    out = _numbered(lines, plain, "top", "tail", "layout").where(inside & _filled(TEXT)).select(*columns)
    if opened:
        more = wide.join(F.broadcast(cut.select(PATH, "top", "tail").join(of_file, PATH)), PATH)
        out = out.unionByName(more.where(inside).select(*columns))
    return out, heads, layouts


def header_names(header: str, sep: str) -> list[str]:
    """Normalised column names of a header record."""
    return normalise_headers(next(csv.reader(io.StringIO(header), delimiter=sep), []))


BAD = "_bad"


def marked_scan(spark: SparkSession, paths: Sequence[str], preamble: int | Mapping[str, int] = 1, footer: int = 0,
                sep: str | None = None, names: Sequence[str] | None = None,
                members: DataFrame | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """A scan that flags what ``scan_reports`` fails on.

    Returns the rows with a flag ``_bad`` (more fields than the header), the headers
    (path, file, sep, header) of all files, and the columns of each (sep, header).
    """
    records, heads, layouts = report_records(spark, list(paths), preamble, footer, sep, names=names, members=members)
    df = _parse(records, layouts, mark=True)
    return (null_tokens(df, [c for c in df.columns if c not in (FILE, PATH, SEQ, BAD)]), heads,
            {(s, h): header_names(h, s) for s, h in layouts})


def scan_reports(spark: SparkSession, paths: str | Sequence[str], preamble: int | Mapping[str, int] = 1,
                 footer: int = 0, sep: str | None = None, pattern: str = "*",
                 map_null_tokens: bool = True, multiline: bool = True,
                 names: Sequence[str] | None = None) -> DataFrame:
    """All-text rows of every report file under ``paths``.

    Columns: the normalised headers (duplicates as pandas would name them),
    plus ``_file`` (file name), ``_path`` and ``_seq`` (order inside the file).
    Files with different headers get the columns of all, null where they lack one.
    ``preamble`` lines before the header are skipped, a number for all files or one
    for each name (then only files of these names are read).
    ``footer`` trailing rows are removed from each file.  ``multiline`` (default)
    takes line breaks inside quotes as part of a field; without it every line is a
    record.  Either holds for files of any size.  ZIP archives are read member by
    member; ``names`` keeps the files and members of these names.
    """
    records, _, layouts = report_records(spark, paths, preamble, footer, sep, pattern, multiline, names)
    df = _parse(records, layouts)
    if map_null_tokens:
        df = null_tokens(df, [c for c in df.columns if c not in (FILE, PATH, SEQ)])
    return df


def _parse(records: DataFrame, layouts: list[tuple[str, str]], mark: bool = False) -> DataFrame:
    """Records of all layouts parsed in one pass, their fields put in the columns of their layout."""
    names = [header_names(h, s) for s, h in layouts]
    layout, text = F.col("layout"), F.col(TEXT)
    seps = sorted({s for s, _ in layouts})
    of_sep = {s: [i for i, (t, _) in enumerate(layouts) if t == s] for s in seps}
    width = {s: max(len(names[i]) for i in of_sep[s]) for s in seps}

    def by_sep(make) -> Column:
        out = None
        for s in seps[:-1]:
            mine = layout.isin(*of_sep[s])
            out = F.when(mine, make(s)) if out is None else out.when(mine, make(s))
        return make(seps[-1]) if out is None else out.otherwise(make(seps[-1]))

    def fields_of(s: str) -> Column:
        return F.size(F.split(_without_quoted(text, s), re.escape(s)))

    def row_of(s: str) -> Column:
        return F.from_csv(text, ", ".join(f"c{i} string" for i in range(width[s])),
                          {"sep": s, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1",
                           "maxColumns": str(width[s] + 1)})

    widths = F.element_at(F.array(*[F.lit(len(n)) for n in names]), layout + 1)
    long = by_sep(fields_of) > widths
    fits = F.when(~long, True).otherwise(F.raise_error(F.concat(
        F.lit("record with more fields than its header in "), F.col(PATH), F.lit(", line "),
        (F.col(LINE) + 1).cast("string"))).cast("boolean"))
    x = records if mark else records.where(fits)
    rows = {s: f"__r{k}" for k, s in enumerate(seps)}
    x = x.withColumns({rows[s]: row_of(s) if len(seps) == 1 else F.when(layout.isin(*of_sep[s]), row_of(s))
                       for s in seps} | ({BAD: long} if mark else {}))

    def column(name: str) -> Column:
        at: dict[tuple[str, int], list[int]] = {}
        for i, (s, _) in enumerate(layouts):
            if name in names[i]:
                at.setdefault((s, names[i].index(name)), []).append(i)
        out = None
        for (s, k), mine in at.items():
            value = F.col(f"{rows[s]}.c{k}")
            if len(mine) == len(layouts):
                return value.alias(name)
            out = F.when(layout.isin(*mine), value) if out is None else out.when(layout.isin(*mine), value)
        return out.alias(name)

    return x.select(*[column(n) for n in dict.fromkeys(n for x in names for n in x)], FILE, PATH,
                    F.struct(F.col(LINE).alias("line")).alias(SEQ), *([BAD] if mark else []))


def file_prefix(c: str | Column = FILE, sep: str = "_") -> Column:
    """The file name before its first ``sep`` (e.g. the BSC of a log file)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.split(col, sep, 2).getItem(0)


def listing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files under ``paths`` as a DataFrame (path, name, length) without reading contents."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .load(paths if isinstance(paths, str) else list(paths)))
    return df.select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("name"),
                     F.col("length"))
