"""Spelling variants: words one edit apart, compared in dense prefix-suffix tiles.

Words are maximal runs of letters.  Their counts are taken by Arrow per few
megabytes of text and added up by Spark, first per task.  Two words are near if one
code point inserted, deleted or replaced turns one into the other, which is so if
and only if their common prefix and common suffix together reach the longer length
minus one.  That is what a tile computes: two blocks of words as padded
code-point matrices, one from the left and one from the right, give the common
prefixes and suffixes of all their pairs at once.

Which words share a tile: for a longer length M the places 0 to M-1 are cut into
segments of two, and for lengths over 32 into 16 even ones.  The edit of a pair is
at the first place where they differ, which lies in one segment; before and behind
that segment the two agree.  So each word of length M or M-1 goes, for each
segment, to the tile group of (M, segment, what stands before and behind it), and
all pairs come together once, in the group of their edit.  A segment of two places
leaves at most 90 squared plus 90 words of a group whatever the corpus, as there
are 90 letters; a group of more than ``most`` words, possible with longer words, is
cut into blocks whose pairs are compared in tasks of their own.  Only near pairs
leave a tile.

A word's form is its near word of largest count.  Roots are found by doubling the
links word -> form; counts grow at least ``ratio``-fold along them, so the number of
rounds follows from the largest count.

Defined cases: null texts and texts without a letter have no words; a null id
counts as an empty one; repeated rows count again; an empty table gives an empty
result.  Runs and texts of any length are taken whole: matrices are padded to the
longest word of a tile, whose rows get fewer as words get longer.  Only the id and
text columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportflow.llm.bytetext import buffers, chunks, lower
from reportflow.session import ensure_checkpoint_dir, scratch_path

WIDTH, MOST_SEGMENTS = 2, 16
TILE = 128
MOST = 8192


def _letter_runs(d: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of A-Z, a-z and U+00C0 to U+00FF (0xC3 and a byte in UTF-8)."""
    inside = (d | 32) - np.uint8(97) < 26
    lead = d == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(d) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[o] = True
    at = np.flatnonzero(edge)
    a, b = at[:-1], at[1:]
    keep = inside[a] if len(a) else np.zeros(0, bool)
    return a[keep], b[keep]


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()
_LONG = 48


def _crc32(d: np.ndarray, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """crc32 of the byte ranges, carried on from the crc32 of what stands before each."""
    crc = ~start.astype(np.uint32)
    order = np.argsort(a - b, kind="stable")            # longest first
    lengths = (b - a)[order]
    step = np.minimum(lengths, _LONG)
    state, place = crc[order], a[order].copy()
    for k in range(int(step.max()) if len(step) else 0):
        n = int(np.searchsorted(-lengths, -k, side="left"))          # those longer than k
        state[:n] = _CRC[(state[:n] ^ d[place[:n]]) & 0xFF] ^ (state[:n] >> np.uint32(8))
        place[:n] += 1
    out = np.empty_like(state)
    out[order] = ~state
    for i in np.flatnonzero(b - a > _LONG):
        out[i] = zlib.crc32(d[a[i] + _LONG:b[i]].tobytes(), int(out[i]))
    return out


def _count_words(every: int):
    """Map pass: (word, n) per few megabytes, with the letter that every ``every``-th run loses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"" if x is None else x.encode() for x in batch.column(0).to_pylist()]
            data, off = buffers(batch.column(1))
            for first, last, d, o in chunks(data, off):
                d = lower(d)
                a, b = _letter_runs(d, o)
                doc = np.searchsorted(o, a, side="right") - 1
                if every:
                    head = np.array([zlib.crc32(x + b":") for x in ids[first:last]], np.uint32)
                    h = _crc32(d, a, b, head[doc])
                    lose = np.flatnonzero(h % np.uint32(every) == 0)
                else:
                    lose = np.zeros(0, np.int64)
                changed = []
                for i in lose:
                    word = d[a[i]:b[i]].tobytes().decode()
                    k = int(h[i]) % len(word)
                    changed.append(word[:k] + word[k + 1:])
                keep = np.ones(len(a), bool)
                keep[lose] = False
                a, b = a[keep], b[keep]
                cover = np.zeros(len(d) + 1, np.int8)
                cover[a] += 1
                cover[b] -= 1
                letters = d[np.cumsum(cover[:-1], dtype=np.int8) > 0]
                ends = np.concatenate([[0], np.cumsum(b - a)])
                words = pa.LargeStringArray.from_buffers(
                    len(a), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters))
                counts = pa.concat_arrays([words, pa.array(changed, pa.large_string())]).value_counts()
                yield pa.RecordBatch.from_arrays(
                    [counts.field("values").cast(pa.string()), counts.field("counts")], ["word", "n"])

    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199,
                least_length: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n): the letter runs of all texts, A-Z in lower case, with their counts.

    Where ``every`` divides h = crc32 of ``<id>:<run>``, the run loses its code
    point h modulo its length (``every`` 0: none does).  Words of fewer than
    ``least_length`` code points or ``least_count`` occurrences are left out.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    found = rows.mapInArrow(_count_words(every), "word string, n bigint")
    return (found.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least_count))


def _segments(longer: Column) -> Column:
    """(start, end) of each segment of the places of a longer word."""
    count = F.least(F.ceil(longer / F.lit(WIDTH)).cast("int"), F.lit(MOST_SEGMENTS))
    count = F.when(longer > 2 * MOST_SEGMENTS, F.lit(MOST_SEGMENTS)).otherwise(count)
    at = lambda j: F.floor(j * longer / count).cast("int")              # noqa: E731
    return F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.struct(
        at(j).alias("a"), at(j + 1).alias("b")))


def _keyed(words: DataFrame) -> DataFrame:
    """Each word in each of its tile groups: (group, longer, a, b, word, n)."""
    size = F.char_length("word")
    x = words.withColumn("longer", F.explode(F.array(size, size + 1)))
    x = x.withColumn("s", F.explode(_segments(F.col("longer")))).select("word", "n", "longer", "s.a", "s.b")
    behind = F.col("longer") - F.col("b")
    key = F.xxhash64("longer", "a", F.substring(F.col("word"), F.lit(1), F.col("a")),
                     F.when(behind > 0, F.right(F.col("word"), behind)).otherwise(""))
    return x.select(key.alias("group"), "longer", "a", "b", "word", "n")


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words padded to ``width``, from the left and from the right, and lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.zeros((len(words), width), np.uint32)
    left[row, column] = points
    right = np.zeros((len(words), width), np.uint32)
    right[row, width - lengths[row] + column] = points
    return left, right, lengths


def _common(x: np.ndarray, y: np.ndarray, columns) -> np.ndarray:
    """How many of the columns, one after the other, agree for each pair of rows."""
    same, total = np.ones((len(x), len(y)), bool), np.zeros((len(x), len(y)), np.int32)
    for k in columns:
        same &= x[:, k][:, None] == y[:, k][None, :]
        if not same.any():
            break
        total += same
    return total


def _tile(x: tuple, y: tuple, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of all pairs of two blocks, and which pairs are a single edit apart."""
    prefix, suffix = _common(x[0], y[0], range(width)), _common(x[1], y[1], range(width - 1, -1, -1))
    a, b = x[2][:, None], y[2][None, :]
    longer = np.maximum(a, b)
    prefix, suffix = np.minimum(prefix, np.minimum(a, b)), np.minimum(suffix, np.minimum(a, b))
    return prefix, (np.abs(a - b) <= 1) & (prefix < longer) & (prefix + suffix >= longer - 1)


_PAIR = "word string, n bigint, other string, m bigint"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map pass over rows sorted by group and side: near pairs of each group, both ways round.

    Side 0 and 1 are the blocks of a cut group, of which only pairs across are
    compared; other groups have side -1 and are compared within.  A group is held
    whole, which is at most ``most`` words, or two blocks of them.
    """
    held, group = [], None

    def groups():
        nonlocal held, group
        for batch in batches:
            t = pa.Table.from_batches([batch])
            g = np.stack([t[c].to_numpy() for c in ("group", "pair")])
            cut = np.flatnonzero(np.any(g[:, 1:] != g[:, :-1], axis=0)) + 1
            for a, b in zip([0, *cut], [*cut, len(t)], strict=True):
                if a == b:
                    continue
                if group is not None and tuple(g[:, a]) != group:
                    yield pa.concat_tables(held)
                    held = []
                group = tuple(g[:, a])
                held.append(t.slice(a, b - a))
        if held:
            yield pa.concat_tables(held)

    waiting: list[pa.Table] = []
    rows = 0
    for t in groups():
        if len(t) > 1:                      # many small groups share a tile
            waiting.append(t)
            rows += len(t)
        if rows >= TILE:
            yield _near(waiting)
            waiting, rows = [], 0
    if waiting:
        yield _near(waiting)


def _near(tables: list[pa.Table]) -> pa.RecordBatch:
    """Near pairs of rows of the same group."""
    t = pa.concat_tables(tables)
    which = np.repeat(np.arange(len(tables)), [len(x) for x in tables])
    words, n = t["word"].to_pylist(), t["n"].to_numpy()
    a, b, longer, side = (t[c].to_numpy() for c in ("a", "b", "longer", "side"))
    rows = max(1, TILE * 64 // max(64, int(longer.max())))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(0, len(words), rows):
        p = slice(i, min(i + rows, len(words)))
        width = int(longer[p].max())
        x = _matrices(words[p], width)
        end = int(np.searchsorted(which, which[p.stop - 1], side="right"))
        for j in range(i, end, rows):
            q = slice(j, min(j + rows, end))
            wide = max(width, int(longer[q].max()))
            y = _matrices(words[q], wide)
            prefix, near = _tile(_matrices(words[p], wide) if wide > width else x, y, wide)
            for c in (which, a, longer):
                near &= c[p][:, None] == c[q][None, :]
            # The edit lies in this segment, the longer word has the group's length, a cut group's
            # pair is across, and each pair of rows is taken once.
            near &= (a[p][:, None] <= prefix) & (prefix < b[p][:, None])
            near &= np.maximum(x[2][:, None], y[2][None, :]) == longer[p][:, None]
            near &= (side[p][:, None] < 0) | (side[p][:, None] != side[q][None, :])
            u, v = np.nonzero(near)
            u, v = u + p.start, v + q.start
            once = u < v
            found.append((u[once], v[once]))
    u, v = (np.concatenate(z) for z in zip(*found, strict=True))
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    word = pa.array(words, pa.string())
    return pa.RecordBatch.from_arrays(
        [pc.take(word, pa.array(u)), pa.array(n[u]), pc.take(word, pa.array(v)), pa.array(n[v])],
        ["word", "n", "other", "m"])


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n, other, m): every pair of words (word, n) a single edit apart, both ways round."""
    rows = _keyed(words)
    # Groups of more than ``most`` words are cut into blocks by a hash of the word, and their pairs
    # of blocks dealt; of a pair (i, j) a row knows which side it is on.
    # They are written, so that Spark knows their size (mostly none) and need not shuffle for them.
    path = scratch_path(words.sparkSession, "spelling")
    rows.groupBy("group").count().filter(F.col("count") > most).select(
        "group", F.ceil(F.col("count") / (most // 2)).cast("int").alias("blocks")).write.parquet(path)
    x = rows.join(words.sparkSession.read.parquet(path), "group", "left")
    mine = F.pmod(F.xxhash64("word", F.lit(12)), F.col("blocks")).cast("int")
    pairs = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(-1).alias("pair"), F.lit(-1).alias("side")))) \
        .otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
            (F.least(k, mine) * F.col("blocks") + F.greatest(k, mine)).alias("pair"),
            F.when(k == mine, -1).when(k > mine, 0).otherwise(1).alias("side"))))
    x = x.withColumn("p", F.explode(pairs)).select("group", "longer", "a", "b", "word", "n", "p.pair", "p.side")
    x = x.repartition("group", "pair").sortWithinPartitions("longer", "group", "pair")
    return x.mapInArrow(_compare, _PAIR)


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199,
                      least_length: int = 6, least_count: int = 5, ratio: int = 5, most: int = MOST) -> DataFrame:
    """Per word: (word, form, root, n, n_near, form_n).

    ``form`` is the near word of largest count (ties: smallest in code point
    order) if that is at least ``ratio`` times the word's, ``root`` the last word
    along the forms (the word itself if it has none).
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: counts have to grow along the forms")
    ensure_checkpoint_dir(docs.sparkSession)
    words = count_words(docs, id_col, text_col, every, least_length, least_count).checkpoint()
    near = near_words(words, most).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    out = words.join(near, "word", "left").withColumn(
        "takes", F.coalesce(-F.col("best.m") >= F.col("n") * ratio, F.lit(False))).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("takes"), F.col("best.other")).alias("form"),
        F.when(F.col("takes"), -F.col("best.m")).alias("form_n")).checkpoint()
    links = out.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    top = words.agg(F.max("n")).first()[0] or 1
    steps = int(math.log(max(top / max(least_count, 1), 1), ratio)) + 1
    for _ in range(math.ceil(math.log2(steps))):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")).checkpoint()
    return out.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
