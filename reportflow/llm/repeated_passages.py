"""Suffix-array dedup: every repeated passage but its first occurrence goes.

A byte is removed when a string of ``length`` bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same document.

The text of a 100 TB corpus has one suffix per byte, so the suffix order is built
only where it can matter, and in pieces that fit a task:

1. Every string of ``length`` bytes has an anchor, its 48-byte substring of
   smallest hash.  Neighbouring strings mostly share an anchor; such a run (about
   100 + 27 bytes) is the unit of the first pass.  Runs meet by anchor.  Equal runs
   are decided at once (all but the first are repeats) and an anchor with one kind
   of run needs nothing more.
2. Anchors with different runs are contested.  The first occurrence of each of their
   runs goes, as text, to buckets by anchor, and each bucket builds the suffix order of its strings, their common
   prefixes and from them the longest-previous-factor array: a suffix's longest
   earlier match is shared with the nearest suffix, before or after it in suffix
   order, that starts earlier in the corpus (previous and next smaller positions).
   A factor of ``length`` or more is a repeat.
3. An anchor with many kinds of run (a very common line) is not gathered: its
   strings go one by one, by hash and with their first position, aggregated in
   each chunk before the shuffle.

Repeats come back as ranges per document, and one last pass cuts the texts.

Defined cases: a null text counts as empty; documents shorter than ``length``
lose nothing; ids must be integers, a null id comes last; rows that share an id
are ordered by a checksum of their text, and rows equal in both count as one
document; an empty table gives an empty result.  Only the id and text columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm import bitmap
from reportflow.llm.bytetext import (
    _LETTER, buffers, chunks, from_planes, mix, planes, spans_hash,
)
from reportflow.session import ensure_checkpoint_dir

ANCHOR = 48
PIECE = 2 << 20
MANY_LOCAL = 4             # kinds of run of an anchor in one chunk that make it common
MANY = 256                 # and in the whole corpus
ENTRIES_PER_BUCKET = 400_000
STRINGS_PER_BUCKET = 200_000
_LAST = np.iinfo(np.int64).max


def pieces(data: np.ndarray, off: np.ndarray, length: int):
    """Chunks of documents; a longer document comes in overlapping pieces.

    Yields (bytes, offsets, document numbers, place of each part in its document).
    """
    for a, b, d, o in chunks(data, off, PIECE):
        if len(d) <= 2 * PIECE:
            yield d, o, np.arange(a, b), np.zeros(b - a, np.int64)
            continue
        for i in range(a, b):
            x = d[o[i - a]:o[i - a + 1]]
            for start in range(0, max(len(x) - length + 1, 1), PIECE):
                part = x[start:start + PIECE + length - 1]
                yield part, np.array([0, len(part)]), np.array([i]), np.array([start])


def _rolling(d: np.ndarray) -> np.ndarray:
    """Polynomial hash of the ``ANCHOR`` bytes from each place on, by doubling widths."""
    part, base, width = _LETTER[d], 0x9E3779B97F4A7C15, 1
    whole, done = None, 0
    while True:
        if ANCHOR & width:
            whole = part if whole is None else part[:len(part) - done] * np.uint64(
                pow(0x9E3779B97F4A7C15, done, 1 << 64)) + whole[width:]
            n = len(d) - done - width + 1
            whole, done = whole[:n], done + width
        if 2 * width > ANCHOR:
            return whole
        part = part[:-width] * np.uint64(base) + part[width:]
        base, width = base * base % (1 << 64), 2 * width


def runs(d: np.ndarray, o: np.ndarray, length: int):
    """Runs of strings that share an anchor: (anchor hashes, first starts, numbers of strings)."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(d) < length:
        return none
    h = mix(_rolling(d))
    low = np.uint64((1 << 24) - 1)
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span, reach = length - ANCHOR + 1, 1
    while 2 * reach <= span:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if span > reach:
        best = np.minimum(best[:len(best) - (span - reach)], best[span - reach:])
    inside = np.zeros(len(best) + 1, np.int32)             # strings within one document
    ok = np.diff(o) >= length
    np.add.at(inside, o[:-1][ok], 1)
    np.add.at(inside, o[1:][ok] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
    if not len(at):
        return none
    place = (best[at] & low).astype(np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(fresh)
    return h[place[first]], at[first], np.diff(np.append(first, len(at)))


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    return ids, batch.column(1).to_numpy(zero_copy_only=False)


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Starts of groups of equal values in sorted columns."""
    fresh = np.ones(len(columns[0]), bool)
    if len(fresh) > 1:
        fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(fresh)


def _later(start: np.ndarray, n: int, *position: np.ndarray) -> np.ndarray:
    """Entries of sorted groups that lie strictly after the first of their group."""
    first = np.repeat(start, np.diff(np.append(start, n)))
    return np.logical_or.reduce([p != p[first] for p in position]) if n else np.zeros(0, bool)


def _blob(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    out = []
    for part in np.split(order, cut):
        if len(part):
            cells = [planes(c[part]) for c in columns]
            out.append((kind, int(bucket[part[0]]), *cells, *[b""] * (6 - len(cells))))
    return out


def _yield_blobs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             *[pa.array([r[k] for r in rows], pa.binary()) for k in range(2, 8)]],
            ["kind", "bucket", "a", "b", "c", "d", "e", "f"])


_BLOBS = "kind int, bucket int, a binary, b binary, c binary, d binary, e binary, f binary"
_RANGES = "kind int, doc bigint, tie int, start bigint, n bigint"


def _ranges(kind: int, doc, tie, start, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(doc), kind, np.int32)), pa.array(doc.astype(np.int64)),
         pa.array(tie.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(n.astype(np.int64))],
        ["kind", "doc", "tie", "start", "n"])


def _local(d, o, number, place, ids, ties, length):
    """Runs of a piece in order of (anchor, run, position), with positions in the corpus."""
    anchor, at, n = runs(d, o, length)
    run = spans_hash(d, at, at + n + length - 1, seed=4)
    part = np.searchsorted(o, at, side="right") - 1
    doc, tie = ids[number[part]], ties[number[part]]
    start = at - o[part] + place[part]
    order = np.lexsort((start, tie, doc, run, anchor))
    return tuple(x[order] for x in (anchor, run, doc, tie, start, n, at))


def _first_pass(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = _documents(batch)
            data, off = buffers(batch.column(2))
            for piece in pieces(data, off, length):
                anchor, hash_, doc, tie, start, n, _ = _local(*piece, ids, ties, length)
                if not len(anchor):
                    continue
                same = _groups(anchor, hash_)
                gone = _later(same, len(anchor), doc, tie, start)
                rows = _blob(1, np.full(int(gone.sum()), int(anchor[0] % np.uint64(buckets)), np.int64),
                             doc[gone], tie[gone], start[gone].astype(np.int32), n[gone].astype(np.int32))
                anchor, hash_, doc, tie, start, n = [x[same] for x in (anchor, hash_, doc, tie, start, n)]
                by = _groups(anchor)
                kinds = np.diff(np.append(by, len(anchor)))
                common = np.repeat(kinds > MANY_LOCAL, kinds)
                mark = anchor[by[kinds > MANY_LOCAL]]
                rows += _blob(2, (mark % np.uint64(buckets)).astype(np.int64), mark)
                keep = ~common
                rows += _blob(0, (anchor[keep] % np.uint64(buckets)).astype(np.int64), anchor[keep], hash_[keep],
                              doc[keep], tie[keep], start[keep].astype(np.int32), n[keep].astype(np.int32))
                yield from _yield_blobs(rows)
    return run


def _gather(batches: Iterator[pa.RecordBatch], types: dict[int, tuple]) -> Iterator:
    """Blobs as (kind, bucket, arrays)."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            kind = row[0]
            yield kind, row[1], [from_planes(row[2 + i], t) for i, t in enumerate(types[kind])]


def _decide_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce pass: ranges that repeat (kind 0), first runs of contested anchors (1), common anchors (2)."""
    parts: dict[int, dict[int, list]] = {}
    types = {0: (np.uint64, np.uint64, np.int64, np.int32, np.int32, np.int32),
             1: (np.int64, np.int32, np.int32, np.int32), 2: (np.uint64,)}
    for kind, bucket, x in _gather(batches, types):
        if kind == 1:
            yield _ranges(0, *x)
        else:
            parts.setdefault(bucket, {0: [], 2: []})[kind].append(x)
    for bucket in sorted(parts):
        got = parts.pop(bucket)
        marked = np.unique(np.concatenate([x[0] for x in got[2]])) if got[2] else np.zeros(0, np.uint64)
        if got[0]:
            anchor, hash_, doc, tie, start, n = [np.concatenate(x) for x in zip(*got[0], strict=True)]
            order = np.lexsort((start, tie, doc, hash_, anchor))
            anchor, hash_, doc, tie, start, n = [x[order] for x in (anchor, hash_, doc, tie, start, n)]
            same = _groups(anchor, hash_)
            gone = _later(same, len(anchor), doc, tie, start)
            yield _ranges(0, doc[gone], tie[gone], start[gone], n[gone])
            anchor, hash_, doc, tie, start = [x[same] for x in (anchor, hash_, doc, tie, start)]
            by = _groups(anchor)
            kinds = np.diff(np.append(by, len(anchor)))
            marked = np.union1d(marked, anchor[by[kinds > MANY]])
            calm = np.repeat(kinds > 1, kinds) & ~np.isin(anchor, marked)
            first = _occurrence(*[x[calm] for x in (anchor, hash_, doc, tie, start)])
            zero = np.zeros(len(first), np.int64)
            yield _ranges(1, first.view(np.int64), zero, zero, zero)
        zero = np.zeros(len(marked), np.int64)
        yield _ranges(2, marked.view(np.int64), zero, zero, zero)


def _occurrence(anchor, run, doc, tie, start) -> np.ndarray:
    """A hash for one occurrence of a run."""
    h = mix(anchor ^ mix(run))
    for x in (doc, tie, start):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + x.astype(np.int64).view(np.uint64))
    return h


def _second_pass(length: int, buckets: int, firsts: np.ndarray, common: np.ndarray):
    """Map pass: first runs of contested anchors as text (kind 0), strings of common ones by hash (2).

    The bitmaps let a few other runs through, which changes nothing: all that is
    sent is compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = _documents(batch)
            data, off = buffers(batch.column(2))
            for piece in pieces(data, off, length):
                anchor, hash_, doc, tie, start, n, at = _local(*piece, ids, ties, length)
                if not len(anchor):
                    continue
                first = _groups(anchor, hash_)
                anchor, hash_, doc, tie, start, n, at = [
                    x[first] for x in (anchor, hash_, doc, tie, start, n, at)]
                hot = bitmap.contains(common, anchor)
                hit = hot | bitmap.contains(firsts, _occurrence(anchor, hash_, doc, tie, start))
                anchor, doc, tie, start, n, at, hot = [x[hit] for x in (anchor, doc, tie, start, n, at, hot)]
                raw, rows = piece[0].tobytes(), []
                calm = np.flatnonzero(~hot)
                spot = (anchor[calm] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(spot, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(spot[order])) + 1):
                    if len(part):
                        x = calm[part]
                        text = b"".join(raw[at[i]:at[i] + n[i] + length - 1] for i in x)
                        rows.append((0, int(spot[part[0]]), planes(doc[x]), planes(tie[x]),
                                     planes(start[x].astype(np.int32)), planes(n[x].astype(np.int32)), text, b""))
                x = np.flatnonzero(hot)
                if len(x):
                    move = np.arange(n[x].sum()) - np.repeat(np.cumsum(n[x]) - n[x], n[x])
                    who = np.repeat(x, n[x])
                    begin = at[who] + move
                    one = spans_hash(piece[0], begin, begin + length, seed=5)
                    two = spans_hash(piece[0], begin, begin + length, seed=6)
                    pos = start[who] + move
                    order = np.lexsort((pos, tie[who], doc[who], two, one))
                    one, two, pos, who = one[order], two[order], pos[order], who[order]
                    same = _groups(one, two)
                    gone = _later(same, len(one), doc[who], tie[who], pos)
                    if gone.any():
                        y = who[gone]
                        rows += _blob(1, np.full(len(y), int(one[0] % np.uint64(buckets)), np.int64),
                                      doc[y], tie[y], pos[gone].astype(np.int32), np.ones(len(y), np.int32))
                    one, two, pos, who = one[same], two[same], pos[same], who[same]
                    rows += _blob(2, (one % np.uint64(buckets)).astype(np.int64), one, two, doc[who], tie[who],
                                  pos.astype(np.int32))
                yield from _yield_blobs(rows)
    return run


def suffix_order(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and common prefix of each with the one before."""
    width = strings.shape[1]
    order = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    common = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 1 << 16):
        b = min(a + (1 << 16), len(order))
        differ = strings[order[a:b]] != strings[order[a - 1:b - 1]]
        common[a:b] = np.where(differ.any(1), differ.argmax(1), width)
    return order, common


def longest_previous_factors(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest match, up to the depth of the order, with a string that starts earlier.

    ``position`` ranks the strings in suffix order by where they start; the
    previous and the next smaller position share the longest earlier match.  A
    pointer that rests on a position that isn't smaller takes over that one's
    pointer, all pointers at once.
    """
    n = len(position)
    best = np.zeros(n, np.int64)
    for flip in (False, True):
        pos = position[::-1] if flip else position
        match = np.append(common[1:], 0)[::-1].copy() if flip else common.copy()
        to = np.arange(n) - 1
        active = np.flatnonzero(to >= 0)
        active = active[pos[to[active]] >= pos[active]]
        while len(active):
            p = to[active]
            new_to, new_match = to[p], np.where(to[p] >= 0, np.minimum(match[active], match[p]), 0)
            to[active], match[active] = new_to, new_match
            active = active[new_to >= 0]
            active = active[pos[to[active]] >= pos[active]]
        match[to < 0] = 0
        best = np.maximum(best, match[::-1] if flip else match)
    return best


def _decide_strings(length: int):
    """Reduce pass: repeated strings of contested anchors as ranges."""
    types = {0: (np.int64, np.int32, np.int32, np.int32), 1: (np.int64, np.int32, np.int32, np.int32),
             2: (np.uint64, np.uint64, np.int64, np.int32, np.int32)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, list] = {}
        hashes: dict[int, list] = {}

        def rows():
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        for row in rows():
            kind, bucket = row[0], row[1]
            x = [from_planes(row[2 + i], t) for i, t in enumerate(types[kind])]
            if kind == 1:
                yield _ranges(0, *x)
            elif kind == 2:
                hashes.setdefault(bucket, []).append(x)
            else:
                texts.setdefault(bucket, []).append((*x, np.frombuffer(row[6], np.uint8)))
        for bucket in sorted(texts):
            doc, tie, start, n, text = [np.concatenate(x) for x in zip(*texts.pop(bucket), strict=True)]
            begin = np.cumsum(n + length - 1) - (n + length - 1)
            who = np.repeat(np.arange(len(n)), n)
            move = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            strings = np.lib.stride_tricks.sliding_window_view(text, length)[begin[who] + move]
            where = np.stack([doc[who], tie[who], start[who] + move], axis=1)
            rank = np.lexsort((where[:, 2], where[:, 1], where[:, 0]))
            place = np.empty(len(rank), np.int64)
            fresh = np.zeros(len(rank), np.int64)
            fresh[1:] = (where[rank[1:]] != where[rank[:-1]]).any(1)
            place[rank] = np.cumsum(fresh)
            order, common = suffix_order(strings)
            gone = order[longest_previous_factors(place[order], common) >= length]
            yield _merged(doc[who[gone]], tie[who[gone]], start[who[gone]] + move[gone])
        for bucket in sorted(hashes):
            one, two, doc, tie, pos = [np.concatenate(x) for x in zip(*hashes.pop(bucket), strict=True)]
            order = np.lexsort((pos, tie, doc, two, one))
            one, two, doc, tie, pos = [x[order] for x in (one, two, doc, tie, pos)]
            gone = _later(_groups(one, two), len(one), doc, tie, pos)
            yield _merged(doc[gone], tie[gone], pos[gone])
    return run


def _merged(doc: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Single strings as ranges of neighbouring ones."""
    order = np.lexsort((pos, tie, doc))
    doc, tie, pos = doc[order].astype(np.int64), tie[order], pos[order].astype(np.int64)
    if not len(doc):
        return _ranges(0, doc, tie, pos, pos)
    first = _groups(doc, tie, pos - np.arange(len(pos)))
    return _ranges(0, doc[first], tie[first], pos[first], np.diff(np.append(first, len(pos))))


def _cut(length: int):
    """Last pass: removed spans, what is left and its digest."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            lists = batch.column(2)
            flat = lists.flatten()
            at = np.concatenate([[0], np.cumsum([0 if x is None else x for x in
                                                 lists.value_lengths().to_pylist()])]).astype(np.int64)
            begins = flat.field(0).to_numpy(zero_copy_only=False)
            ends = begins + flat.field(1).to_numpy(zero_copy_only=False) + length - 1
            spans, kept, removed = [], [], []
            for i in range(batch.num_rows):
                raw = data[off[i]:off[i + 1]].tobytes()
                s, e = begins[at[i]:at[i + 1]], ends[at[i]:at[i + 1]]
                order = np.argsort(s, kind="stable")
                s, e = s[order], np.maximum.accumulate(e[order]) if len(order) else e
                new = np.ones(len(s), bool)
                new[1:] = s[1:] > e[:-1]
                first = np.flatnonzero(new)
                s, e = s[first], e[np.append(first[1:] - 1, len(e) - 1)] if len(first) else e
                digest, last = hashlib.sha256(), 0
                for a, b in zip(s.tolist(), e.tolist(), strict=True):
                    digest.update(raw[last:a])
                    last = b
                digest.update(raw[last:])
                spans.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)])
                kept.append(digest.hexdigest())
                removed.append(int((e - s).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(off)), pa.array(removed, pa.int64()),
                 pa.array(spans, span), pa.array(kept, pa.string())],
                ["_id", "n_bytes", "n_removed", "spans", "kept_sha256"])
    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      length: int = 100) -> DataFrame:
    """One row per document: (id, n_bytes, n_removed, spans, kept_sha256).

    ``spans`` holds the maximal removed runs as byte offsets, end exclusive.
    """
    if length < ANCHOR + 4:
        raise ValueError(f"length must be at least {ANCHOR + 4}")
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("_doc"),
                        (F.crc32(text.cast("binary")) % 32768).cast("int").alias("_tie"),
                        text.alias("_text"), F.col(id_col).alias("_id"))
    keyed = texts.select("_doc", "_tie", "_text")
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil(size / 27 / ENTRIES_PER_BUCKET))
    first = (keyed.mapInArrow(_first_pass(length, buckets), _BLOBS).repartition(buckets, "bucket")
             .mapInArrow(_decide_runs, _RANGES).checkpoint())
    runs_left = first.filter("kind = 1").select("doc")
    firsts = bitmap.build(runs_left, "doc")
    common = bitmap.build(first.filter("kind = 2").select("doc"), "doc")
    again = max(least, math.ceil(runs_left.count() * 27 / STRINGS_PER_BUCKET))
    second = (keyed.mapInArrow(_second_pass(length, again, firsts, common), _BLOBS)
              .repartition(again, "bucket").mapInArrow(_decide_strings(length), _RANGES))
    ranges = (first.filter("kind = 0").unionByName(second).groupBy("doc", "tie")
              .agg(F.collect_list(F.struct("start", "n")).alias("ranges")))
    both = texts.join(ranges, (F.col("_doc") == F.col("doc")) & (F.col("_tie") == F.col("tie")), "left")
    empty = F.array().cast("array<struct<start:bigint,n:bigint>>")
    out = both.select("_id", "_text", F.coalesce("ranges", empty).alias("ranges")).mapInArrow(
        _cut(length), f"_id {kind}, n_bytes bigint, n_removed bigint, "
        "spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")
    return out.withColumnRenamed("_id", id_col)
