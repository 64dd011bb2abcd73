"""N-gram Jaccard join: near duplicates by a size-aware heavy-light join.

A document is the set of its distinct five-word shingles.  Two sets link when
their Jaccard similarity is at least ``percent`` / 100; the result has every
component of the link graph.

* Equal sets are one node from the start.
* All documents count towards a sketch of shingle frequencies (2**22 counters,
  whatever the input); it gives all sets one common order, rare shingles first.
* A set of s shingles that links with another shares at least c = ceil(t * s) of
  them.  Light (small) sets enumerate all 2-subsets of their first s - c + 2
  shingles: two linked light sets have one in common.  Heavy (large) sets, and
  light sets big enough to link with a heavy one, go into inverted lists of their
  first s - c + 1 shingles: linked sets meet in a list.  The boundary between
  light and heavy is the size with the least estimated cost: subsets enumerated
  against list entries written and scanned.
* Pairs of similar size that meet are pruned by histograms of their shingles (256
  cells; the sum of the smaller counts bounds the intersection from above), and
  what is left is verified on the whole sets.
* In a list of over ``LONG`` sets only pairs with the smallest set of each size
  range are verified at first.  Where such a list still holds several components,
  its sets are compared block against block, each task returning a spanning
  forest, so no link is lost and no pairs are listed.  A list that is long within
  one chunk of documents already shrinks to its first set before the pairs are
  formed; it counts as long everywhere, so sets of other chunks are compared with
  all of its sets, not with the first alone.

Shingles are compared by 64-bit hashes.  Node ids are 64-bit set hashes, checked
by a second hash; a clash raises an error.

Defined cases: A-Z counts as lower case; fewer than five words form one shingle;
null, empty or wordless texts have an empty set, link with nothing and are their
own component; repeated rows are linked like other equal texts; an empty table
gives an empty result.  Only the id and text columns are read, so other columns
may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm import bitmap
from reportflow.llm.bytetext import buffers, chunks, from_planes, mix, planes, shingle_sets
from reportflow.llm.components import components, forest
from reportflow.session import ensure_checkpoint_dir

SKETCH_BITS = 22
SLICES = 16
LONG = 64
CELLS = 256
BLOCK = 2048
MOST_LIGHT = 64
ENTRIES_PER_BUCKET = 400_000


def set_hashes(sets: np.ndarray, off: np.ndarray, seed: int) -> np.ndarray:
    """A hash per set that does not depend on the order."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(seed)), dtype=np.uint64)])
    return mix(total[off[1:]] - total[off[:-1]] + np.diff(off).astype(np.uint64))


def histograms(sets: np.ndarray, off: np.ndarray) -> list[bytes]:
    """Shingles per cell of each set (cells by the low bits)."""
    n = len(off) - 1
    doc = np.repeat(np.arange(n), np.diff(off))
    counts = np.bincount(doc * CELLS + (sets & np.uint64(CELLS - 1)).astype(np.int64), minlength=n * CELLS)
    return [x.tobytes() for x in np.minimum(counts, 65535).astype(np.uint16).reshape(n, CELLS)]


def _prune(percent: int):
    """Map pass: pairs whose histograms allow the similarity; full cells allow everything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, CELLS)
                    for c in ("ca", "cb"))
            most = np.minimum(a, b).sum(1, dtype=np.int64)
            total = a.sum(1, dtype=np.int64) + b.sum(1, dtype=np.int64)
            keep = (100 * most >= percent * (total - most)) | (np.maximum(a, b).max(1, initial=0) == 65535)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _describe(width: int):
    """Map pass: size and hashes of every set (kind 0), and the task's sketch in slices (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "_id", "sid", "check", "n", "cells", "slice", "counts"]
        sketch, any_rows, id_type = np.zeros(1 << SKETCH_BITS, np.uint32), False, None
        for batch in batches:
            any_rows, id_type = True, batch.column(0).type
            data, off = buffers(batch.column(1))
            for a, b, d, o in chunks(data, off):
                sets, so = shingle_sets(d, o, width)
                sketch += np.bincount(_counter(sets), minlength=1 << SKETCH_BITS).astype(np.uint32)
                n = b - a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), batch.column(0).slice(a, n),
                     pa.array(set_hashes(sets, so, 0).view(np.int64)),
                     pa.array(set_hashes(sets, so, 77).view(np.int64)), pa.array(np.diff(so)),
                     pa.array(histograms(sets, so), pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if any_rows:
            # Counts only order shingles: more than 65,535 in one task counts as 65,535.
            parts = np.minimum(sketch, 65535).astype(np.uint16).reshape(SLICES, -1)
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(SLICES, np.int32)), pa.nulls(SLICES, id_type), none, none, none,
                 pa.nulls(SLICES, pa.binary()),
                 pa.array(np.arange(SLICES, dtype=np.int32)),
                 pa.array([zlib.compress(planes(x), 1) for x in parts], pa.binary())], names)
    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum a slice's counters; the log in eighths is enough for an order."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = from_planes(zlib.decompress(raw), np.uint16).astype(np.int64)
            totals[part] = totals[part] + x if part in totals else x
    if totals:
        level = [np.minimum(np.round(6 * np.log2(1 + x)), 255).astype(np.uint8) for x in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([x.tobytes() for x in level], pa.binary())],
            ["slice", "level"])


def light_boundary(histogram: dict[int, int], levels: np.ndarray, percent: int) -> int:
    """Largest size of a light set: the one with the least total cost.

    A light set of size s costs its 2-subsets; a heavy one, and a light one that
    may link with a heavy one, costs its list entries times 1 + the list length
    to scan, estimated as the mean count, above the sketch's noise, of the rarest
    quarter of shingles (the part that lists are made of).
    """
    counts = np.sort(2.0 ** (levels / 6.0) - 1)
    mass = np.cumsum(counts)
    if not len(mass) or mass[-1] <= 0:
        return 0
    rare = counts[:max(int(np.searchsorted(mass, mass[-1] * (100 - percent) / 100)), 1)]
    scan = max(float((rare ** 2).sum() / max(rare.sum(), 1e-9)) - float(rare.mean()), 0.0)
    need = {s: -(-percent * s // 100) for s in range(1, MOST_LIGHT + 1)}
    subsets = {s: math.comb(s - need[s] + 2, 2) for s in need}
    lists = {s: (s - need[s] + 1) * (1 + scan) for s in need}
    best, at = math.inf, 0
    for x in range(0, MOST_LIGHT + 1):
        cost = sum(histogram.get(s, 0) * (subsets[s] if s <= x else lists[s]) for s in need)
        cost += sum(histogram.get(s, 0) * lists[s] for s in need if s <= x and 100 * s >= percent * (x + 1))
        if cost < best:
            best, at = cost, x
    return at


def _ranks(sets: np.ndarray, off: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles in the common order: (shingles, their documents, their places)."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((mix(sets), levels[_counter(sets)], doc))
    return sets[order], doc, np.arange(len(sets)) - off[doc]


def keys_of(sets: np.ndarray, off: np.ndarray, levels: np.ndarray, light: int, percent: int,
            keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, documents, whether the key is a 2-subset) of the kept sets of a chunk."""
    n = np.diff(off)
    need = -(-percent * n // 100)
    ordered, doc, place = _ranks(sets, off, levels)
    # Sets of one or two shingles link with equal sets only.
    use = keep & (n > 2)
    listed = use & (100 * n >= percent * (light + 1))
    one = listed[doc] & (place < (n - need + 1)[doc])
    keys, docs, subset = [mix(ordered[one] ^ np.uint64(1))], [doc[one]], [np.zeros(int(one.sum()), bool)]
    two = use & (n <= light)
    for size in np.unique(n[two]):
        mine = np.flatnonzero(two & (n == size))
        first = int(size - (-(-percent * size // 100)) + 2)
        block = ordered[off[mine][:, None] + np.arange(first)]
        i, j = np.triu_indices(first, 1)
        low, high = np.minimum(block[:, i], block[:, j]), np.maximum(block[:, i], block[:, j])
        keys.append(mix(mix(low) * np.uint64(0x9E3779B97F4A7C15) + high).ravel())
        docs.append(np.repeat(mine, len(i)))
        subset.append(np.ones(len(mine) * len(i), bool))
    return np.concatenate(keys), np.concatenate(docs), np.concatenate(subset)


def _pairs(key: np.ndarray, sid: np.ndarray, size: np.ndarray, subset: np.ndarray, light: int,
           percent: int) -> tuple[list, list, np.ndarray]:
    """Pairs to verify from entries sorted by (key, size, sid).

    Returns two lists of pair ends and a mask of the entries of long lists.
    """
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(fresh)
    length = np.diff(np.append(start, len(key)))
    left, right, in_long = [], [], np.zeros(len(key), bool)

    def add(a: np.ndarray, b: np.ndarray) -> None:        # a is never larger than b
        ok = (100 * size[a] >= percent * size[b]) & (sid[a] != sid[b])
        ok &= subset[a] | (size[b] > light)
        left.append(sid[a[ok]])
        right.append(sid[b[ok]])

    for count in np.unique(length[(length > 1) & (length <= LONG)]):
        at = start[length == count]
        i, j = np.triu_indices(int(count), 1)
        step = max(1, (1 << 20) // len(i))
        for k in range(0, len(at), step):
            add((at[k:k + step, None] + i).ravel(), (at[k:k + step, None] + j).ravel())
    for a, count in zip(start[length > LONG], length[length > LONG], strict=True):
        end = a + count
        in_long[a:end] = True
        while a < end:                      # the smallest set of each size range against the range
            stop = a + int(np.searchsorted(size[a:end], size[a] * 100 // percent, side="right"))
            add(np.full(stop - a - 1, a), np.arange(a + 1, stop))
            a = stop
    return left, right, in_long


def _entries(width: int, levels: np.ndarray, light: int, percent: int, buckets: int):
    """Map pass: list entries dealt by key (kind 0); pairs (1) and entries (2) of locally long lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(0))
            for _, _, d, o in chunks(data, off):
                sets, so = shingle_sets(d, o, width)
                sid, n = set_hashes(sets, so, 0), np.diff(so)
                keep = np.zeros(len(n), bool)
                keep[np.unique(sid, return_index=True)[1]] = True
                key, doc, subset = keys_of(sets, so, levels, light, percent, keep)
                order = np.lexsort((sid[doc], n[doc], key))
                key, doc, subset = key[order], doc[order], subset[order]
                left, right, in_long = _pairs(key, sid[doc], n[doc], subset, light, percent)
                first = np.ones(len(key), bool)
                first[1:] = key[1:] != key[:-1]
                out = _rows(0, key, doc, sid, n, subset, ~in_long | first, buckets)
                out += _rows(2, key, doc, sid, n, subset, in_long, buckets)
                if in_long.any():                       # pairs from the long lists alone
                    only = np.flatnonzero(in_long)
                    left, right, _ = _pairs(key[only], sid[doc[only]], n[doc[only]], subset[only], light, percent)
                    pair = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
                    if pair.shape[1]:
                        spot = int(pair[0, 0] % np.uint64(buckets))
                        out.append((1, spot, planes(pair[0]), planes(pair[1]), b"", b""))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()),
                         *[pa.array([r[k] for r in out], pa.binary()) for k in (2, 3, 4, 5)]],
                        ["kind", "bucket", "a", "b", "c", "d"])
    return run


def _rows(kind: int, key, doc, sid, n, subset, mask, buckets: int) -> list[tuple]:
    at = np.flatnonzero(mask)
    spot = (key[at] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(spot, kind="stable")
    at, spot = at[order], spot[order]
    cut = np.flatnonzero(np.diff(spot)) + 1
    return [(kind, int(s[0]), planes(key[x]), planes(sid[doc[x]]), planes(n[doc[x]].astype(np.uint32)),
             planes(subset[x].astype(np.uint8)))
            for s, x in zip(np.split(spot, cut), np.split(at, cut), strict=True) if len(x)]


def _meet(light: int, percent: int):
    """Reduce pass over the rows of some buckets: pairs to verify (0) and entries of long lists (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        locally_long: dict[int, list] = {}              # keys of lists that chunks have shrunk
        for batch in batches:
            for kind, bucket, a, b, c, d in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                a, b = from_planes(a, np.uint64), from_planes(b, np.uint64)
                if kind == 1:
                    yield _out(0, a, b, np.zeros(len(a), np.int64), np.zeros(len(a), bool))
                    continue
                c, d = from_planes(c, np.uint32).astype(np.int64), np.frombuffer(d, np.uint8) > 0
                if kind == 2:
                    locally_long.setdefault(bucket, []).append(np.unique(a))
                    yield _out(1, a, b, c, d)
                else:
                    parts.setdefault(bucket, []).append((a, b, c, d))
        for bucket in sorted(parts):
            key, sid, n, subset = [np.concatenate(x) for x in zip(*parts.pop(bucket), strict=True)]
            order = np.lexsort((sid, n, key))
            key, sid, n, subset = key[order], sid[order], n[order], subset[order]
            again = np.zeros(len(key), bool)            # one set from several chunks
            again[1:] = (key[1:] == key[:-1]) & (sid[1:] == sid[:-1])
            key, sid, n, subset = key[~again], sid[~again], n[~again], subset[~again]
            left, right, in_long = _pairs(key, sid, n, subset, light, percent)
            if bucket in locally_long:                  # however short the list that is left of them
                in_long |= np.isin(key, np.concatenate(locally_long.pop(bucket)))
            if left:
                pair = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
                yield _out(0, pair[0], pair[1], np.zeros(pair.shape[1], np.int64), np.zeros(pair.shape[1], bool))
            if in_long.any():
                yield _out(1, key[in_long], sid[in_long], n[in_long], subset[in_long])
    return run


def _out(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, subset: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
         pa.array(n), pa.array(subset)], ["kind", "a", "b", "n", "subset"])


def _wanted_sets(width: int, wanted: np.ndarray):
    """Map pass: whole sets of nodes that occur in pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(0))
            for _, _, d, o in chunks(data, off):
                sets, so = shingle_sets(d, o, width)
                sid = set_hashes(sets, so, 0).view(np.int64)
                first = np.unique(sid, return_index=True)[1]
                at = np.sort(first[bitmap.contains(wanted, sid[first])])
                size = np.diff(so)[at]
                take = np.repeat(so[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                    pa.array(sets[take].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(sid[at]), lists], ["sid", "shingles"])
    return run


def _verify(texts: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that link: whole sets are compared, wherever the two come from."""
    wanted = bitmap.build(pairs.select(F.explode(F.array("a", "b")).alias("sid")), "sid")
    sets = (texts.select("_text").mapInArrow(_wanted_sets(width, wanted), "sid bigint, shingles array<bigint>")
            .dropDuplicates(["sid"]))
    left = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of two lists of sets: products of incidence matrices, some shingles at a time."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        flat = np.concatenate(sets)
        at = np.searchsorted(shared, flat)
        at[at == len(shared)] = 0
        hit = shared[at] == flat
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    if len(shared):
        (lr, lc), (rr, rc) = places(left), places(right)
        for k in range(0, len(shared), 2048):
            x, y = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
            i, j = np.searchsorted(lc, [k, k + 2048])
            x[lr[i:j], lc[i:j] - k] = 1
            i, j = np.searchsorted(rc, [k, k + 2048])
            y[rr[i:j], rc[i:j] - k] = 1
            out += x @ y.T
    return out


def _compare_blocks(percent: int):
    """One block of sets against another (or itself): a spanning forest of the links found."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sid", ignore_index=True)
        first, second = pdf[pdf["block"] == pdf["bi"]], pdf[pdf["block"] == pdf["bj"]]
        if first.empty or second.empty:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        both = _overlaps(list(first["shingles"]), list(second["shingles"])).astype(np.int64)
        n, m = first["n"].to_numpy()[:, None], second["n"].to_numpy()[None, :]
        part = first["part"].to_numpy()[:, None] != second["part"].to_numpy()[None, :]
        i, j = np.nonzero((100 * both >= percent * (n + m - both)) & part)
        a, b = first["sid"].to_numpy()[i], second["sid"].to_numpy()[j]
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = forest(at[:len(a)], at[len(a):], len(nodes))
        return pd.DataFrame({"a": nodes, "b": nodes[root]})
    return run


def _within_clusters(texts: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between the parts that long lists still hold: (a, b) of spanning forests.

    ``members`` (key, sid, n, part): lists that share a set form a cluster, whose
    blocks are compared with each other.
    """
    least = members.groupBy("key").agg(F.min("sid").alias("lead"))
    spokes = members.join(least, "key").select("sid", "lead").distinct()
    of = components(spokes, "sid", "lead").withColumnsRenamed({"node": "sid", "component": "cluster"})
    nodes = (members.groupBy("sid").agg(F.first("n").alias("n"), F.first("part").alias("part"))
             .join(of, "sid", "left").withColumn("cluster", F.coalesce("cluster", "sid")))
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    nodes = nodes.join(sizes, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")).checkpoint()
    wanted = bitmap.build(nodes, "sid")
    sets = (texts.select("_text").mapInArrow(_wanted_sets(width, wanted), "sid bigint, shingles array<bigint>")
            .dropDuplicates(["sid"]))
    # A set meets every block of its cluster once, itself included; the smaller block number comes first.
    dealt = (nodes.join(sets, "sid").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}))
    return dealt.groupBy("cluster", "bi", "bj").applyInPandas(_compare_blocks(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 75) -> DataFrame:
    """One row per document: (id, n_shingles, component_id, text_hash).

    ``text_hash`` (xxhash64 of the text) tells rows of one id apart.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.struct(F.col(id_col).alias("i"), F.xxhash64(F.col(text_col)).alias("h")).alias("_id"),
                        F.col(text_col).cast("string").alias("_text"))
    first = texts.mapInArrow(_describe(width), f"kind int, _id struct<i: {kind}, h: bigint>, sid bigint, "
                             "`check` bigint, n bigint, cells binary, slice int, counts binary").checkpoint()
    rows = first.filter("kind = 0").select(F.col("_id.i").alias("_id"), F.col("_id.h").alias("text_hash"),
                                           "sid", "check", "n")
    nodes = (rows.filter("n > 0").groupBy("sid").agg(
        F.min("_id").alias("_first"), F.min("check").alias("_c"), F.max("check").alias("_d"),
        F.max("n").alias("n")).checkpoint())
    if nodes.filter("_c <> _d").limit(1).count():
        raise ValueError("two different sets have one 64-bit hash")
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    part = len(levels) // SLICES
    for r in (first.filter("kind = 1").select("slice", "counts").repartition(SLICES, "slice")
              .mapInArrow(_add_up, "slice int, level binary").collect()):      # 4 MB in all
        levels[r["slice"] * part:(r["slice"] + 1) * part] = np.frombuffer(r["level"], np.uint8)
    histogram = {r["n"]: r["c"] for r in nodes.filter(F.col("n") <= MOST_LIGHT).groupBy("n").agg(
        F.count(F.lit(1)).alias("c")).collect()}
    light = light_boundary(histogram, levels, percent)
    entries = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  math.ceil(entries * (100 - percent) / 100 / ENTRIES_PER_BUCKET))
    met = (texts.select("_text").mapInArrow(
        _entries(width, levels, light, percent, buckets), "kind int, bucket int, a binary, b binary, c binary, d binary")
        .repartition(buckets, "bucket").mapInArrow(
            _meet(light, percent), "kind int, a bigint, b bigint, n bigint, subset boolean").checkpoint())
    pairs = met.filter("kind = 0").select("a", "b").distinct().checkpoint()
    wanted = bitmap.build(pairs.select(F.explode(F.array("a", "b")).alias("sid")), "sid")
    cells = bitmap.keep(first.filter("kind = 0 and n > 0").select("sid", "cells"), "sid", wanted).dropDuplicates(["sid"])
    likely = (pairs.join(cells.select(F.col("sid").alias("a"), F.col("cells").alias("ca")), "a")
              .join(cells.select(F.col("sid").alias("b"), F.col("cells").alias("cb")), "b")
              .mapInArrow(_prune(percent), "a bigint, b bigint").checkpoint())
    links = _verify(texts, likely, width, percent).checkpoint()
    parts = components(links, "a", "b")

    # Long lists that still hold several components.
    members = (met.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("sid"), "n")
               .distinct().join(parts.withColumnRenamed("node", "sid"), "sid", "left")
               .select("key", "sid", "n", F.coalesce("component", "sid").alias("part")))
    split = members.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi")
    members = members.join(split.select("key"), "key", "left_semi").checkpoint()
    if not members.isEmpty():
        links = links.unionByName(_within_clusters(texts, members, width, percent)).checkpoint()
        parts = components(links, "a", "b")
    named = nodes.join(parts.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "part", F.coalesce("component", "sid"))
    smallest = named.groupBy("part").agg(F.min("_first").alias("component_id"))
    named = named.join(smallest, "part").select("sid", "component_id").withColumnRenamed("sid", "_sid")
    return (rows.join(named, (F.col("n") > 0) & (F.col("sid") == F.col("_sid")), "left")
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "_id").alias("component_id"), "text_hash"))
