"""Exact dedup by content-defined chunk recipes.

A text, its white space runs made one space, is cut where a rolling hash of the
last 32 bytes meets a mask, so equal passages are cut alike wherever they stand.
Its recipe is the ordered list of its chunk identifiers.  An identifier is the
chunk's fingerprint plus a number that tells different bytes of one fingerprint
apart: the chunks of all documents whose list occurs more than once are compared
by their bytes, once per task and distinct chunk, and a fingerprint found with
different bytes gets numbers.  Documents are equal when their ordered identifier
lists are equal.  No whole text is ever shuffled: all documents move as a digest
and a list, and only chunks that may be copies move, after the copies in a task
were combined.

Defined cases: null counts as the empty text, whose list is empty, so empty texts
equal each other; of equal texts the smallest id stays (rows that repeat this id
all count as kept, a null id comes after all others); an empty table gives an
empty result.  Only the id and text columns are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm import bitmap
from reportflow.llm.bytetext import buffers, chunks, collapse_spaces
from reportflow.session import ensure_checkpoint_dir

# Fingerprints with different bytes that the driver is ready to hold; with 16
# bytes each there are none in practice, and more than this is an error.
MOST_CLASHES = 10_000
_GEAR = np.random.default_rng(811).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(data: np.ndarray, off: np.ndarray, average: int = 1024) -> np.ndarray:
    """End positions of the content-defined chunks of all documents, ascending.

    The rolling hash sums gear values shifted by their distance, over 32 bytes.
    A chunk ends after a byte where the hash's masked bits are zero, and at the
    end of its document.
    """
    if len(data) == 0:
        return np.zeros(0, np.int64)
    h = _GEAR[data]
    for shift in (1, 2, 4, 8, 16):     # after each step the hash covers twice the bytes
        h[shift:] += h[:-shift].copy() << np.uint32(shift)
    bits = average.bit_length() - 1
    mask = np.uint32(((1 << bits) - 1) << (32 - bits))
    at = np.flatnonzero((h & mask) == 0) + 1
    # In its first 31 bytes a document's hash still holds the document before.
    at = at[at - off[np.searchsorted(off, at - 1, side="right") - 1] >= 32]
    return np.union1d(at, off[1:][np.diff(off) > 0])


def _fingerprint(body: bytes, size: int) -> bytes:
    return hashlib.blake2b(body, digest_size=size).digest()


def _recipes(average: int, size: int, clashes: dict[bytes, list[bytes]]):
    """Map pass: per document its SHA-256, its list of identifiers and the list's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw, off, ends, before in _cut(batch, average):
                shas, lists = [], []
                for i in range(len(off) - 1):
                    shas.append(hashlib.sha256(raw[off[i]:off[i + 1]]).hexdigest())
                    start, recipe = off[i], []
                    for end in ends[before[i]:before[i + 1]]:
                        recipe.append(identifier(raw[start:end], size, clashes))
                        start = end
                    lists.append(b"".join(recipe))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(shas, pa.string()), pa.array(lists, pa.binary()),
                     pa.array([list_hash(x) for x in lists], pa.int64())],
                    ["_id", "_sha", "_list", "_hash"])
    return run


def identifier(body: bytes, size: int, clashes: dict[bytes, list[bytes]]) -> bytes:
    """Fingerprint and number of a chunk; the number is 0 for all but clashes.

    Bytes that were not compared belong to a document whose fingerprints alone
    tell it from all others, so they can share the number after the last.
    """
    print_ = _fingerprint(body, size)
    known = clashes.get(print_, [body])
    number = known.index(body) if body in known else len(known)
    return print_ + number.to_bytes(2, "big")


def list_hash(identifiers: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(identifiers, digest_size=8).digest(), "big", signed=True)


def _cut(batch: pa.RecordBatch, average: int):
    data, off = buffers(batch.column(1))
    for a, b, d, o in chunks(data, off):
        d, o = collapse_spaces(d, o)
        ends = chunk_ends(d, o, average)
        yield (batch.column(0).slice(a, b - a), d.tobytes(), o, ends,
               np.searchsorted(ends, o, side="right"))


def _bodies(average: int, size: int, wanted: np.ndarray):
    """Map pass: the distinct chunks of documents whose list may occur elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, raw, off, ends, before in _cut(batch, average):
                found: dict[bytes, set[bytes]] = defaultdict(set)
                for i in range(len(off) - 1):
                    start, body = off[i], []
                    for end in ends[before[i]:before[i + 1]]:
                        body.append(raw[start:end])
                        start = end
                    prints = [_fingerprint(x, size) for x in body]
                    key = list_hash(b"".join(p + b"\0\0" for p in prints))
                    if bitmap.contains(wanted, np.array([key], np.int64))[0]:
                        for p, x in zip(prints, body, strict=True):
                            found[p].add(x)
                pairs = [(p, x) for p, xs in found.items() for x in xs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in pairs], pa.binary()),
                     pa.array([x for _, x in pairs], pa.binary())], ["_print", "_body"])
    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     average: int = 1024, fingerprint_bytes: int = 16) -> DataFrame:
    """One row per document: (id, keep_id, group_size, kept, text_sha256)."""
    ensure_checkpoint_dir(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_id {kind}, _sha string, _list binary, _hash bigint"

    def groups_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_list").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_keep"),
                                         F.first("_hash").alias("_hash")).filter("_n > 1")

    rows = texts.mapInArrow(_recipes(average, fingerprint_bytes, {}), schema).checkpoint()
    groups = groups_of(rows).checkpoint()
    wanted = bitmap.build(groups, "_hash")
    same_print = (texts.mapInArrow(_bodies(average, fingerprint_bytes, wanted),
                                   "_print binary, _body binary").distinct()
                  .groupBy("_print").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1")
                  .select("_print").limit(MOST_CLASHES + 1).collect())
    if same_print:
        if len(same_print) > MOST_CLASHES:
            raise ValueError("fingerprint_bytes is too small for this corpus")
        clashing = docs.sparkSession.createDataFrame(same_print, "_print binary")
        found: dict[bytes, list[bytes]] = defaultdict(list)
        for r in (texts.mapInArrow(_bodies(average, fingerprint_bytes, wanted),
                                   "_print binary, _body binary").distinct()
                  .join(clashing, "_print").orderBy("_print", "_body").collect()):
            found[bytes(r["_print"])].append(bytes(r["_body"]))
        rows = texts.mapInArrow(_recipes(average, fingerprint_bytes, dict(found)), schema).checkpoint()
        groups = groups_of(rows).checkpoint()

    named = groups.select("_list", "_n", "_keep")
    joined = rows.join(named, "_list", "left")
    keep = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return joined.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), F.col("_sha").alias("text_sha256"))
