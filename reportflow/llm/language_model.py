"""Language-model scoring with an Elias-Fano n-gram trie.

The model interpolates word pairs with single words:

    P1(w)   = (c(w) + 1) / (N + V + 1)
    P(w|v)  = (c(v w) + mu * P1(w)) / (c(v) + mu)

c counts occurrences in the training documents, N all tokens, V distinct ones;
every document ends with an end token, and its first token follows a begin token.
P1 and P(.|v) both sum to 1 over the vocabulary plus one unknown token.

Documents are scored in batches of some megabytes.  A batch sends each of its
distinct words and word pairs once, with their training counts, to the bucket of
its hash; the pairs of a context are dealt over 16 hash ranges, so that a frequent
word's pairs do not meet in one place.  A bucket adds the counts up, builds its
part of the trie (contexts, monotone pointers, successors relative to their
context, log joint probabilities quantised to 1/1000 of a decade up to the
constant -log10 N) in mapped memory, looks up every asked pair by successor
search and returns codes in the order asked.  Counts of words stay exact.  The
batch, put together again with its answers, scores its documents.

Words are compared by 64-bit hashes, pairs by 64-bit keys.  Scores differ from
unquantised ones by at most 0.0005 a token.

Defined cases: a null or empty text is the end token alone; without training
documents N = V = 0 and every token has probability 1; repeated rows count as
documents of their own; an empty table gives an empty result.  Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.bytetext import buffers, from_planes, lower, mix, planes, spans_hash, words
from reportflow.llm.eliasfano import Trie, mapped
from reportflow.llm.linear import held_out
from reportflow.session import ensure_checkpoint_dir

BATCH_BYTES = 4 << 20
BUCKET_BYTES = 5_000_000
END, BEGIN = np.uint64(0x2D3A0E4C5B6F7181), np.uint64(0x71C3B5A6978DEF01)
STEP = 1000


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Batches of some megabytes of text, the same ones in every scan, with a name.

    The name holds the partition, the place in it and a digest of ids and lengths.
    """
    part = TaskContext.get().partitionId()
    waiting, size, number = [], 0, 0

    def close() -> tuple[str, pa.RecordBatch]:
        whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        digest = hashlib.blake2b(digest_size=8)
        _, off = buffers(whole.column(2))
        digest.update(off.tobytes())
        digest.update(repr(whole.column(0).to_pylist()).encode())
        return f"{part}-{number}-{digest.hexdigest()}", whole

    for batch in batches:
        _, off = buffers(batch.column(2))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(off, off[first] + BATCH_BYTES - size, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            waiting.append(batch.slice(first, last - first))
            size += int(off[last] - off[first])
            first = last
            if size >= BATCH_BYTES * 3 // 4:
                yield close()
                waiting, size, number = [], 0, number + 1
    if waiting:
        yield close()


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all documents, end tokens included, and offsets per document."""
    data, off = buffers(column)
    data = lower(data)
    starts, ends, before = words(data, off)
    n = len(off) - 1
    out = np.full(len(starts) + n, END, np.uint64)
    last = before[1:] + np.arange(n)
    place = np.ones(len(out), bool)
    place[last] = False
    out[place] = spans_hash(data, starts, ends)
    return out, np.concatenate([[0], last + 1])


def pair_keys(token: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Key of each token after the one before it; the context in the upper half.

    A context's pairs fall into 16 ranges, by bits of the second token.
    """
    before = np.concatenate([[BEGIN], token[:-1]]) if len(token) else token
    before[off[:-1]] = BEGIN
    range_ = token & np.uint64(15)
    upper = mix(before + (range_ << np.uint64(59)) + range_) >> np.uint64(32)
    return (upper << np.uint64(32)) | (mix(token ^ np.uint64(0xABCDEF)) >> np.uint64(32))


def _bounds(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins: buckets are ranges of the upper 32 bits."""
    bucket = ((sorted_keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1))


def _send(buckets: int):
    """Map pass: distinct words (kind 1) and pairs (kind 2) of a batch with training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, batch in _batches(batches):
            token, off = tokens(batch.column(2))
            train = np.repeat(~batch.column(1).to_numpy(zero_copy_only=False), np.diff(off))
            out = []
            for kind, key in ((1, token), (2, pair_keys(token, off))):
                distinct, at = np.unique(key, return_inverse=True)
                count = np.bincount(at[train], minlength=len(distinct)).astype(np.uint32)
                cut = _bounds(distinct, buckets)
                for b in np.flatnonzero(np.diff(cut)):
                    k = distinct[cut[b]:cut[b + 1]]
                    step = np.diff(k, prepend=np.uint64(0))
                    out.append((kind, int(b), planes(step), zlib.compress(planes(count[cut[b]:cut[b + 1]]), 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(out), pa.string()), pa.array([r[0] for r in out], pa.int32()),
                 pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary()),
                 pa.array([r[3] for r in out], pa.binary())], ["name", "kind", "bucket", "keys", "counts"])
    return run


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys seen in training and their totals."""
    k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    k, c = k[c > 0], c[c > 0]
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(fresh)
    return k[first], np.add.reduceat(c, first) if len(first) else c


def quantise(counts: np.ndarray) -> np.ndarray:
    """Codes of counts of 1 and more: steps of 1/1000 decade, from 1; 0 stands for unseen."""
    return np.minimum(1 + np.round(STEP * np.log10(np.maximum(counts, 1))), 65535).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 1) / STEP), 0.0)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce pass over some buckets: exact counts of words, codes of pairs, and totals (kind 3)."""
    parts: dict[tuple[int, int], list] = {}
    for batch in batches:
        for name, kind, bucket, keys, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            parts.setdefault((bucket, kind), []).append((name, keys, counts))
    for bucket, kind in sorted(parts):
        got = parts.pop((bucket, kind))
        keys = [np.cumsum(from_planes(k, np.uint64), dtype=np.uint64) for _, k, _ in got]
        k, c = _merge(keys, [from_planes(zlib.decompress(x), np.uint32) for _, _, x in got])
        if kind == 1:
            def look(x: np.ndarray, k: np.ndarray = k, c: np.ndarray = c) -> np.ndarray:
                at = np.minimum(np.searchsorted(k, x), max(len(k) - 1, 0))
                return np.where(k[at] == x, c[at], 0).astype(np.uint64) if len(k) else np.zeros(len(x), np.uint64)
        else:
            look = Trie(mapped(Trie.build(k, quantise(c)))).look_up
        for (name, _, _), x in zip(got, keys, strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()),
                 pa.array([zlib.compress(planes(look(x)), 1)], pa.binary()), pa.array([0], pa.int64()),
                 pa.array([0], pa.int64())], ["name", "kind", "bucket", "payload", "n", "v"])
        if kind == 1:
            yield pa.RecordBatch.from_arrays(
                [pa.array([""], pa.string()), pa.array([3], pa.int32()), pa.array([bucket], pa.int32()),
                 pa.array([b""], pa.binary()), pa.array([int(c.sum())], pa.int64()),
                 pa.array([len(c)], pa.int64())], ["name", "kind", "bucket", "payload", "n", "v"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map pass: whole batches as one row each (kind 0)."""
    for name, batch in _batches(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name], pa.string()), pa.array([0], pa.int32()), pa.array([0], pa.int32()),
             pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["name", "kind", "bucket", "payload"])


def _score(total: int, distinct: int, mu: float, id_name: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        text = pdf[pdf["kind"] == 0]
        if len(text) != 1:
            raise RuntimeError("the batches of two scans differ: was the input changed meanwhile?")
        batch = pa.ipc.open_stream(text["payload"].iloc[0]).read_all().combine_chunks().to_batches()[0]
        token, off = tokens(batch.column(2))
        answers = pdf.sort_values("bucket")

        def table(kind: int, key: np.ndarray, dtype) -> np.ndarray:
            own = answers[answers["kind"] == kind]["payload"]
            got = np.concatenate([from_planes(zlib.decompress(x), dtype) for x in own])
            distinct_keys, at = np.unique(key, return_inverse=True)
            if len(got) != len(distinct_keys):
                raise RuntimeError("the batches of two scans differ: was the input changed meanwhile?")
            return got[at]

        count = table(1, token, np.uint64).astype(np.float64)
        pair = restore(table(2, pair_keys(token, off), np.uint16))
        single = (count + 1) / (total + distinct + 1)
        n_end = count[off[1] - 1]                            # training documents
        before = np.concatenate([[n_end], count[:-1]])
        before[off[:-1]] = n_end
        both = (pair + mu * single) / (before + mu)
        part = lambda x: np.add.reduceat(x, off[:-1])        # noqa: E731  no document is without a token
        return pd.DataFrame({
            id_name: batch.column(0).to_pandas(), "held_out": batch.column(1).to_pandas(),
            "n_tokens": np.diff(off), "n_known": part((count > 0).astype(np.int64)),
            "train_tokens": total, "base_score": part(np.log10(single)), "score": part(np.log10(both))})
    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
                fold: int = 2, mu: float = 4.0) -> DataFrame:
    """One row per document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Documents whose crc32 of the id as text is ``fold`` modulo ``folds`` are
    scored but not learned from.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), held_out(F.col(id_col), folds, fold).alias("_held"), text.alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BUCKET_BYTES))
    answers = (rows.mapInArrow(_send(buckets),
                               "name string, kind int, bucket int, keys binary, counts binary")
               .repartition(buckets, "bucket").mapInArrow(
                   _answer, "name string, kind int, bucket int, payload binary, n bigint, v bigint").checkpoint())
    total, distinct = answers.filter("kind = 3").agg(F.sum("n"), F.sum("v")).first()
    parts = (rows.mapInArrow(_texts, "name string, kind int, bucket int, payload binary")
             .unionByName(answers.filter("kind < 3").drop("n", "v")))
    return parts.groupBy("name").applyInPandas(
        _score(total or 0, distinct or 0, mu, id_col),
        f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double")
