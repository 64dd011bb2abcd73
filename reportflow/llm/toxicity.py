"""Toxicity: a character n-gram linear classifier with naive Bayes scaled features.

Features are the distinct 3- to 5-byte n-grams of the lower-cased text, hashed
into 2**20 columns.  Spark counts, over all labelled training rows, in how many
toxic and other documents each column occurs; the log of the ratio of the two
smoothed shares scales the column (Wang and Manning's NB-SVM).  Columns whose shares
differ by at least ``errors`` standard errors over five documents or more are kept,
as many as there are; the others tell the labels no better than chance and have
weight 0.  A linear SVM is fitted on the kept ones, its weights are interpolated with
their mean, and a sigmoid turns margins into probabilities.

Only the fit of the SVM and the sigmoid sees a sample: at most ``per_class``
texts of either label, those with the smallest hashed ids; the sigmoid weighs
them by the true shares of the labels.  Counts and ratios cover all rows.

Defined cases: a null text counts as empty; an empty text scores like a text
without any kept n-gram; with labels of one kind only, or none, every text gets
the share of toxic labels (0 without labels); a document labelled more than once
is toxic if any label says so; null labels are ignored; an empty table gives an
empty result; a text of any length is taken whole, a megabyte at a time.  Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm import bitmap
from reportflow.llm.bytetext import buffers, chunks, lower
from reportflow.llm.linear import fit_sigmoid, fit_svm, held_out, sample_bounds, sigmoid

WIDTH_BITS = 20
WIDTH = 1 << WIDTH_BITS
ORDERS = (3, 4, 5)
_SLICES = 64
PIECE = 2 << 20


def ngram_columns(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the positions where an n-gram starts, and its column."""
    x = lower(data).astype(np.uint32)
    end = np.repeat(off[1:], np.diff(off))
    h = np.full(len(x), 0x9E37, np.uint32)
    for n in range(1, max(ORDERS) + 1):
        h = h[:len(x) - n + 1] if n > 1 else h
        h = (h ^ x[n - 1:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in ORDERS and len(h):
            at = np.flatnonzero(np.arange(n, n + len(h)) <= end[:len(h)])
            yield at, ((h[at] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - WIDTH_BITS)).astype(np.int32)


def _distinct(data: np.ndarray, off: np.ndarray, keep: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, column) pairs; ``keep`` maps columns to kept ones or -1."""
    if len(off) == 2 and len(data) > PIECE:             # a long text: the columns of one piece after the other
        found = np.zeros(WIDTH, bool)
        for s in range(0, len(data), PIECE):
            part = data[s:s + PIECE + max(ORDERS) - 1]
            for at, col in ngram_columns(part, np.array([0, len(part)])):
                found[col[at < PIECE]] = True
        col = np.flatnonzero(found)
        if keep is not None:
            col = np.unique(keep[col])
            col = col[col >= 0].astype(np.int64)
        return np.zeros(len(col), np.int64), col
    owner = np.repeat(np.arange(len(off) - 1, dtype=np.uint32), np.diff(off))       # the document of each byte
    many = WIDTH if keep is None else int(keep.max(initial=-1)) + 1
    wide = np.uint32 if (len(off) - 1) * many < 1 << 32 else np.uint64              # the narrower sorts faster
    pairs = []
    for at, col in ngram_columns(data, off):
        if keep is not None:
            col = keep[col]
            hit = np.flatnonzero(col >= 0)
            at, col = at[hit], col[hit]
        pairs.append(owner[at].astype(wide) * wide(many) + col.astype(wide))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.concatenate(pairs)
    pair.sort()
    fresh = np.ones(len(pair), bool)
    fresh[1:] = pair[1:] != pair[:-1]
    pair = pair[fresh].astype(np.int64)
    return pair // max(many, 1), pair % max(many, 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents of either label with each column, in slices of the columns."""
    found = np.zeros((2, WIDTH), np.int32)
    rows = [0, 0]
    for batch in batches:
        toxic = batch.column(0).to_numpy(zero_copy_only=False)
        data, off = buffers(batch.column(1))
        for a, b, d, o in chunks(data, off, 1 << 20):
            doc, col = _distinct(d, o, None)
            label = toxic[a:b][doc]
            for k in (0, 1):
                found[k] += np.bincount(col[label == k], minlength=WIDTH).astype(np.int32)
                rows[k] += int((toxic[a:b] == k).sum())
    if sum(rows):
        part = WIDTH // _SLICES
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_SLICES), pa.int32()),
             *[pa.array([found[k, i * part:(i + 1) * part].tobytes() for i in range(_SLICES)], pa.binary())
               for k in (0, 1)],
             *[pa.array([rows[k]] * _SLICES, pa.int64()) for k in (0, 1)]],
            ["part", "clean", "toxic", "n_clean", "n_toxic"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the slices of a partition; holds one array per slice."""
    totals: dict[int, list] = {}
    for batch in batches:
        for part, c, t, nc, nt in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            new = [np.frombuffer(c, np.int32).astype(np.int64), np.frombuffer(t, np.int32).astype(np.int64), nc, nt]
            old = totals.get(part)
            totals[part] = new if old is None else [x + y for x, y in zip(old, new, strict=True)]
    if totals:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()),
             *[pa.array([v[k].tobytes() for v in totals.values()], pa.binary()) for k in (0, 1)],
             *[pa.array([v[k] for v in totals.values()], pa.int64()) for k in (2, 3)]],
            ["part", "clean", "toxic", "n_clean", "n_toxic"])


def log_count_ratios(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Counts of (clean, toxic) documents per column, and of all documents."""
    schema = "part int, clean binary, toxic binary, n_clean bigint, n_toxic bigint"
    sums = (labelled.select("toxic", "text").mapInArrow(_count, schema)
            .repartition(_SLICES, "part").mapInArrow(_sum, schema)).collect()    # 64 slices of fixed size
    clean, toxic = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
    size, n = WIDTH // _SLICES, (0, 0)
    for r in sums:
        clean[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["clean"], np.int64)
        toxic[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["toxic"], np.int64)
        n = (r["n_clean"], r["n_toxic"])
    return clean, toxic, *n


def choose_columns(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int,
                   errors: float) -> tuple[np.ndarray, np.ndarray]:
    """Kept columns and their log-count ratios."""
    ratio = (np.log((toxic + 1) / (toxic.sum() + WIDTH)) - np.log((clean + 1) / (clean.sum() + WIDTH)))
    p, q = toxic / n_toxic, clean / n_clean
    both = (toxic + clean) / (n_toxic + n_clean)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_toxic + 1 / n_clean))
    kept = np.flatnonzero((toxic + clean >= 5) & (np.abs(p - q) / error >= errors))
    return kept, ratio[kept]


def _labelled(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """(key, toxic, text) of the marked documents; a bitmap keeps other texts out of the shuffle."""
    wanted = bitmap.keep(texts, "key", bitmap.build(marks, "key"))
    return wanted.join(marks.select("_lid", "toxic").hint("shuffle_hash"),
                       F.col("_id") == F.col("_lid")).select("key", "toxic", "text")


def train(texts: DataFrame, marks: DataFrame, per_class: int = 3000, errors: float = 4.0,
          mean_share: float = 0.25) -> dict:
    """Model from texts (_id, key, text) and marks (_lid, key, toxic).

    One task fits the SVM on the bounded sample.
    """
    clean, toxic, n_clean, n_toxic = log_count_ratios(_labelled(texts, marks))
    if not n_clean or not n_toxic:
        share = n_toxic / (n_clean + n_toxic) if n_clean + n_toxic else 0.0
        return {"kept": np.zeros(0, np.int64), "weights": np.zeros(0), "bias": 0.0, "a": 0.0,
                "b": 50.0 if share == 1 else -50.0}
    kept, ratio = choose_columns(clean, toxic, n_clean, n_toxic, errors)
    keep = np.full(WIDTH, -1, np.int32)
    keep[kept] = np.arange(len(kept))
    within = F.lit(False)
    for label, bound in sample_bounds(marks, "toxic", "key", per_class).items():
        within = within | ((F.col("toxic") == label) & (F.col("key") <= bound))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            for a, b, d, o in chunks(data, off, 1 << 20):
                doc, col = _distinct(d, o, keep)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array([col[cut[i]:cut[i + 1]].astype(np.int32).tobytes() for i in range(b - a)],
                              pa.binary())], ["key", "toxic", "cols"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "toxic", "cols"])
        cols = [np.frombuffer(x, np.int32) for x in pdf["cols"]]
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in cols])])
        flat = np.concatenate(cols)
        vals = ratio[flat] if len(flat) else np.zeros(0)
        label = pdf["toxic"].to_numpy() == 1
        w, bias = fit_svm(vals, flat, offsets, np.where(label, 1.0, -1.0), len(kept), cost=0.1)
        w = mean_share * np.abs(w).mean() * np.sign(w) + (1 - mean_share) * w if len(w) else w
        w = w * ratio
        total = np.concatenate([[0.0], np.cumsum(w[flat])])[offsets]
        weight = np.where(label, n_toxic / max(label.sum(), 1), n_clean / max((~label).sum(), 1))
        a, b = fit_sigmoid(np.diff(total) + bias, label, weight * len(label) / (n_toxic + n_clean))
        return pd.DataFrame({"weights": [w.tobytes()], "bias": [float(bias)], "a": [a], "b": [b]})

    sample = _labelled(texts, marks.filter(within)).mapInArrow(rows, "key bigint, toxic int, cols binary")
    r = sample.groupBy(F.lit(0).alias("all")).applyInPandas(
        fit, "weights binary, bias double, a double, b double").first()
    return {"kept": kept, "weights": np.frombuffer(r["weights"], np.float64), "bias": r["bias"],
            "a": r["a"], "b": r["b"]}


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", folds: int = 5, per_class: int = 3000,
                   errors: float = 4.0) -> DataFrame:
    """One row per document: (id, held_out, score, predicted).

    Learns from documents labelled in ``labels`` whose crc32 of the id modulo
    ``folds`` is not 0.
    """
    marks = (labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_lid"))
             .agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
             .filter(~held_out(F.col("_lid"), folds, 0))
             .withColumn("key", F.xxhash64(F.col("_lid").cast("string"), F.lit(3))))
    texts = docs.filter(~held_out(F.col(id_col), folds, 0)).select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col).cast("string"), F.lit(3)).alias("key"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    model = train(texts, marks, per_class, errors)
    keep = np.full(WIDTH, -1, np.int32)
    keep[model["kept"]] = np.arange(len(model["kept"]))
    weights, kind = model["weights"], docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            for a, b, d, o in chunks(data, off, 2 << 20):
                margin = np.full(b - a, model["bias"])
                if len(weights):
                    doc, col = _distinct(d, o, keep)
                    margin += np.bincount(doc, weights[col], minlength=b - a)
                score = sigmoid(model["a"] * margin + model["b"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                    [id_col, "held_out", "score", "predicted"])

    return docs.select(F.col(id_col), held_out(F.col(id_col), folds, 0).alias("held_out"),
                       F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
