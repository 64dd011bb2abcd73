"""Linear support vector machines on bounded samples, trained inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold`` modulo ``folds``; null ids are '' ."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def sample_bounds(rows: DataFrame, label: str, key: str, size: int) -> dict:
    """For each label the ``size``-th smallest ``key``: a bound for a repeatable sample.

    Keys are 64-bit hashes, so the share of them below a threshold is known: of each
    label only rows below one for about four times ``size`` are ranked, whatever its
    number of rows; where fewer turn up (equal keys), the threshold is widened.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}        # one row per label
    share = {x: min(1.0, 4.0 * size / n) for x, n in counts.items()}
    out: dict = {}
    while share:
        below = F.lit(False)
        for x, part in share.items():
            top = int(part * (1 << 64)) - (1 << 63)
            mine = F.col(label).eqNullSafe(F.lit(x))
            below = below | (mine if part >= 1 else mine & (F.col(key) < F.lit(top)))
        nth = F.row_number().over(W.partitionBy(label).orderBy(key))
        top_rows = rows.select(label, key).filter(below).withColumn("_n", nth).filter(F.col("_n") <= size)
        for r in top_rows.groupBy(label).agg(F.max(key).alias("k"), F.count(F.lit(1)).alias("n")).collect():
            if r["n"] >= min(size, counts[r[0]]):
                out[r[0]] = r["k"]
        share = {x: min(1.0, 4 * part) for x, part in share.items() if x not in out}
    return out


def fit_svm(values: np.ndarray, columns: np.ndarray, offsets: np.ndarray, signs: np.ndarray,
            width: int, cost: float = 1.0, rounds: int = 30, seed: int = 5) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the squared hinge loss; rows are sparse (CSR).

    Returns the weights and the intercept (a column of ones is added).  Rows are
    weighed so that both signs count alike.
    """
    n = len(signs)
    w, b = np.zeros(width), 0.0
    alpha = np.zeros(n)
    square = np.add.reduceat(np.append(values * values, 0.0), offsets[:-1]) * (np.diff(offsets) > 0) + 1.0
    share = np.where(signs > 0, n / (2 * max((signs > 0).sum(), 1)), n / (2 * max((signs < 0).sum(), 1)))
    diag = 1.0 / (2.0 * cost * share)
    order = np.arange(n)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            a, z = offsets[i], offsets[i + 1]
            c, v = columns[a:z], values[a:z]
            g = signs[i] * (w[c] @ v + b) - 1.0 + diag[i] * alpha[i]
            new = max(alpha[i] - g / (square[i] + diag[i]), 0.0)
            step = (new - alpha[i]) * signs[i]
            if step:
                w[c] += step * v
                b += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, b


def fit_sigmoid(margins: np.ndarray, positive: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the probability of the positive class (Newton steps)."""
    hit, miss = weights[positive].sum(), weights[~positive].sum()
    target = np.where(positive, (hit + 1) / (hit + 2), 1 / (miss + 2))
    a, b = 1.0, float(np.log((hit + 1) / (miss + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        d, h = weights * (p - target), weights * np.maximum(p * (1 - p), 1e-9)
        ga, gb = (d * margins).sum() + 1e-3 * (a - 1), d.sum()
        haa, hab, hbb = (h * margins * margins).sum() + 1e-3, (h * margins).sum(), h.sum()
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
