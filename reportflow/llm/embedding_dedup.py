"""Embedding near-dedup with randomised-rotation binary codes.

Vectors of one label and length are compared by cosine.  A fixed random rotation
turns a unit vector into one sign bit per dimension; the inner product of the
vector with its code is kept as its correction factor.  Code times rotated query,
divided by the factor, is an unbiased estimate of the cosine, with a standard
error known from the factor (Gao and Long's RaBitQ).  Only pairs whose estimate
plus ``sigmas`` standard errors reaches the threshold are computed again, exactly
and in double precision.

Equal vectors are one node with a count.  Groups above ``cell_rows`` nodes are
cut into cells around centroids, fitted on a bounded sample (32 vectors per
cell).  A vector is at home in the nearest cell and also looks into every cell
whose border with its home is no farther than half the chord of the threshold: of
two vectors within a chord on either side of a border, one is that near to it, so
no linked pair is cut, whatever the width.  Every vector is in the index.  Large
cells are compared block against block.  A block returns link counts and a spanning
forest, not pairs.

Defined cases: a null label, or a vector that is null, empty, zero or holds null
or non-finite components, links with nothing; vectors of different lengths never
link; repeated rows are vectors of their own with cosine 1; an empty table gives
an empty result.  Only the three named columns are read, so other columns may
have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.components import components, forest
from reportflow.session import ensure_checkpoint_dir

BLOCK = 2048
MOST_CELLS = 16_384


def rotation(width: int, seed: int = 64) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed + width).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, sign codes (+-1) and correction factors."""
    turned = unit @ turn
    codes = np.where(turned >= 0, np.float32(1), np.float32(-1))
    return turned.astype(np.float32), codes, np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def likely_pairs(codes: np.ndarray, factor: np.ndarray, queries: np.ndarray, threshold: float,
                 sigmas: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of codes, row of queries) pairs whose upper confidence bound reaches the threshold."""
    width = codes.shape[1]
    estimate = codes @ queries.T / np.float32(math.sqrt(width))
    estimate /= factor.astype(np.float32)[:, None]
    error = np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor / math.sqrt(max(width - 1, 1))
    return np.nonzero(estimate >= (threshold - sigmas * error - 1e-5).astype(np.float32)[:, None])


def _compare(threshold: float, sigmas: float):
    """One block of home vectors against one block of searching vectors."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", ignore_index=True)
        v = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        v = v / np.abs(v).max(1, keepdims=True)          # no overflow in the squares
        unit = v / np.sqrt((v * v).sum(1, keepdims=True))
        turned, codes, factor = encode(unit, rotation(v.shape[1]))
        home, search = np.flatnonzero(pdf["is_home"]), np.flatnonzero(pdf["is_search"])
        rep, copies = pdf["rep"].to_numpy(), pdf["copies"].to_numpy()
        cell, looks = pdf["home"].to_numpy(), [set(x) for x in pdf["looks"]]
        left, right = [], []
        for at in range(0, len(home), 512):
            part = home[at:at + 512]
            i, j = likely_pairs(codes[part], factor[part], turned[search], threshold, sigmas)
            i, j = part[i], search[j]
            other = i != j
            i, j = i[other], j[other]
            for k in range(0, len(i), 65536):
                a, b = i[k:k + 65536], j[k:k + 65536]
                cosine = np.einsum("ij,ij->i", v[a], v[b]) / np.sqrt(
                    np.einsum("ij,ij->i", v[a], v[a]) * np.einsum("ij,ij->i", v[b], v[b]))
                hit = cosine >= threshold
                left.append(a[hit])
                right.append(b[hit])
        a = np.concatenate(left) if left else np.zeros(0, int)
        b = np.concatenate(right) if right else np.zeros(0, int)
        # A pair can meet at the home of either: it counts at the smaller one's,
        # or where only one of the two looks into the other's home.
        once = (rep[a] < rep[b]) | np.fromiter((cell[y] not in looks[x] for x, y in zip(a, b, strict=True)),
                                               bool, len(a))
        a, b = a[once], b[once]
        links = np.bincount(a, copies[b], len(pdf)) + np.bincount(b, copies[a], len(pdf))
        root = forest(a, b, len(pdf))                    # rows are sorted by rep
        some = np.flatnonzero(links > 0)
        return pd.DataFrame({"rep": rep[some], "links": links[some].astype(np.int64), "root": rep[root[some]]})
    return run


def fit_centroids(vectors: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    rng = np.random.default_rng(7)
    c = vectors[rng.permutation(len(vectors))[:cells]]
    for _ in range(rounds):
        near = (vectors @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, vectors)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def _units(column: pa.Array, width: int) -> np.ndarray:
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _assign(centroids: dict, chord: float):
    """Map pass: home cell, and all cells to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = list(zip(batch.column("label").to_pylist(), batch.column("width").to_pylist(), strict=True))
            home, looks = np.zeros(batch.num_rows, np.int32), [[0]] * batch.num_rows
            for key in set(names):
                c = centroids.get(key)
                if c is None:
                    continue
                at = np.array([i for i, x in enumerate(names) if x == key])
                unit = _units(batch.column("embedding").take(pa.array(at)), key[1])
                near = unit @ c.T
                best = near.argmax(1)
                gap = near[np.arange(len(at)), best][:, None] - near
                border = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 1e-12))[best]
                inside = gap / border <= chord / 2 + 1e-9
                home[at] = best
                for i, k in enumerate(at):
                    looks[k] = sorted({int(best[i]), *np.flatnonzero(inside[i]).tolist()})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(looks, pa.list_(pa.int32()))],
                [*batch.schema.names, "home", "looks"])
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93, sigmas: float = 4.0,
                    cell_rows: int = 1024) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept)."""
    ensure_checkpoint_dir(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("embedding"),
                          F.col(label_col).alias("label"))
    big = F.lit(float("inf"))
    sound = F.coalesce(
        F.col("label").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("_sound", sound)
    nodes = (rows.filter("_sound").groupBy("label", "embedding")
             .agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
             .withColumn("width", F.size("embedding")).checkpoint())
    found = _links(nodes, threshold, sigmas, cell_rows).checkpoint()
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(found, "rep", "root").withColumnsRenamed({"node": "rep", "component": "root"})
    named = (nodes.join(counts, "rep", "left").join(parts, "rep", "left")
             .select(F.col("label").alias("_l"), F.col("embedding").alias("_e"),
                     F.coalesce("root", "rep").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    out = rows.join(named, F.col("_sound") & (F.col("label") == F.col("_l"))
                    & (F.xxhash64("embedding") == F.xxhash64("_e"))
                    & (F.col("embedding") == F.col("_e")), "left")
    component = F.coalesce("root", "_id")
    return out.select(F.col("_id").alias(id_col), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))


def _links(nodes: DataFrame, threshold: float, sigmas: float, cell_rows: int) -> DataFrame:
    """(rep, links, root) parts, one set per compared pair of blocks."""
    groups = nodes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
    large = groups.filter(F.col("n") > cell_rows).orderBy(F.desc("n"), "label", "width").limit(
        MOST_CELLS // 2).collect()
    cells = {(r["label"], r["width"]): max(2, math.ceil(math.sqrt(r["n"] / cell_rows))) for r in large}
    shrink = min(1.0, MOST_CELLS / max(sum(cells.values()), 1))
    centroids = {}
    if cells:
        share = F.lit(0.0)
        for r in large:
            key = (r["label"], r["width"])
            cells[key] = max(2, int(cells[key] * shrink))
            share = F.when((F.col("label") == r["label"]) & (F.col("width") == r["width"]),
                           F.lit(32.0 * cells[key] / r["n"])).otherwise(share)
        lot = F.pmod(F.xxhash64("embedding"), F.lit(1 << 20)) / float(1 << 20)
        sample = nodes.filter(lot < share).select("label", "width", "embedding").orderBy(
            "label", "width", "embedding").toArrow()
        names = list(zip(sample["label"].to_pylist(), sample["width"].to_pylist(), strict=True))
        for key, k in cells.items():
            at = [i for i, x in enumerate(names) if x == key]
            if len(at) >= k:
                centroids[key] = fit_centroids(_units(sample["embedding"].take(at).combine_chunks(), key[1]), k)
    chord = math.sqrt(max(2 - 2 * threshold, 0))
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in nodes.columns) + ", home int, looks array<int>"
    placed = nodes.mapInArrow(_assign(centroids, chord), schema)
    spread = placed.withColumn("cell", F.explode("looks")).withColumn("is_home", F.col("cell") == F.col("home"))
    blocks = spread.groupBy("label", "width", "cell").agg(
        F.ceil(F.count_if("is_home") / BLOCK).cast("int").alias("home_blocks"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("search_blocks")).filter("home_blocks > 0")
    dealt = spread.join(blocks, ["label", "width", "cell"])
    lot = F.xxhash64("rep")
    mine_home = F.pmod(lot, F.col("home_blocks")).cast("int")
    mine_search = F.pmod(lot, F.col("search_blocks")).cast("int")
    # A vector meets, as a searcher, every home block of a cell, and at home every search block.
    as_search = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("home_blocks") - 1)).alias("hb"),
                             mine_search.alias("sb"), F.lit(False).alias("h"), F.lit(True).alias("s"))
    as_home = dealt.filter("is_home").select(
        "*", mine_home.alias("hb"), F.explode(F.sequence(F.lit(0), F.col("search_blocks") - 1)).alias("sb"),
        F.lit(True).alias("h"), F.lit(False).alias("s"))
    keys = ["label", "width", "cell", "hb", "sb"]
    both = (as_search.unionByName(as_home).groupBy(*keys, "rep")
            .agg(F.max("h").alias("is_home"), F.max("s").alias("is_search"),
                 F.first("copies").alias("copies"), F.first("home").alias("home"),
                 F.first("looks").alias("looks"), F.first("embedding").alias("embedding")))
    kind = kinds["rep"]
    return both.groupBy(*keys).applyInPandas(_compare(threshold, sigmas), f"rep {kind}, links bigint, root {kind}")
