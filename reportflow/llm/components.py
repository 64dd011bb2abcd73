"""Connected components by alternating large-star and small-star steps.

Each step joins edges to the smallest neighbour of a node, which is aggregated
before the shuffle; no node's neighbours are ever gathered in one place.  Edges
are written to the checkpoint folder after every round, so lineage stays short.
A round works in as many partitions as its edges fill (``EDGES`` each): the last
edges of many rounds need no shuffle through all of the cluster's partitions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.session import ensure_checkpoint_dir

EDGES = 1 << 16


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``edges`` but the smallest of each component.

    ``component`` is the smallest node that can be reached.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter("u <> v").distinct().checkpoint())
    state = _state(e)
    while state[0]:
        parts = -(-state[0] // EDGES)
        e = e.coalesce(parts)
        both = _pairs(e, ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").coalesce(parts).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        new = _pairs(large.join(smallest, "u"), ("v", "m"), ("u", "m")).filter("u <> v").coalesce(parts)
        new = new.distinct().checkpoint()
        before, state = state, _state(new)
        e = new
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _pairs(e: DataFrame, *ways: tuple[str, str]) -> DataFrame:
    """Each row as several edges (u, v), in the partition it is in."""
    each = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ways])
    return e.select(F.explode(each).alias("p")).select("p.u", "p.v")


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        root = new[root]
        apart = root[a] != root[b]
        if not apart.any():
            break
        a, b = a[apart], b[apart]
    return root
