"""Packing documents into length buckets of least padding.

The histogram of lengths over all documents is aggregated by Spark.  Dynamic
programming over it chooses at most ``buckets`` boundaries such that padding
every document to the boundary of its bucket adds the fewest tokens.  Inside a
bucket, documents in a reproducible random order fill batches of ``budget``
padded tokens.

Lengths count words ([^\\x20\\x09-\\x0D]+).  The driver holds one number per
distinct length, of which there are at most the longest document's length, and
fewer than the square root of twice all words, whatever the number of documents.
The choice is optimal.

Defined cases: null and empty texts have length 0 and pad to their bucket like
any other; a document longer than the budget is a batch of its own; equal rows
are packed one by one; an empty table gives an empty result.  Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.mixing import word_count
from reportflow.llm.ordered import key_range, range_count, running_total, shuffle_key
from reportflow.session import ensure_checkpoint_dir


def choose_boundaries(edges: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper edges of at most ``buckets`` runs of lengths with the least padded total.

    ``edges`` ascend.  cost(i, j) = edges[j] * documents of lengths i..j; the total
    length is fixed, so the least padded total is the least padding.  The cost
    obeys the quadrangle inequality, so the best split point never falls as j
    grows, and each level is filled by halving in O(lengths * log lengths).
    """
    n = len(edges)
    if n == 0:
        return []
    total = np.concatenate([[0], np.cumsum(counts.astype(np.float64))])
    edge = edges.astype(np.float64)
    best = edge * total[1:]
    split: list[np.ndarray] = []
    for _ in range(min(buckets, n) - 1):
        new, arg = best.copy(), np.full(n, -1, np.int64)
        # Halving by levels: the middle of each interval, all intervals at once.
        todo = [(0, n - 1, -1, n - 2)]
        while todo:
            again = []
            for lo, hi, a, b in todo:
                if lo > hi:
                    continue
                mid = (lo + hi) // 2
                first, last = max(a, 0), min(b, mid - 1)
                point = a
                if first <= last:
                    cost = best[first:last + 1] + edge[mid] * (total[mid + 1] - total[first + 1:last + 2])
                    k = int(np.argmin(cost))
                    point = first + k
                    if cost[k] < new[mid]:
                        new[mid], arg[mid] = cost[k], point
                again += [(lo, mid - 1, a, point), (mid + 1, hi, point, b)]
            todo = again
        split.append(arg)
        if not new[n - 1] < best[n - 1]:
            split.pop()
            break
        best = new
    cuts, j = [int(edges[n - 1])], n - 1
    for arg in reversed(split):
        if arg[j] < 0:
            continue
        j = int(arg[j])
        cuts.append(int(edges[j]))
    return sorted(cuts)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   buckets: int = 16, budget: int = 65536, seed: int = 29) -> DataFrame:
    """One row per document: (id, n_tokens, bucket, bucket_len, batch, slot, padding).

    ``bucket`` counts from 0, ``batch`` from 0 within its bucket, ``slot`` from 0
    within its batch.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sized = (docs.select(F.col(id_col).alias("_id"), word_count(F.col(text_col)).alias("n_tokens"))
             .withColumn("_key", shuffle_key(F.lit(seed), F.col("_id"))).checkpoint())
    cells = (sized.groupBy(F.col("n_tokens").alias("edge")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy("edge").toPandas())
    edges = choose_boundaries(cells["edge"].to_numpy(np.int64), cells["n"].to_numpy(np.int64),
                              buckets)
    bucket, length = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for i, e in reversed(list(enumerate(edges))):
        bucket = F.when(F.col("n_tokens") <= e, F.lit(i)).otherwise(bucket)
        length = F.when(F.col("n_tokens") <= e, F.lit(e).cast("bigint")).otherwise(length)
    ranges = range_count(int(cells["n"].sum()))
    placed = (sized.withColumn("bucket", bucket).withColumn("bucket_len", length)
              .withColumn("_at", key_range(F.col("_key"), ranges)).withColumn("_one", F.lit(1)))
    placed = running_total(placed, ["bucket"], "_at", ["_key", "_id", "n_tokens"], "_one", "_rank")
    per = F.greatest(F.lit(1).cast("bigint"), F.floor(
        F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1))).cast("bigint"))
    return placed.select(
        F.col("_id").alias(id_col), "n_tokens", "bucket", "bucket_len",
        F.floor((F.col("_rank") - 1) / per).cast("bigint").alias("batch"),
        F.pmod(F.col("_rank") - 1, per).alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
