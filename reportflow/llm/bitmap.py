"""A membership bitmap of fixed size over 64-bit hashes, built by Spark.

The bitmap only spares work: a hash that was put in is always found, others are
found rarely while few hashes were put in and often when many were, so whatever
is let through has to be joined exactly afterwards.  Its size (4 MB) does not
depend on the input, which bounds both what the driver gathers and what it
broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 25


def build(df: DataFrame, column: str) -> np.ndarray:
    """Bitmap of a bigint column: at most 2**19 words of 64 bits reach the driver."""
    place = F.shiftrightunsigned(F.col(column), 64 - BITS)
    cells = (df.filter(F.col(column).isNotNull())
             .select(F.shiftright(place, 6).alias("word"),
                     F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                     F.pmod(place, F.lit(64)).cast("int")).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits"))).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[cells["word"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return out


def contains(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.view(np.uint64) >> np.uint64(64 - BITS)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def keep(df: DataFrame, column: str, bitmap: np.ndarray) -> DataFrame:
    """Rows whose hash may be in the bitmap (all that are, and few others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(column).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(contains(bitmap, hashes)))

    return df.mapInArrow(run, df.schema)
