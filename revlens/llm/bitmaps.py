"""A bounded bitmap of hash values that a scan tests rows against.

It only spares work: a value in the set always passes, another passes by chance, and
the joins that follow are exact. Its size does not grow beyond ``MOST_BITS``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MOST_BITS = 1 << 26


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """Words of a bitmap with a bit set for every value of a long column."""
    n = values.count()
    bits = 64
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        values.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("set"))
        .collect()
    )
    out = np.zeros(bits // 64, np.uint64)
    for row in words:
        out[row["word"]] = row["set"] & 0xFFFFFFFFFFFFFFFF
    return out


def passes(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values (as unsigned 64-bit) may be in the set."""
    slot = values & np.uint64(len(words) * 64 - 1)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def without(rows: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows with none of the values of ``values`` in a long column, which is never null; only
    rows that the bitmap lets pass are shuffled."""
    words = rows.sparkSession.sparkContext.broadcast(bitmap(values, column))

    @F.arrow_udf("boolean")
    def may(numbers: pa.Array) -> pa.Array:
        return pa.array(passes(words.value, numbers.to_numpy().view(np.uint64)))

    marked = rows.withColumn("_may", may(column))
    some = marked.where("_may").join(values.select(column), column, "left_anti")
    return marked.where("not _may").unionByName(some).drop("_may")
