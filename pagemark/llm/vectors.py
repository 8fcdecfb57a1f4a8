"""What the two vector searches share: usable vectors, the grid of blocks, and the merge."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles), size: rows without NULLs, infinities or NaN, one for each vec_id.

    A vec_id that occurs with several vectors keeps the smallest in array order, so repeated rows count
    once.
    """
    broken = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
        .where("vec_id is not null and vector is not null and size(vector) > 0")
        .where(~broken)
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("size", F.size("vector"))
    )


def dealt(key: Column, parts: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(parts)).cast("int")


def every(parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, the highest first, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query over all blocks; a block has sent k at most."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
