"""Exact top-k search: a Voronoi join with distance bounds.

Pivots cut the space into cells. Every vector knows its cell and its distance from the cell's pivot, so
q.x <= q.p + |q| * |x - p|. A sample of the vectors gives each query a score its k-th best cannot
fall below. Both together tell, for a group of queries and a cell, how far from the pivot a vector must lie
to matter; only those are sent to the group. Groups and what they receive are cut into blocks of
bounded size, solved locally and merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.llm.common import stored
from pagemark.llm.vectors import best_of, dealt, ranked, usable

#: Pivots, and vectors whose scores bound the k-th best from below: both bounded, chosen by hash.
PIVOTS, PROBES = 32, 1_024
#: Queries in a group, and vectors a group reads at once.
QUERIES, BLOCK = 2_048, 16_384
#: Double arithmetic is exact below this; larger sums of products are done in whole numbers.
EXACT = float(1 << 52)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number inner products of all rows of left with all rows of right."""
    largest = (np.abs(left).max(initial=0).astype(float)) * (np.abs(right).max(initial=0).astype(float))
    if largest * left.shape[1] < EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    return left @ right.T


def cells(batches: Iterator[pd.DataFrame], pivots: np.ndarray) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        x = np.stack(batch.vector.to_list()).astype(float)
        apart = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)[None]
        cell = apart.argmin(axis=1)
        # the distance again from the difference, which does not cancel
        far = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
        yield batch.assign(cell=cell.astype(np.int32), far=far)


def needed(
    batches: Iterator[pd.DataFrame], pivots: np.ndarray, probe_ids: np.ndarray, probes: np.ndarray, k: int
) -> Iterator[pd.DataFrame]:
    """Per group of queries and cell: the distance from the pivot below which no vector matters."""
    for batch in batches:
        if not len(batch):
            continue
        q = np.stack(batch.vector.to_list())
        norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
        scores = products(q, probes).astype(float)
        scores[batch.vec_id.to_numpy()[:, None] == probe_ids[None, :]] = -np.inf
        if scores.shape[1] >= k:
            least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        else:
            least = np.full(len(q), -np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = (least[:, None] - q.astype(float) @ pivots.T) / norm[:, None]
        # a zero query scores zero everywhere: everything matters to it
        reach[norm == 0] = -np.inf
        frame = pd.DataFrame(reach).groupby(batch.group.to_numpy()).min()
        yield pd.DataFrame(
            {
                "group": np.repeat(frame.index.to_numpy(dtype=np.int32), frame.shape[1]),
                "cell": np.tile(np.arange(frame.shape[1], dtype=np.int32), len(frame)),
                "reach": frame.to_numpy().ravel(),
            }
        )


def solve(data: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(data) and len(queries):
        ids, x = data.vec_id.to_numpy(), np.stack(data.vector.to_list())
        for first in range(0, len(queries), 128):
            part = queries.iloc[first : first + 128]
            scores = products(np.stack(part["query"].to_list()), x)
            for query_id, row in zip(part.query_id, scores, strict=True):
                # one more, as the query itself may be among them
                best = best_of(ids, row, k + 1)
                best = best[ids[best] != query_id][:k]
                out.append((np.full(len(best), query_id), ids[best], row[best]))
    joined = [np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)] or [np.zeros(0, np.int64)] * 3
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), joined, strict=True)))


def exact_top_k(vectors: DataFrame, is_query: Column, scale: float = 64.0, k: int = 20) -> DataFrame:
    """The k highest scores of each query: query_id, rank, vec_id, score (long), ties to smaller vec_id.

    `vectors(vec_id, embedding)` are turned into whole numbers floor(scale * x); the score is their
    inner product, which must fit a long. `is_query` tells the queries among the rows; all rows but the
    query's own are candidates, all of them are returned if there are k or fewer. Vectors that are NULL or
    hold NULLs or values that are not finite take no part, nor do rows without vec_id; vectors are compared
    with those of their own length, in a search for each length. Repeated rows count once.
    """
    whole = usable(vectors).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * scale).cast("long"))
    )
    whole = stored(whole, "whole")
    sizes = [r["size"] for r in whole.select("size").distinct().collect()]
    parts = [_one_size(whole.where(F.col("size") == n), is_query, k) for n in sorted(sizes)]
    schema = "query_id long, rank int, vec_id long, score long"
    out = whole.sparkSession.createDataFrame([], schema)
    for part in parts:
        out = part if part is parts[0] else out.unionByName(part)
    return out


def _one_size(whole: DataFrame, is_query: Column, k: int) -> DataFrame:
    chosen = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES).collect()
    probe_ids = np.array([r.vec_id for r in chosen])
    probes = np.array([r.vector for r in chosen], dtype=np.int64)
    pivots = probes[:PIVOTS].astype(float)
    kinds = "vec_id long, vector array<long>, cell int, far double"
    placed = stored(
        whole.select("vec_id", "vector").mapInPandas(lambda b: cells(b, pivots), kinds), "cells"
    )
    queries = placed.where(is_query)
    # neighbouring cells share a group; a cell with many queries is dealt to several
    per_cell = {r.cell: r.n for r in queries.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    groups, first = {}, 0
    filled = QUERIES
    for cell in sorted(per_cell, key=lambda c: tuple(pivots[c])):
        if per_cell[cell] > QUERIES:
            count = math.ceil(per_cell[cell] / QUERIES)
            groups[cell] = (first, count)
            first, filled = first + count, QUERIES
        else:
            if filled + per_cell[cell] > QUERIES:
                first, filled = first + 1, 0
            groups[cell] = (first - 1, 1)
            filled += per_cell[cell]
    if not groups:
        return queries.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        ).limit(0)
    start = F.create_map(*[F.lit(x) for c, (g, _) in groups.items() for x in (c, g)])
    count = F.create_map(*[F.lit(x) for c, (_, n) in groups.items() for x in (c, n)])
    group = start[F.col("cell")] + F.pmod(F.xxhash64("vec_id"), count[F.col("cell")]).cast("int")
    queries = queries.withColumn("group", group)
    limits = (
        queries.select("vec_id", "vector", "group")
        .mapInPandas(
            lambda b: needed(b, pivots, probe_ids, probes, k), "`group` int, cell int, reach double"
        )
        .groupBy("group", "cell")
        .agg(F.min("reach").alias("reach"))
    )
    # a little slack covers the rounding of distances
    sent = placed.join(limits, "cell").where(F.col("far") * (1 + 1e-9) + 1e-6 >= F.col("reach"))
    blocks = max(1, math.ceil(placed.count() / BLOCK))
    sent = sent.select("vec_id", "vector", "group", dealt(F.col("vec_id"), blocks, 3).alias("block"))
    asked = queries.select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), "group", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    found = (
        sent.groupBy("group", "block")
        .cogroup(asked.groupBy("group", "block"))
        .applyInPandas(lambda d, q: solve(d, q, k), "query_id long, vec_id long, score long")
    )
    return ranked(found, k)
