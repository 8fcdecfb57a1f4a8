"""Approximate nearest neighbours by collision counting.

Every vector is projected on M orthogonal random directions, and each projection is kept as one sorted
array. A query looks into a window around its own value in every array. Windows grow by a factor, a
wider window takes in the narrower one, without another index: virtual rehashing. A vector that lies in the
windows of enough arrays is verified by its exact score; windows grow until enough vectors collide. That takes vectors of nearly equal length, so a block is cut into shells by length, each
with arrays of its own; shells too short to hold a better one are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.llm.common import stored
from pagemark.llm.vectors import best_of, dealt, every, ranked, usable

#: Fewest and most projections (as many as components between), and the share of them that must collide.
FEWEST, MOST = 64, 255
COLLIDING = 0.85
#: Vectors of a shell that are verified: k, a share of the shell, and so many at least.
VERIFIED, LEAST = 0.05, 400
#: First half-width and its growth, in units of the projections' spread.
FIRST_WIDTH, GROWTH = 1.0, 1.02
#: Longest to shortest vector of a shell; a shell goes on beyond that until it has so many vectors.
RATIO, SHELL = 1.1, 256
#: Vectors in a block of the index, which ranks of 16 bits can tell, and queries that visit it together.
BLOCK, QUERIES = 32_768, 2_048
#: Vectors whose collisions are counted at once, and the share of a shell that finds the width.
PORTION, PROBED = 4_096, 8


def directions(size: int, count: int, seed: int) -> np.ndarray:
    """`count` random directions, orthogonal in groups of at most `size`; columns of unit length."""
    rng = np.random.default_rng(seed)
    parts = []
    while count > 0:
        basis, _ = np.linalg.qr(rng.normal(size=(size, min(size, count))))
        parts.append(basis)
        count -= basis.shape[1]
    return np.concatenate(parts, axis=1)


class Index:
    """Sorted projections of a shell of vectors, kept as the rank of every vector in every array.

    Inner products become distances by one more component, which gives all vectors the length of the
    longest; queries have a zero there.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, seed: int = 23):
        self.ids, self.vectors, self.longest = ids, vectors, longest
        n = len(ids)
        rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
        lifted = np.concatenate([vectors, rest[:, None]], axis=1)
        count = min(MOST, max(FEWEST, lifted.shape[1]))
        self.axes = directions(lifted.shape[1], count, seed)
        self.needed = math.ceil(COLLIDING * count)
        placed = (lifted @ self.axes).T
        order = np.argsort(placed, axis=1, kind="stable")
        # the sorted arrays lie one behind the other, each lifted above the one before, so one
        # search finds the borders of all windows
        self.lift = np.arange(count) * (4.0 * longest)
        self.sorted = (np.take_along_axis(placed, order, axis=1) + self.lift[:, None]).ravel()
        self.starts = np.arange(count) * n
        ranks = np.empty((count, n), np.uint16)
        np.put_along_axis(ranks, order, np.arange(n, dtype=np.uint16)[None, :], axis=1)
        # a portion of the vectors, all its ranks together
        self.portions = [np.ascontiguousarray(ranks[:, i : i + PORTION]) for i in range(0, n, PORTION)]
        self.probe = np.ascontiguousarray(ranks[:, : math.ceil(n / PROBED)])
        self.spread = longest / math.sqrt(lifted.shape[1])
        self.width = FIRST_WIDTH * self.spread

    def windows(self, centre: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """First rank and number of ranks within `width` of the query, in every array."""
        reach = min(width, 2.0 * self.longest)  # no window leaves its array
        low = np.searchsorted(self.sorted, centre - reach + self.lift)
        high = np.searchsorted(self.sorted, centre + reach + self.lift, "right")
        return (low - self.starts).astype(np.uint16)[:, None], (high - low).astype(np.uint16)[:, None]

    def colliding(self, ranks: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the vectors of these ranks lie in the windows of enough arrays."""
        inside = (ranks - low) < size
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8) >= self.needed

    def candidates(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """The vectors that collide once windows are wide enough for `wanted` of them."""
        n = len(self.ids)
        wanted, probed = min(wanted, n), self.probe.shape[1]
        # scaled to the common length: the same order, and the centre of the windows is meaningful
        centre = np.append(query * (self.longest / np.linalg.norm(query)), 0.0) @ self.axes
        # from somewhat below the width that the query before has come to, or at the first one
        width = max(FIRST_WIDTH * self.spread, self.width / GROWTH**2)
        # a part of the vectors tells how wide about, and all of them whether that is enough
        share = min(probed, math.ceil(wanted * probed / n))
        while width < 2.0 * self.longest:
            if self.colliding(self.probe, *self.windows(centre, width)).sum() >= share:
                break
            width *= GROWTH
        while True:
            if width >= 2.0 * self.longest:
                return np.arange(n)  # the windows hold all
            borders = self.windows(centre, width)
            found = np.flatnonzero(np.concatenate([self.colliding(p, *borders) for p in self.portions]))
            if len(found) >= wanted:
                self.width = width
                return found
            width *= GROWTH

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        # one more than wanted, as the query itself may be among them
        found = self.candidates(query, k + 1 + max(LEAST, math.ceil(VERIFIED * len(self.ids))))
        found = found[self.ids[found] != query_id]
        scores = self.vectors[found] @ query
        best = best_of(self.ids[found], scores, k)
        return self.ids[found][best], scores[best]


def shells(ids: np.ndarray, vectors: np.ndarray) -> list[Index]:
    """The vectors by length, the longest first, in shells of nearly equal or of few ones."""
    norms = np.linalg.norm(vectors, axis=1)
    order = np.lexsort((ids, -norms))
    norms, out, begin = norms[order], [], 0
    while begin < len(order):
        narrow = np.searchsorted(-norms, -norms[begin] / RATIO, "right")
        end = max(int(narrow), begin + SHELL)
        places = order[begin:end]
        out.append(Index(ids[places], vectors[places], float(norms[begin])))
        begin = end
    return out


def search_shells(parts: list[Index], query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    length = np.linalg.norm(query)
    ids, scores = np.empty(0, dtype=np.int64), np.empty(0)
    for part in parts:
        # no product exceeds that of the lengths; a little more for rounding
        if len(ids) >= k and scores[k - 1] > length * part.longest * (1 + 1e-9):
            break
        more, theirs = part.search(query_id, query, k)
        ids, scores = np.concatenate([ids, more]), np.concatenate([scores, theirs])
        best = best_of(ids, scores, k)
        ids, scores = ids[best], scores[best]
    return ids, scores


def search_block(data: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    rows = []
    if len(data) and len(queries):
        parts = shells(data.vec_id.to_numpy(), np.stack(data.vector.to_list()))
        for query_id, vector in zip(queries.query_id, queries["query"], strict=True):
            ids, scores = search_shells(parts, query_id, np.asarray(vector), k)
            rows.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores}))
    return (
        pd.concat(rows)
        if rows
        else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )
    )


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The k largest inner products found for each query: query_id, rank, vec_id, score.

    `vectors(vec_id, embedding)`; `is_query` tells the queries among them. Every usable vector except
    the query's own is indexed and may be found; scores are exact, and recall is what the method
    gives (measured in the tests). Vectors that are NULL, zero, or hold NULLs or values that are not
    finite take no part, nor do rows without vec_id; vectors are compared with those of their own length.
    With k or fewer candidates all are found. Ties go to the smaller vec_id. The vectors are dealt by
    hash to blocks of bounded size, and queries visit every block.
    """
    data = usable(vectors)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    data = stored(data.withColumn("norm", norm).where("norm > 0"), "vectors")
    rows = data.count()
    queries = data.where(is_query)
    blocks = max(1, math.ceil(rows / BLOCK))
    groups = max(1, math.ceil(queries.count() / QUERIES))
    data = data.select(
        "vec_id", "vector", "size", dealt(F.col("vec_id"), blocks, 1).alias("block"), every(groups).alias("visit")
    )
    queries = queries.select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), "size", every(blocks).alias("block"), dealt(F.col("vec_id"), groups, 2).alias("visit")
    )
    key = ("size", "block", "visit")
    found = (
        data.groupBy(*key)
        .cogroup(queries.groupBy(*key))
        .applyInPandas(
            lambda d, q: search_block(d, q, k), "query_id long, vec_id long, score double"
        )
    )
    return ranked(found, k)
