"""Both vector searches beside brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemark.llm import nearest, topk

SCHEMA = "vec_id long, embedding array<float>, score string, query_id int"


def frame(spark, vectors):
    return spark.createDataFrame(
        [(i, [None if x is None else float(x) for x in v] if v is not None else None, "s", 1) for i, v in vectors],
        SCHEMA,
    )


def usable(vectors):
    return {
        i: np.array(v, dtype=np.float32).astype(float)
        for i, v in vectors
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)
    }


def brute(found, k, score):
    out = {}
    for q, v in found.items():
        if q % 20 == 0:
            scored = [(-score(v, w), i) for i, w in found.items() if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def whole(a, b):
    return int(np.floor(64 * a).astype(int) @ np.floor(64 * b).astype(int))


def as_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


ODD = [
    (0, [1.0, 0.0]),
    (1, None),
    (2, [None, 1.0]),
    (3, [float("nan"), 1.0]),
    (4, [float("inf"), 1.0]),
    (5, []),
    (6, [0.0, 0.0]),
    (7, [0.5, 0.5]),
    (7, [0.5, 0.5]),
    (8, [0.5, 0.5]),
    (9, [-1.0, 0.0]),
    (20, [3.0, 1.0, 2.0]),
    (21, [1.0, 1.0, 1.0]),
    (40, [0.0, 0.0]),
    (None, [1.0, 1.0]),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_search(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "PROBES", 50)
    monkeypatch.setattr(topk, "PIVOTS", 6)
    rng = np.random.default_rng(seed)
    # tight clusters of differing length, so that bounds cut; rounded, so that scores tie
    centres = rng.normal(size=(5, 4)) * 4
    points = [(i, (centres[i % 5] + rng.normal(size=4) * 0.05).round(1)) for i in range(400)]
    got = as_lists(topk.exact_top_k(frame(spark, points), F.col("vec_id") % 20 == 0, k=5).collect())
    assert got == brute(usable(points), 5, whole)


def test_exact_search_odd_rows(spark):
    got = as_lists(topk.exact_top_k(frame(spark, ODD), F.col("vec_id") % 20 == 0, k=20).collect())
    assert got == brute(usable(ODD), 20, whole)
    assert topk.exact_top_k(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_products_beyond_doubles():
    big = np.array([[2**29 + 1, 3], [5, 7]], dtype=np.int64)
    want = [[int(a) * int(c) + int(b) * int(d) for c, d in big.tolist()] for a, b in big.tolist()]
    assert topk.products(big, big).tolist() == want


def test_bounds_cut_what_is_sent(spark):
    far = np.array([[10.0, 0.0], [0.0, 10.0]])
    batch = __import__("pandas").DataFrame({"vec_id": [0], "vector": [np.array([64, 0])], "group": [0]})
    probes = np.array([[640, 0]] * 3 + [[0, 640]] * 3)
    out = next(topk.needed(iter([batch]), far * 64, np.arange(1, 7), probes, 2))
    reach = dict(zip(out.cell, out.reach, strict=True))
    assert reach[0] == pytest.approx(0) and reach[1] == pytest.approx(640)


@pytest.mark.parametrize("block", [500, nearest.BLOCK])
def test_recall_of_the_approximate_search(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "BLOCK", block)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.collect()
    found = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows}
    got = as_lists(nearest.nearest(vectors, F.col("vec_id") % 20 == 0).collect())
    want = brute(found, 20, lambda a, b: float(a @ b))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    for q, best in got.items():
        assert len(best) == 20
        assert [s for _, s in best] == sorted((s for _, s in best), reverse=True)
        assert all(abs(s - found[q] @ found[i]) < 1e-12 for i, s in best)


def test_approximate_search_of_unequal_lengths(spark):
    rng = np.random.default_rng(7)
    points = [(i, rng.normal(size=16) * rng.lognormal()) for i in range(1200)]
    got = as_lists(nearest.nearest(frame(spark, points), F.col("vec_id") % 20 == 0).collect())
    want = brute(usable(points), 20, lambda a, b: float(a @ b))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


@pytest.mark.parametrize(("size", "sigma"), [(64, 0.0), (64, 0.2), (64, 1.0), (128, 0.0), (128, 0.5)])
def test_approximate_search_of_unequal_lengths_in_a_full_block(spark, tmp_path, size, sigma):
    length = F.exp(F.lit(sigma) * F.randn(size))
    values = F.array(*[(F.randn(i) * length).cast("float") for i in range(size)])
    made = spark.range(0, nearest.BLOCK, 1, 1).select(F.col("id").alias("vec_id"), values.alias("embedding"))
    made.write.parquet(str(tmp_path / "made"))
    vectors = spark.read.parquet(str(tmp_path / "made"))
    rows = vectors.toPandas()
    ids, held = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_list()).astype(float)
    got = as_lists(nearest.nearest(vectors, F.col("vec_id") % 820 == 0).collect())
    assert len(got) == 40
    hits = 0
    for q, best in got.items():
        scores = held @ held[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len({i for i, _ in best} & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert hits / (20 * len(got)) >= 0.95


def test_few_vectors_are_verified(spark):
    """Of random directions, where nothing is near, a twentieth and little more; one path at all sizes."""
    rng = np.random.default_rng(2)
    for n in (450, 9_000):
        vectors = rng.normal(size=(n, 32))
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
        (part,) = nearest.shells(np.arange(n), vectors)
        sizes = [len(part.candidates(v, 21 + max(nearest.LEAST, n // 20))) for v in vectors[:20]]
        assert 20 + nearest.LEAST < max(sizes) <= max(450, 0.12 * n)


def test_approximate_search_odd_rows(spark):
    got = as_lists(nearest.nearest(frame(spark, ODD), F.col("vec_id") % 20 == 0, k=20).collect())
    rest = {i: v for i, v in usable(ODD).items() if (v != 0).any()}
    assert got == brute(rest, 20, lambda a, b: float(a @ b))
    assert nearest.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
