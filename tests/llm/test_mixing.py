"""Poisson replication beside a plain inversion in Python."""

import hashlib
import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagemark.llm import mixing

SCHEMA = "doc_id long, text string, source string, copy_no string"


def inverse(rate, point):
    n, p = 0, math.exp(-rate)
    total = p
    while total <= point and n < 10_000:
        n += 1
        p *= rate / n
        total += p
    return n


def point(doc_id, seed=17):
    digest = hashlib.md5(f"{seed}|{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(digest[:13], 16) / 2**52


def test_counts_follow_the_inverse(spark):
    rows = [(i, f"t{i}", ("big", "big", "big", "small", None)[i % 5], "z") for i in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter(r.doc_id for r in mixing.mix_sources(docs, total=2000).collect())
    sizes = Counter(s for _, _, s, _ in rows)
    shares = sum(math.sqrt(n) for n in sizes.values())
    for i, _, s, _ in rows:
        rate = 2000 * math.sqrt(sizes[s]) / shares / sizes[s]
        assert got[i] == inverse(rate, point(i)), i


def test_weights_are_met_and_order_is_random(spark):
    rows = [(i, "t", "a" if i < 3000 else "b", None) for i in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    out = mixing.mix_sources(docs, weights={"a": 1.0, "b": 3.0}, total=4000)
    got = out.collect()
    share = Counter(r.source for r in got)
    assert share["a"] == pytest.approx(1000, rel=0.12)
    assert share["b"] == pytest.approx(3000, rel=0.08)
    assert len({(r.doc_id, r.copy_no) for r in got}) == len(got)
    parts = out.rdd.glom().map(lambda part: [r.shuffle_key for r in part]).collect()
    assert all(p == sorted(p) for p in parts)
    again = mixing.mix_sources(docs.repartition(3), weights={"a": 1.0, "b": 3.0}, total=4000)
    assert sorted(got) == sorted(again.collect())


def test_unnamed_sources_nulls_repeats_and_empty(spark):
    rows = [(1, "t", "a", None), (1, "u", "a", None), (None, None, None, None), (2, "", "c", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix_sources(docs, weights={"a": 1.0}, total=8).collect()
    assert {r.source for r in got} <= {"a"}
    assert Counter(r.text for r in got)["t"] == Counter(r.text for r in got)["u"] == inverse(4, point(1))
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mix_sources(docs, weights={"none": 1.0}).count() == 0


def test_very_high_rate(spark):
    docs = spark.createDataFrame([(1, "t", "a", None)], SCHEMA)
    n = mixing.mix_sources(docs, total=2000).count()
    assert abs(n - 2000) < 250


@pytest.mark.parametrize("rate", [150.0, 184.5, 2_000.0, 200_000.0])
def test_steps_at_high_rates(spark, rate):
    start = time.perf_counter()
    row = spark.range(1).select(
        mixing.fewest_copies(F.lit(rate)).alias("first"), mixing.poisson_steps(F.lit(rate)).alias("steps")
    ).first()
    assert time.perf_counter() - start < 20
    assert len(row.steps) < 24 * math.sqrt(rate) + 200 and row.steps[-1] == pytest.approx(1.0, abs=1e-12)
    # beside the probabilities by lgamma, added up exactly
    ks = range(row.first, row.first + len(row.steps))
    terms = [math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in ks]
    for i in range(0, len(terms), max(1, len(terms) // 50)):
        assert row.steps[i] == pytest.approx(math.fsum(terms[: i + 1]), abs=1e-8)


def test_a_source_of_one_row_at_a_high_rate(spark):
    rows = [(1, "t", "small", None)] + [(i, "t", "big", None) for i in range(2, 50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter(r.source for r in mixing.mix_sources(docs, weights={"small": 1.0}, total=100_000).collect())
    assert abs(got["small"] - 100_000) < 6 * math.sqrt(100_000) and got["big"] == 0


def test_no_weights_at_all(spark):
    docs = spark.createDataFrame([(1, "t", "a", None)], SCHEMA)
    assert mixing.mix_sources(docs, weights={}).count() == 0
