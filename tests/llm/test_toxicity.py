"""Segment search beside brute force, and held-out accuracy."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemark.llm import language, toxicity


def brute_maximal(scores):
    """By the definition: take the best segment (shortest, then leftmost), then both rests."""

    def go(lo, hi):
        best = None
        for a in range(lo, hi):
            total = 0
            for b in range(a + 1, hi + 1):
                total += scores[b - 1]
                if total > 0 and (best is None or (total, -(b - a), -a) > (best[2], -(best[1] - best[0]), -best[0])):
                    best = (a, b, total)
        if best is None:
            return []
        return go(lo, best[0]) + [best] + go(best[1], hi)

    return go(0, len(scores))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(-7, 7), max_size=14))
def test_maximal_segments(scores):
    # irrational-like offsets keep ties out of the definition
    values = [s + 0.001 * np.sin(i + 1) for i, s in enumerate(scores)]
    got = toxicity.maximal_segments(np.array(values, dtype=float))
    want = brute_maximal(values)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    held = language.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, labels.where(~held))
    got = toxicity.score_documents(docs, model).join(labels.where(held), "doc_id").collect()
    assert len(got) > 500
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.96
    caught = [r for r in got if r.toxic]
    assert sum(r.predicted for r in caught) / len(caught) > 0.8
    for r in got:
        assert 0 <= r.score <= 1
        assert all(p.start < p.end and p.expected < 1 for p in r.passages)


def test_odd_rows_and_nothing_to_learn(spark):
    schema = "doc_id long, text string, score string"
    rows = [(1, None, "x"), (1, "", "x"), (None, "a scum b", "x"), (2, "scum " * 40_000, "x"), (2, "calm", "x")]
    docs = spark.createDataFrame(rows, schema)
    model = toxicity.Model({"scum": 4.0, "calm": 0.0}, {}, 1.0, 1e-4, -4.0, 1.0)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(rows)
    assert [r.predicted for r in got] == [0, 0, 1, 1, 0]
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bare = toxicity.train(docs, labels)
    assert all(r.predicted == 0 for r in toxicity.score_documents(docs, bare).collect())
