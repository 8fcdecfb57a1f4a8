"""Forward-backward beside enumeration, and held-out accuracy."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from pagemark.llm import language


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    sizes = np.array([1, 4, 3])
    scores = rng.normal(size=(8, 3))
    moves = rng.normal(size=(3, 3))
    got = language.forward_backward(scores, sizes, moves)
    first = 0
    for size in sizes:
        part = scores[first : first + size]
        total = np.zeros((size, 3))
        for path in itertools.product(range(3), repeat=int(size)):
            w = np.exp(
                sum(part[i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            )
            for i, y in enumerate(path):
                total[i, y] += w
        np.testing.assert_allclose(got[first : first + size], total / total.sum(axis=1, keepdims=True), rtol=1e-9)
        first += size


def test_features_mark_both_ends():
    found, begin = language.features(["ab", "b"])
    assert len(begin) == 2 and begin[0] == 0
    assert (found >= 0).all() and (found < language.BUCKETS).all()
    one, _ = language.features(["ab"])
    assert sorted(one) == sorted(found[: begin[1]])


def test_held_out_accuracy_and_switched_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language.held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(~held), per_language=150)
    got = language.identify(docs.where(held), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    by = {r.lang: r.text for r in sorted(got, key=lambda r: len(r.text)) if len(r.text) > 600}
    mixed = by["en"][:600] + " " + by["fr"][:600]
    words = language.WORD.findall(mixed.lower())
    gamma = language.forward_backward(model.emissions(words), np.array([len(words)]), model.moves)
    best = [model.labels[i] for i in gamma.argmax(axis=1)]
    half = len(language.WORD.findall(by["en"][:600]))
    assert best[:half].count("en") > 0.9 * half
    assert best[half:].count("fr") > 0.9 * (len(best) - half)


def test_odd_rows_and_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    rows = [
        (1, None, "en", "x", 1),
        (1, "", "en", "x", 1),
        (2, "123 +-", None, "x", 1),
        (None, "the and of", "en", "x", 1),
        (3, "und der die " * 5000, "de", "x", 1),
        (3, "und der die " * 5000, "de", "x", 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    model = language.train(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows)
    assert [r.lang_pred for r in got] == ["und", "und", "und", "en", "de", "de"]
    assert language.identify(docs.limit(0), model).count() == 0
    assert language.train(docs.where("lang is null")) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
