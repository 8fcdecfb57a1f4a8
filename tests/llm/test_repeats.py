"""Substring dedup beside plain sets of windows in Python."""

import random
import re
from collections import Counter

from pagemark.llm import repeats

SCHEMA = "doc_id long, text string, key string, spans string, row_key string, n_words string"


def plain(rows, width):
    words = [re.findall(r"[^ \t-\r]+", r[1] or "") for r in rows]
    last = float("inf")
    first = {}
    for r, w in zip(rows, words):
        doc = last if r[0] is None else r[0]
        for i in range(len(w) - width + 1):
            held = tuple(w[i : i + width])
            first[held] = min(first.get(held, last), doc)
    out = Counter()
    for r, w in zip(rows, words):
        doc = last if r[0] is None else r[0]
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[r[0], kept, *r[2:5], len(w), len(gone)] += 1
    return out


def got(spark, rows, width):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = repeats.dedup_passages(docs, width)
    assert out.columns == ["doc_id", "text", "key", "spans", "row_key", "n_words", "n_removed"]
    return Counter(map(tuple, out.collect()))


def text_of(rng, vocabulary, n):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\n", "\t", "\r\n"]) for _ in range(n))


def rows_of(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Größe", "\U0001f600", "a b"]
    passages = [text_of(rng, words, rng.randrange(10, 60)) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [rng.choice([text_of(rng, words, rng.randrange(30)), rng.choice(passages)]) for _ in range(rng.randrange(6))]
        rows.append((i, " ".join(parts), "k", "s", None, "x"))
    # few words: paths that run into themselves
    rows += [(200 + i, text_of(rng, ["a", "b"], rng.randrange(80)), "k", None, "r", "x") for i in range(40)]
    rows += [(300, "same " * 50, None, None, None, None), (301, "same " * 20, None, None, None, None)]
    rows += [(5, rows[5][1], "k", "s", None, "x")] * 3  # repeated rows
    rows += [(6, passages[0] + passages[1], "k", None, None, None), (None, passages[0], "k", None, None, None)]
    rows += [(None, passages[0], "k", None, None, None), (None, "only here " * 20, "n", None, None, None)]
    rows += [(400, None, None, None, None, None), (401, "", "e", None, None, None), (402, " \n ", "b", None, None, None)]
    rows += [(500, text_of(rng, words, 5_000) + passages[2], "long", None, None, None)]
    rng.shuffle(rows)
    return rows


def test_same_as_plain_windows(spark):
    rows = rows_of(1)
    assert got(spark, rows, 13) == plain(rows, 13)


def test_other_widths(spark):
    rows = rows_of(2)
    assert got(spark, rows, 8) == plain(rows, 8)


def test_spans_name_their_source(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(1, f"a b c {shared} d", *[None] * 4), (2, f"{shared} e f", *[None] * 4), (3, f"x {shared}", *[None] * 4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = repeats.repeated_spans(docs).collect()
    assert sorted((s.start, s.n_words, s.source_id, s.source_start) for r in found for s in r.spans) == [
        (0, 40, 1, 3),
        (1, 40, 1, 3),
    ]


def test_a_passage_in_very_many_documents_is_one_path(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    rows = [(i, f"{i} {shared} {-i}", *[None] * 4) for i in range(2_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = repeats.repeated_spans(docs).collect()
    assert len(found) == 1_999
    assert {(s.start, s.n_words, s.source_id, s.source_start) for r in found for s in r.spans} == {(1, 30, 0, 1)}


def test_empty_table(spark):
    assert got(spark, [], 13) == Counter()
