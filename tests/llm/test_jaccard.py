"""The Jaccard join beside brute force over all pairs."""

import random
import re
import string

import pytest

from pagemark.llm import jaccard

SCHEMA = "doc_id long, text string, n long, set_id string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def word_sets(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width=4, percent=85):
    sets = [word_sets(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        t = top(i)
        if doc is not None and (least.get(t) is None or doc < least[t]):
            least[t] = doc
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(((d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)), key=key)


def found(spark, rows, **kw):
    docs = spark.createDataFrame([(d, t, 3, "x") for d, t in rows], SCHEMA)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted((tuple(r) for r in jaccard.near_duplicates(docs, **kw).collect()), key=key)


def corpus(seed, count=260):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(14)]
    texts = []
    for _ in range(count):
        if texts and rng.random() < 0.6:
            base = list(rng.choice(texts))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                if base:
                    at = rng.randrange(len(base))
                    rng.choice([lambda: base.pop(at), lambda: base.insert(at, "x"), lambda: base.__setitem__(at, rng.choice(words))])()
            texts.append(base)
        else:
            base = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 9, 10, 11, 20, 40, 120]))]
            texts.append(base + passage if rng.random() < 0.4 else base)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(
    ("seed", "short", "block", "light"), [(1, 64, 1024, 64), (2, 2, 8, 64), (3, 2, 1024, 0), (4, 5, 5, 30)]
)
def test_components(spark, monkeypatch, seed, short, block, light):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LARGEST_LIGHT", light)
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_forced_boundary(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "light_boundary", lambda prefixes: 25)
    rows = corpus(9)
    assert found(spark, rows) == brute(rows)


def test_five_words_and_four_fifths(spark):
    rows = corpus(5, 150)
    assert found(spark, rows, width=5, percent=80) == brute(rows, 5, 80)


def test_odd_rows(spark):
    long = " ".join(f"a{i}" for i in range(30_000))
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "One two"), (9, "one TWO"), (3, "one two three four five"),
        (3, "one two three four five"), (2, "One two three four five"), (None, "one two three four five"),
        (None, "lonely words here"), (11, long), (12, long + " more"), (13, "É b c d"), (14, "é b c d"),
        (15, "a b c"), (16, "a b c"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_one_hot_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(200):
        words = list(base)
        for _ in range(rng.choice([1, 2])):
            words[rng.randrange(60)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"q{i} r{i} s{i} t{i} u{i}") for i in range(50)]
    assert found(spark, rows) == brute(rows)
