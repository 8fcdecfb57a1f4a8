"""Collocations beside plain counting in Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from pagemark.llm import collocations

SCHEMA = "doc_id long, text string, lang string, score string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(rows):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i : i + k])] += 1
    return counts, totals


def plain(rows, least, top):
    counts, totals = counts_of(rows)
    out = []
    for lang, c in counts.items():
        found = []
        frequent = {p: a for p, a in c.items() if a >= least}
        for p, a in frequent.items():
            if len(p) < 2:
                continue
            holders = [
                q
                for q, b in frequent.items()
                if len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if holders:
                continue
            n = totals[lang]
            score, k = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, text, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, text.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def rows_of(seed, n):
    rng = random.Random(seed)
    words = ["The", "of", "a", "Große", "x", "y", "z w", "\U0001f600", *[f"w{i}" for i in range(30)]]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(40)):
            text += rng.choice(["of the a", "The of", *rng.choices(words, k=6)]) + rng.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "!?"])
        rows.append((i % 7, text, rng.choice(["en", "en", "de", None]), "x"))
    rows += [(1, None, "en", None), (None, "", "fr", None), (2, " \t ", None, None), (3, ".;:!?", "en", "y")]
    rows += [(9, "hot hot hot hot hot hot hot " * 40, "en", None)] * 3
    return rows


@pytest.mark.parametrize("budget", [collocations.BUDGET, 400, 20])
def test_same_as_plain_counting(spark, budget):
    rows = rows_of(3, 300)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = collocations.collocations(docs, least=6, top=60, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 6, 60)


def test_counts_of_all_lengths_when_prefixes_are_extended_to_the_end(spark):
    # one phrase of five words is more frequent than the budget: its count comes without a subtree
    rows = [(i, "in the end of all that, in the end of all", "en", None) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    _, totals, phrases = collocations.phrase_counts(docs, least=40, budget=30)
    counts, sums = counts_of(rows)
    assert phrases.count() == len([1 for n in counts["en"].values() if n >= 40])
    assert phrases.distinct().count() == phrases.count()
    assert sorted(r.n for r in phrases.collect()) == sorted(n for n in counts["en"].values() if n >= 40)
    assert totals.first().n == sums["en"]


def test_large_counts_stay_exact(spark):
    big = 10**14
    candidates = spark.createDataFrame([("en", [1, 2, 3], big)], "lang string, phrase array<long>, a long")
    phrases = spark.createDataFrame(
        [([1], big + 7), ([2, 3], big + 11), ([1, 2], 2 * big), ([3], big + 1)], "phrase array<long>, n long"
    )
    totals = spark.createDataFrame([("en", 5 * big)], "lang string, n long")
    row = collocations.cut_scores(candidates, phrases, totals).first()
    assert row.score == 1000 * big * 5 * big // (2 * big * (big + 1))
    assert (row.l, row.r) == (2 * big, big + 1)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
