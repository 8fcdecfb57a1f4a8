"""Line dedup beside brute force over all pairs of lines."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagemark.llm import lines

SCHEMA = "doc_id long, text string, n_kept string, h1 int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def near(a, b, edits):
    """Unequal lengths and letters rule most pairs out before the table is filled."""
    if abs(len(a) - len(b)) > edits or sum((Counter(a) - Counter(b)).values()) > edits:
        return False
    return distance(a, b) <= edits


def brute(rows, edits, near_from):
    places = sorted(
        ((d is None, d or 0), i, raw.strip(lines.BLANKS))
        for d, text in rows
        for i, raw in enumerate((text or "").split("\n"))
        if raw.strip(lines.BLANKS)
    )
    first = {}
    for doc, i, line in places:
        first.setdefault(line, (doc, i))
    gone = set()
    for x, px in first.items():
        for y, py in first.items():
            if py < px and min(len(x), len(y)) >= near_from and near(x, y, edits):
                gone.add(x)
    out = []
    for d, text in rows:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        kept, all_lines, kept_lines = [], 0, 0
        for i, raw in enumerate(text.split("\n")):
            line = raw.strip(lines.BLANKS)
            stays = not line or (first[line] == ((d is None, d or 0), i) and line not in gone)
            all_lines += bool(line)
            kept_lines += bool(line and stays)
            if stays:
                kept.append(raw)
        out.append((d, "\n".join(kept), all_lines, kept_lines))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else "") for x in r))


def found(spark, rows, edits, near_from):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    out = lines.dedup_lines(docs, edits, near_from)
    assert out.columns == ["doc_id", "text", "h1", "n_lines", "n_kept"]
    return [(r.doc_id, r.text, r.n_lines, r.n_kept) for r in out.collect()]


def corpus(seed, alphabet="abé日"):
    rng = random.Random(seed)
    pool, rows = [], []
    for d in range(60):
        text = []
        for _ in range(rng.randrange(5)):
            if pool and rng.random() < 0.6:
                line = list(rng.choice(pool))
                for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                    at = rng.randrange(len(line) + 1)
                    kind = rng.randrange(3)
                    if kind == 0:
                        line.insert(at, rng.choice(alphabet))
                    elif at < len(line) and len(line) > 2:
                        if kind == 1:
                            line.pop(at)
                        else:
                            line[at] = rng.choice(alphabet)
                line = "".join(line)
            else:
                line = "".join(rng.choice(alphabet) for _ in range(rng.choice([2, 7, 8, 12, 20])))
            pool.append(line)
            text.append(rng.choice(["", "", " ", "\t"]) + line + rng.choice(["", "\r"]))
        rows.append((d, "\n".join(text)))
    return rows


@pytest.mark.parametrize(("seed", "edits", "near_from"), [(1, 1, 6), (2, 2, 6), (3, 3, 8), (4, 1, 30)])
def test_all_pairs(spark, seed, edits, near_from):
    rows = corpus(seed)
    assert order(found(spark, rows, edits, near_from)) == order(brute(rows, edits, near_from))


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_vectors_equal_the_table(spark, edits):
    rng = random.Random(edits)
    words = ["".join(rng.choice("ab🙂é") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    got = pairs.select("a", "b", lines.within_edits(F.col("a"), F.col("b"), edits).alias("near")).collect()
    for r in got:
        assert r.near == (distance(r.a, r.b) <= edits), (r.a, r.b)


def test_odd_rows(spark):
    long = "x" * 50_000 + "\n" + "\n".join(f"line number {i} of a long text, all of them differ {i * i}" for i in range(3000))
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, "a\n\na\n a \nb\n"), (5, "a"), (None, "b\nonly here"),
        (6, long), (7, long.replace("x" * 50_000, "x" * 49_999 + "y")),
    ]
    got = dict((d, (t, n, k)) for d, t, n, k in found(spark, rows, 1, 30))
    assert got[1] == (None, 0, 0) and got[2] == ("", 0, 0) and got[3] == ("\n\n", 0, 0)
    assert got[4] == ("a\n\nb\n", 4, 2)
    assert got[5] == ("", 1, 0)
    assert got[None] == ("only here", 2, 1)
    assert got[6][2] <= got[6][1] == 3001
    assert got[7] == ("", 3001, 0)
    assert found(spark, [], 1, 30) == []


def test_rows_that_share_an_id(spark):
    rows = [(1, "same\nother one"), (1, "same\nother one"), (2, "same")]
    got = found(spark, rows, 1, 30)
    assert sorted(t for _, t, _, _ in got) == ["", "same\nother one", "same\nother one"]


@pytest.mark.parametrize("doc_id", [None, 5, -5])
def test_rows_of_one_id_or_none_lose_repeated_lines(spark, doc_id):
    got = found(spark, [(doc_id, "a\nb"), (doc_id, "c\na"), (doc_id, "x\nb"), (doc_id, "a\nb")], 1, 30)
    # which text comes first is settled by hash; equal rows are one
    equal = [t for _, t, _, _ in got]
    assert sum(n for _, _, n, _ in got) == 8
    lines_left = sorted(x for t in {*equal} for x in t.split("\n") if x)
    assert lines_left == ["a", "b", "c", "x"]


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
