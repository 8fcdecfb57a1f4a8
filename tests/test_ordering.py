"""Order-dependent steps against brute force, with blocks and groups far smaller than usual."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagemark.operators.labels import flat_to_bio
from pagemark.operators.ordering import counted_before, indexed, ranked, with_previous, with_row_number
from pagemark.operators.sequences import entity_spans, label_transitions, numbered_spans, span_counts, span_scores

TAGS = ["O", "B-A", "I-A", "B-B", "I-B", "X", "I-C"]


def documents(seed, docs=12, most=60):
    rng = random.Random(seed)
    rows = []
    for d in range(docs):
        positions = sorted(rng.sample(range(200), rng.randint(1, most)))
        rows += [(f"d{d}", p, rng.choice(TAGS), rng.choice(TAGS)) for p in positions]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc string, pos bigint, truth string, pred string").repartition(5)


def by_document(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


def spans(sequence):
    """(type, start, end, size) of (pos, tag) pairs in order."""
    found, open_ = [], None
    for pos, tag in sequence:
        kind = None if tag == "O" else tag[2:] if tag[:2] in ("B-", "I-") else f"bare:{tag}"
        if kind is None:
            open_ = None
        elif open_ is None or tag.startswith("B-") or open_[0] != kind:
            open_ = [kind, pos, pos, 1]
            found.append(open_)
        else:
            open_[2] = pos
            open_[3] += 1
    return {tuple(s) for s in found}


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_previous(spark, bits):
    rows = documents(bits)
    got = with_previous(frame(spark, rows), ["doc"], "pos", {"before": "truth", "p": "pred"}, bits).collect()
    want = {}
    for doc, seq in by_document(rows).items():
        for i, r in enumerate(seq):
            want[doc, r[1]] = (seq[i - 1][2], seq[i - 1][3]) if i else (None, None)
    assert {(r.doc, r.pos): (r.before, r.p) for r in got} == want


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_spans(spark, bits):
    rows = documents(10 + bits)
    got = entity_spans(frame(spark, rows), ["doc"], "pos", "pred", bits).collect()
    want = {(d, *s) for d, seq in by_document(rows).items() for s in spans([(r[1], r[3]) for r in seq])}
    assert {(r.doc, r.entity_type, r.start, r.end, r.tokens) for r in got} == want
    got = numbered_spans(frame(spark, rows), ["doc"], "pos", "pred", bits).collect()
    want = {(d, *s) for d, seq in by_document(rows).items() for s in spans([(i, r[3]) for i, r in enumerate(seq)])}
    assert {(r.doc, r.entity_type, r.start, r.end, r.tokens) for r in got} == want


@pytest.mark.parametrize("bits", [2, 16])
def test_span_counts(spark, bits):
    rows = [(d, p, None if p % 11 == 0 else t, q) for d, p, t, q in documents(20 + bits)]
    got = {r.entity_type: (r.tp, r.n_true, r.n_pred) for r in
           span_counts(frame(spark, rows), ["doc"], "pos", "truth", "pred", bits).collect()}
    want = {}
    for seq in by_document([r for r in rows if r[2] is not None]).values():
        t, p = spans([(r[1], r[2]) for r in seq]), spans([(r[1], r[3]) for r in seq])
        for kind in {s[0] for s in t | p}:
            old = want.get(kind, (0, 0, 0))
            new = (sum(s[0] == kind for s in t & p), sum(s[0] == kind for s in t), sum(s[0] == kind for s in p))
            want[kind] = tuple(a + b for a, b in zip(old, new))
    assert got == want


@pytest.mark.parametrize("bits", [2, 16])
def test_sparse_positions(spark, bits):
    """Positions spread over a wide range give a block per row; results and group sizes hold."""
    wide = 1 << 20
    rows = [(d, p * wide, t, q) for d, p, t, q in documents(60 + bits, 4, 150)]
    rows += [("big", i * wide, "B-A" if i % 400 == 0 else "I-A", "I-A") for i in range(1200)]
    df = frame(spark, rows)
    got = entity_spans(df, ["doc"], "pos", "truth", bits).collect()
    want = {(d, *s) for d, seq in by_document(rows).items() for s in spans([(r[1], r[2]) for r in seq])}
    assert {(r.doc, r.entity_type, r.start, r.end, r.tokens) for r in got} == want
    got = with_previous(df, ["doc"], "pos", {"before": "truth"}, bits).collect()
    before = {(d, r[1]): seq[i - 1][2] if i else None
              for d, seq in by_document(rows).items() for i, r in enumerate(seq)}
    assert {(r.doc, r.pos): r.before for r in got} == before
    got = with_row_number(df, ["doc"], "pos", "n", bits).collect()
    want = {(d, r[1]): i for d, seq in by_document(rows).items() for i, r in enumerate(seq, 1)}
    assert {(r.doc, r.pos): r.n for r in got} == want


def test_no_window_over_all_blocks_of_a_document(spark):
    df = frame(spark, [("d", i << 24, "I-A", "O") for i in range(50)])
    for out in (
        with_previous(df, ["doc"], "pos", {"b": "truth"}),
        with_row_number(df, ["doc"], "pos", "n"),
        entity_spans(df, ["doc"], "pos", "truth"),
    ):
        plan = out._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if " Window [" in line or "- Window [" in line]
        by_block = [w for w in windows if "_block#" in w.partition("windowspecdefinition(")[2].partition(" ASC")[0]]
        assert windows and all("_upper#" in w for w in by_block if "_block#" in w and "pos#" not in w)


def test_spans_of_bio_tags_need_one_exchange_of_rows(spark):
    df = frame(spark, documents(3)).withColumn("pred", F.col("truth"))
    tagged = flat_to_bio(df, ["doc"], "pos", "truth", "bio", 3, keep_block=True)
    out = entity_spans(tagged, ["doc"], "pos", "bio", 3)
    got = {(r.doc, r.entity_type, r.start, r.end, r.tokens) for r in out.collect()}
    again = entity_spans(tagged.drop("_block"), ["doc"], "pos", "bio", 3).collect()
    assert got == {(r.doc, r.entity_type, r.start, r.end, r.tokens) for r in again}
    plan = out._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    by_block = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(doc#\d+, _block#\d+L?, ", x)]
    assert len([x for x in by_block if "ENSURE_REQUIREMENTS" in x and "Reused" not in x]) <= 5


def test_known_spans(spark):
    tags = ["O", "I-A", "I-A", "B-A", "I-B", "O"]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(tags)], "doc string, pos bigint, tag string")
    got = {(r.entity_type, r.start, r.end) for r in entity_spans(df, ["doc"], "pos", "tag", 1).collect()}
    assert got == {("A", 1, 2), ("A", 3, 3), ("B", 4, 4)}


def test_span_over_many_blocks(spark):
    """One span holding a whole document, next to tiny ones."""
    rows = [("big", i, "B-A" if i == 0 else "I-A") for i in range(100)] + [("small", 3, "I-A")]
    df = spark.createDataFrame(rows, "doc string, pos bigint, tag string")
    got = {(r.doc, r.start, r.end, r.tokens) for r in entity_spans(df, ["doc"], "pos", "tag", 2).collect()}
    assert got == {("big", 0, 99, 100), ("small", 3, 3, 1)}


def test_no_spans(spark):
    df = spark.createDataFrame([("d", 0, "O", "O")], "doc string, pos bigint, truth string, pred string")
    counts = span_counts(df, ["doc"], "pos", "truth", "pred")
    assert counts.count() == 0
    rows = {r.scope: r for r in span_scores(counts).collect()}
    assert rows["micro"].f1 == 0.0 and rows["weighted"].support == 0


@pytest.mark.parametrize("bits", [2, 16])
def test_row_number(spark, bits):
    rows = documents(30 + bits)
    got = with_row_number(frame(spark, rows), ["doc"], "pos", "n", bits).collect()
    want = {(d, r[1]): i for d, seq in by_document(rows).items() for i, r in enumerate(seq, 1)}
    assert {(r.doc, r.pos): r.n for r in got} == want


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_ranked(spark, bits):
    rng = random.Random(bits)
    rows = [
        (rng.choice(["a", "b", "b", "b", None]), rng.choice([None, 1, 2, 2, 9]), rng.choice([None, 3, 4]), i)
        for i in range(80)
    ]
    df = spark.createDataFrame(rows, "page string, y int, x int, pos bigint").repartition(4)
    got = {r.pos: r.n for r in ranked(df, ["page"], ["y", "x"], "pos", "n", bits).collect()}
    groups, want = {}, {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for g in groups.values():
        far = float("inf")
        g.sort(key=lambda r: (far if r[1] is None else r[1], far if r[2] is None else r[2], r[3]))
        want.update({r[3]: i for i, r in enumerate(g, 1)})
    assert got == want


def test_no_task_sees_a_large_page(spark):
    """A third of all rows on one page, half of them without a box: the windows stay small."""
    rows = [("big", i % 97 if i % 2 else None, i % 7 if i % 2 else None, i) for i in range(4000)]
    rows += [(f"p{i % 400}", i % 9, i % 5, i) for i in range(4000, 12_000)]
    df = spark.createDataFrame(rows, "page string, y int, x int, pos bigint").repartition(8)
    out = ranked(df, ["page"], ["y", "x"], "pos", "n", bits=6)
    got = sorted((r.n, r.pos) for r in out.filter("page = 'big'").collect())
    far = float("inf")
    big = sorted(rows[:4000], key=lambda r: (far if r[1] is None else r[1], far if r[2] is None else r[2], r[3]))
    assert got == [(i, r[3]) for i, r in enumerate(big, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_group" in plan and "Union" not in plan
    strips = df.selectExpr("page", "coalesce(y, -1) y", "if(y is null, shiftright(pos, 6), 0) b")
    assert strips.groupBy("page", "y", "b").count().selectExpr("max(count)").first()[0] <= 64


def partition_sizes(out):
    return [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("same_column", [True, False])
def test_no_task_sees_one_pixel_row_of_a_large_page(spark, same_column):
    """A third of all rows on one pixel row of a page, and half of these, or all, in one place."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    rows = [("big", 7, 3 if same_column or i % 2 else i, i) for i in range(4000)]
    rows += [(f"p{i % 40}", i % 90, i % 50, i) for i in range(4000, 12_000)]
    df = spark.createDataFrame(rows, "page string, y int, x int, pos bigint").repartition(8)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = ranked(df, ["page"], ["y", "x"], "pos", "n", bits=4)
        sizes = partition_sizes(out)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert max(sizes) <= 4 * sum(sizes) / 16
    got = sorted((r.n, r.pos) for r in out.filter("page = 'big'").collect())
    assert got == [(i, r[3]) for i, r in enumerate(sorted(rows[:4000], key=lambda r: r[2:]), 1)]


@pytest.mark.parametrize("values", [1, 500])
def test_no_window_sees_many_cells(spark, values):
    """Cells of one group, all different in the first column or in the second: each window sees a band of them."""
    rows = [("big", i % values, i // values, 1) for i in range(2000)]
    cells = spark.createDataFrame(rows, "g string, a bigint, b bigint, n bigint")
    cells = cells.selectExpr("*", "shiftright(a, 4) a_band", "shiftright(b, 4) b_band", "0 as block")
    path = [["g"], ["a_band"], ["a", "b_band"], ["b", "block"]]
    got = {(r.a, r.b): r.before for r in counted_before(cells, path, "n", "before").collect()}
    assert got == {k: i for i, k in enumerate(sorted((r[1], r[2]) for r in rows))}
    for i in range(1, len(path)):
        outer, level = [c for x in path[:i] for c in x], path[i]
        seen = cells.select(*outer, *level).distinct().groupBy(*outer).count().selectExpr("max(count)").first()[0]
        assert seen <= 16 * 125 / 16 + 16, (outer, level, seen)


def test_indexed(spark):
    names = [f"page{i:03}.csv" for i in range(137)]
    df = spark.createDataFrame([(n,) for n in names], "file string").repartition(6)
    got = {r.file: r.i for r in indexed(df, "file", "i").collect()}
    assert got == {n: i for i, n in enumerate(names)}


@pytest.mark.parametrize("bits", [1, 16])
def test_bio(spark, bits):
    labels = ["ORG", None, "ORG", "ORG", " ORG ", "O", "MONEY", "nan", "MONEY", "MONEY"]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(labels)], "doc string, pos bigint, l string")
    got = [r.bio for r in flat_to_bio(df, ["doc"], "pos", "l", "bio", bits).orderBy("pos").collect()]
    assert got == ["B-ORG", "O", "B-ORG", "I-ORG", "I-ORG", "O", "B-MONEY", "O", "B-MONEY", "I-MONEY"]


def test_bio_round_trip(spark):
    from pagemark.functions import strip_bio

    rng = random.Random(5)
    df = spark.createDataFrame(
        [("d", i, rng.choice(["O", "A", "C"])) for i in range(60)],
        "doc string, pos bigint, l string",
    )
    out = flat_to_bio(df, ["doc"], "pos", "l", "bio", 3).withColumn("back", strip_bio("bio"))
    assert out.filter(F.col("back") != F.col("l")).count() == 0


def test_transitions(spark):
    rows = [("d", 0, "A", "A"), ("d", 1, "A", "A"), ("d", 2, "B", "A"), ("d", 3, "B", "B"), ("d", 5, "B", "B")]
    row = label_transitions(frame(spark, rows), ["doc"], "pos", "truth", "pred", 1).first()
    assert (row.transitions, row.equal) == (4, 2)


@pytest.mark.parametrize("bits", [2, 4, 16])
def test_small_and_large_groups_beside_each_other(spark, bits):
    """Groups of up to 2^bits rows are sorted whole, larger ones in cells; rows are prepared in both."""
    rng = random.Random(70 + bits)
    rows = [(g, rng.choice([None, 1, 2, 300, 301]), rng.choice([None, 3, 4, 900]), i)
            for i, g in enumerate(g for g, n in [("a", 3), ("b", 4), ("c", 16), ("d", 17), (None, 90)] for _ in range(n))]
    df = spark.createDataFrame(rows, "page string, y int, x int, pos bigint").repartition(4)
    out = ranked(df, ["page"], ["y", "x"], "pos", "n", bits, prepare=lambda r: r.filter("pos % 3 != 0"))
    assert out.columns == ["page", "y", "x", "pos", "n"]
    got = {(r.page, r.pos): r.n for r in out.collect()}
    far, want = float("inf"), {}
    for g in {r[0] for r in rows}:
        kept = [r for r in rows if r[0] == g and r[3] % 3]
        kept.sort(key=lambda r: (far if r[1] is None else r[1], far if r[2] is None else r[2], r[3]))
        want |= {(g, r[3]): i for i, r in enumerate(kept, 1)}
    assert got == want


@pytest.mark.parametrize("bits", [2, 5, 16])
def test_previous_of_prepared_rows(spark, bits):
    rows = documents(80 + bits)
    out = with_previous(frame(spark, rows), ["doc"], "pos", {"before": "truth"}, bits,
                        prepare=lambda r: r.filter("pos % 3 != 0"))
    want = {(d, r[1]): seq[i - 1][2] if i else None
            for d, seq in by_document([r for r in rows if r[1] % 3]).items() for i, r in enumerate(seq)}
    assert {(r.doc, r.pos): r.before for r in out.collect()} == want


@pytest.mark.parametrize("bits", [2, 5, 16])
def test_span_counts_of_prepared_rows(spark, bits):
    """Rows prepared with their blocks give what the same rows give when they come as they are."""
    df = frame(spark, documents(90 + bits)).withColumn("label", F.regexp_replace("truth", "^[BI]-", ""))

    def tagged(rows):
        return flat_to_bio(rows.filter("pos % 3 != 0"), ["doc"], "pos", "label", "bio", bits, keep_block=True)

    def found(out):
        return {tuple(r) for r in out.collect()}

    plain = flat_to_bio(df.filter("pos % 3 != 0"), ["doc"], "pos", "label", "bio", bits)
    want = found(span_counts(plain, ["doc"], "pos", "bio", "pred", bits))
    assert want and found(span_counts(df, ["doc"], "pos", "bio", "pred", bits, prepare=tagged)) == want
    want = found(entity_spans(plain, ["doc"], "pos", "bio", bits))
    assert want and found(entity_spans(df, ["doc"], "pos", "bio", bits, prepare=tagged)) == want
