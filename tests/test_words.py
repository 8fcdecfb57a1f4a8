"""Boxes, collapsing, duplicates, labels and pages on small hand-made tables."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemark import functions as fn
from pagemark.operators import audit, confusion, dedup, labels, overlap, pages
from pagemark.operators.agreement import kappa, label_pairs
from pagemark.vocabularies import BIO_VOCABULARY, INVOICE_VOCABULARY


def test_boxes(spark):
    texts = ["(10, 20, 100, 40)", "x( 1,2 ,3,4 )y", "(1.5, 2, 3, 4)", "(-1, 2, 3, 4)", "x", None, "()"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, bboxes string")
    got = [tuple(r)[2:] for r in pages.with_coordinates(df).orderBy("i").collect()]
    assert got == [(10, 20, 100, 40), (1, 2, 3, 4)] + [(None,) * 4] * 5
    assert pages.with_coordinates(df).columns == ["i", "bboxes", "x1", "y1", "x2", "y2"]


def test_small_functions(spark):
    df = spark.createDataFrame(
        [("/a/b.c/report.final.csv", "x" * 51, "x" * 50, 1, 3)], "p string, l string, s string, a int, b int"
    )
    row = df.select(
        fn.file_stem("p").alias("stem"),
        fn.shorten("l").alias("l"),
        fn.shorten("s").alias("s"),
        fn.percent("a", "b").alias("pc"),
        fn.percent("a", F.lit(0)).alias("none"),
        fn.from_template("{case_dir}/{case_id}/{case_id}.csv", case_dir=F.lit("/d{x}"), case_id="p").alias("t"),
        fn.confidence_band(F.lit(0.8)).alias("medium"),
        fn.confidence_band(F.lit(0.81)).alias("high"),
        fn.confidence_band(F.lit(0.49)).alias("low"),
    ).first()
    assert row.stem == "report.final"
    assert row.l == "x" * 47 + "..." and row.s == "x" * 50
    assert row.pc == 33.3 and row.none is None
    assert row.t == "/d{x}//a/b.c/report.final.csv//a/b.c/report.final.csv.csv"
    assert (row.high, row.medium, row.low) == ("high", "medium", "low")
    with pytest.raises(KeyError):
        fn.from_template("{other}/x", case_id="p")


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("nan",), ("a",)], "c string")
    got = [tuple(r) for r in df.select(fn.is_blank("c"), fn.is_blank("c", False)).collect()]
    assert got == [(True, True), (True, True), (True, False), (False, False)]


def test_decode(spark):
    texts = ["0", "1", "7", "-1", None, "FOO", "1.0", "99999999999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, pred string")
    vocab = ["B-ADDRESS", "I-ADDRESS"]
    table = spark.createDataFrame(list(enumerate(vocab)), "idx int, label string")
    for missing in ("UNK", "O"):
        want = ["B-ADDRESS", "I-ADDRESS", "UNK_7", "UNK_-1", missing, "FOO", "1.0", "UNK_99999999999"]
        assert [r.pred for r in labels.decode_column(df, vocab, missing).orderBy("i").collect()] == want
        assert [r.pred for r in labels.decode_by_table(df, table, missing).orderBy("i").collect()] == want
    numbers = spark.createDataFrame([(0, 1.0), (1, 0.9), (2, None), (3, float("nan")), (4, 5.0)], "i int, pred double")
    got = [r.pred for r in labels.decode_column(numbers, vocab, "O").orderBy("i").collect()]
    assert got == ["I-ADDRESS", "B-ADDRESS", "O", "O", "UNK_5"]


def test_strip(spark):
    df = spark.createDataFrame([("B-X",), (" I-X ",), ("X",), (None,), ("nan",), ("",), ("BI-X",)], "c string")
    assert [r[0] for r in df.select(fn.strip_bio("c")).collect()] == ["X", "X", "X", "O", "O", "", "BI-X"]


def test_vocabularies(spark):
    assert len(INVOICE_VOCABULARY) == 58 and len(BIO_VOCABULARY) == 61
    assert INVOICE_VOCABULARY.index("supplierABN_a_pgs") + 1 == INVOICE_VOCABULARY.index("supplier_a_pgs")
    assert BIO_VOCABULARY[9:11] == ["B-MONEY", "I-MONEY"]
    df = spark.createDataFrame([(x,) for x in INVOICE_VOCABULARY * 2 + [None, ""]], "label string")
    got = [r.label for r in labels.vocabulary(df).orderBy("idx").collect()]
    assert got == INVOICE_VOCABULARY


def fold(rows):
    """Best row per key of (key, prob, pred, label, pos) rows, read in order."""
    best = {}
    for key, prob, pred, label, pos in sorted(rows, key=lambda r: r[4]):
        try:
            p = float(prob)
        except (TypeError, ValueError):
            p = 0.0
        rank = (-p, pred != label, pred, pos)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, pos)
    return {k: v[1] for k, v in best.items()}


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from("kmn"), st.sampled_from(["0.9", "0.5", "x", None]), st.sampled_from("ABC"),
            st.sampled_from("AB"),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_collapse(spark, rows):
    # one label per key, as a word has one
    rows = [(k, prob, pred, "A" if k == "k" else "Z", i) for i, (k, prob, pred, _) in enumerate(rows)]
    df = spark.createDataFrame(rows, "word_ids string, prob string, pred string, labels string, pos bigint")
    got = {r.word_ids: r.pos for r in dedup.collapse_top_k(df.repartition(3), ["pos"]).collect()}
    assert got == fold(rows)


def test_collapse_by_word(spark):
    rows = [("p", "w", 0.5, 0), ("p", "w", 0.9, 1), ("p", "w", 0.9, 2), ("p", None, 0.9, 3), ("p", "v", None, 4)]
    df = spark.createDataFrame(rows, "page_id string, words string, prob double, pos bigint")
    assert sorted(r.pos for r in dedup.collapse_top_k_by_word(df, ["pos"]).collect()) == [1, 4]
    assert dedup.count_null_keys(df).first()[0] == 1
    assert dedup.collapse_top_k_by_word(df.drop("prob"), ["pos"]).count() == 5


def test_drop_duplicates(spark):
    rows = [("a", None, "X", 0), ("a", None, "Y", 1), ("a", 1, "X", 2), (None, None, "X", 3), (None, None, None, 4)]
    df = spark.createDataFrame(rows, "words string, n int, annotator1_label string, pos bigint")
    assert sorted(r.pos for r in dedup.drop_duplicates_first(df, ["pos"]).collect()) == [0, 2, 3]
    assert dedup.drop_duplicates_first(df, ["pos"], []).count() == 5


def test_standardise(spark):
    df = spark.createDataFrame(
        [(0, "", "nan"), (1, None, "X"), (2, "A", "X"), (3, "nan", "Y")],
        "i int, annotator1_label string, annotator2_label string",
    )
    got = [(r.annotator1_label, r.label_filled) for r in labels.standardise_annotator(df, "annotator1").orderBy("i").collect()]
    assert got == [("", False), ("X", True), ("A", False), ("Y", True)]
    copied = labels.standardise_annotator(df.drop("annotator1_label"), "annotator1")
    assert copied.filter("annotator1_label <=> annotator2_label and label_filled").count() == 4
    none = labels.standardise_annotator(df.select("i"), "annotator1")
    assert none.filter("annotator1_label = ''").count() == 4
    with pytest.raises(ValueError):
        labels.standardise_annotator(df, "annotator3")


def test_fill(spark):
    df = spark.createDataFrame(
        [("p", "w0", "1", 0.9, 0, "", "Z"), ("p", "w0", "3", 0.4, 1, "", "Z"), ("p", "w1", None, 0.9, 2, "nan", None)],
        "page_id string, word_ids string, pred string, prob double, pos bigint, annotator1_label string, annotator2_label string",
    )
    after = audit.fill_job(df, BIO_VOCABULARY, ["pos"])
    got = {r.word_ids: (r.annotator1_label, r.annotator2_label) for r in after.collect()}
    assert got == {"w0": ("B-PER", "Z"), "w1": ("O", "O")}
    stats = {r.level: r for r in audit.fill_statistics(df, after, "page_id").collect()}
    total = stats["overall"]
    assert (total.original_rows, total.final_rows, total.duplicates_removed) == (3, 2, 1)
    assert (total.predictions_decoded, total.annotator1_filled, total.annotator2_filled) == (2, 2, 1)
    bare = labels.fill_predictions(df.select("page_id"), BIO_VOCABULARY)
    assert bare.filter("annotator1_label = 'O' and annotator2_label = 'O'").count() == 3


def test_violations(spark):
    df = spark.createDataFrame([("A", "B"), ("Q", ""), ("Q", "B")], "annotator1_label string, annotator2_label string")
    got = {(r.annotator, r.label, r.n) for r in labels.vocabulary_violations(df, ["A"]).collect()}
    assert got == {("annotator1", "Q", 2), ("annotator2", "B", 2)}
    vocab = spark.createDataFrame([(0, "A")], "idx int, label string")
    got = {(r.annotator, r.label, r.n) for r in labels.vocabulary_violations_by_table(df, vocab).collect()}
    assert got == {("annotator1", "Q", 2), ("annotator2", "B", 2)}


def test_evaluation_modes(spark):
    """The same words are fully right as flat labels and half right as tags."""
    df = spark.createDataFrame(
        [("d", 0, "B-MONEY", "MONEY"), ("d", 1, "B-MONEY", "MONEY"), ("d", 2, "O", None)],
        "file string, pos bigint, pred string, annotator1_label string",
    )
    judged = labels.with_evaluation_labels(df)
    flat = confusion.accuracy(confusion.confusion(judged, "ground_truth_flat", "pred_flat")).first()
    bio = confusion.accuracy(confusion.confusion(judged, "ground_truth_bio", "pred_bio")).first()
    # a missing truth is left out in flat mode and an O in BIO mode
    assert (flat.token_accuracy, flat.total_tokens) == (1.0, 2)
    assert (bio.correct_predictions, bio.total_tokens) == (2, 3)
    counted = confusion.flat_confusion(confusion.label_combinations(df, columns=["annotator1_label", "pred"]), "annotator1", None)
    assert {tuple(r) for r in counted.collect()} == {("MONEY", "MONEY", 2)}
    rate = confusion.error_rate(judged, "ground_truth_flat", "pred_flat").first()
    assert (rate.total_errors, rate.error_rate) == (0, 0.0)


def test_empty_report(spark):
    df = spark.createDataFrame([], "truth string, pred string")
    row = confusion.report_averages(confusion.class_report(confusion.confusion(df, "truth", "pred"))).first()
    assert (row.accuracy, row.macro_f1, row.total, row.classes) == (0.0, 0.0, 0, 0)
    assert confusion.error_rate(df, "truth", "pred").first().error_rate == 0.0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("abcd")), min_size=1, max_size=40))
def test_kappa_symmetric(spark, rows):
    df = spark.createDataFrame(rows, "one string, two string")
    a = kappa(label_pairs(df, "one", "two")).first()
    b = kappa(label_pairs(df, "two", "one")).first()
    same = a.kappa_score == pytest.approx(b.kappa_score, abs=1e-12) or a.kappa_score != a.kappa_score
    assert same and a.agreement_count == b.agreement_count


def plain_boxes(rng, wide):
    boxes = [(rng.randrange(wide), rng.randrange(wide), rng.randint(0, 300), rng.randint(0, 40)) for _ in range(60)]
    return [(x, y, x + w, y + h) for x, y, w, h in boxes] + [(5, 5, 9, 9)] * 3


def boxes_of_all_sizes(rng):
    """Corners and sides up to 2^31, below zero, at and beside the borders of cells."""
    out = []
    for _ in range(70):
        x, y = (rng.choice([-1, 1]) * rng.choice([rng.randrange(1 << rng.randrange(1, 30)), 1 << rng.randrange(7, 30)]) for _ in "xy")
        w, h = (min(rng.choice([1 << rng.randrange(30), rng.randrange(1, 1 << rng.randrange(1, 30))]), (1 << 31) - 1 - max(c, 0)) for c in (x, y))
        out.append((x, y, x + w, y + h))
    return out + [(-(1 << 30), -(1 << 30), 1 << 30, (1 << 30) - 1)]


@pytest.mark.parametrize("wide", [60, 3000, None])
def test_overlaps(spark, wide):
    rng = random.Random(wide or 7)
    boxes = plain_boxes(rng, wide) if wide else boxes_of_all_sizes(rng)
    rows = [(f"p{i % 2}", *b) for i, b in enumerate(boxes)]
    df = spark.createDataFrame(rows, "page_id string, x1 int, y1 int, x2 int, y2 int")
    got = overlap.box_overlaps(df, ["page_id"]).collect()
    want = {}
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if a[0] == b[0] and all(r[1] < r[3] and r[2] < r[4] for r in (a, b)):
                w, h = min(a[3], b[3]) - max(a[1], b[1]), min(a[4], b[4]) - max(a[2], b[2])
                if w > 0 and h > 0:
                    key = (a[0], frozenset([a[1:], b[1:]]))
                    want[key] = (want.get(key, (0, 0))[0] + 1, w * h)
    found = {}
    for r in got:
        pair = frozenset([(r.a_x1, r.a_y1, r.a_x2, r.a_y2), (r.b_x1, r.b_y1, r.b_x2, r.b_y2)])
        assert (r.page_id, pair) not in found
        found[r.page_id, pair] = (r.word_pairs, r.overlap_area)
    assert found == want


def test_a_wide_box_is_filed_in_few_cells(spark):
    """Boxes of any width are filed four times per class at most, and are met only by boxes near them."""
    rows = [("p", 0, 20 * i, 400_000, 20 * i + 10) for i in range(3000)]
    rows += [("p", 100 * (i % 4000), 20 * (i // 20) + 12, 100 * (i % 4000) + 90, 20 * (i // 20) + 18) for i in range(60_000)]
    rows += [("p", 399_990, 0, 400_010, 60_000), (None, 0, 0, 1 << 30, 5), (None, 7, 2, 9, 1 << 30)]
    df = spark.createDataFrame(rows, "page_id string, x1 int, y1 int, x2 int, y2 int")
    boxes = df.groupBy("page_id", "x1", "y1", "x2", "y2").agg(F.count("*").alias("n"))
    cells = overlap.box_cells(boxes, ["page_id"])
    assert cells.count() <= 4 * 4 * len(rows)
    filed = cells.groupBy("page_id", "x1", "y1", "x2", "y2", "cx._one", "cx._two").count()
    assert filed.selectExpr("max(count)").first()[0] <= 4
    start = time.perf_counter()
    got = overlap.box_overlaps(df, ["page_id"])
    assert got.filter("page_id = 'p'").count() == 3000
    assert time.perf_counter() - start < 30


def test_reconciliation(spark):
    def table(rows, cols):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))

    listed = table([("a", "1"), ("a", "2"), ("a", "3"), ("b", "1"), ("c", "1"), ("d", "1")], ["case_id", "page_id"])
    out = pages.page_reconciliation(
        listed,
        cases=table([("a",), ("b",), ("d",)], ["case_id"]),
        token_cases=table([("a",), ("d",), ("d",)], ["case_id"]),
        images=table([("a", "1"), ("a", "3"), ("d", "1")], ["case_id", "page_id"]),
        token_pages=table([("a", "1"), ("a", "1")], ["case_id", "page_id"]),
        unreadable=table([("d",)], ["case_id"]),
    )
    got = {(r.case_id, r.page_id): r.status for r in out.collect()}
    assert got == {
        ("a", "1"): "ok", ("a", "2"): "image_missing", ("a", "3"): "no_rows",
        ("b", "1"): "tokens_missing", ("c", "1"): "case_missing", ("d", "1"): "unreadable",
    }
    sides = pages.id_reconciliation(table([("1",), ("1",), ("2",)], ["id"]), table([("2",), ("3",)], ["id"]), "id")
    assert {tuple(r) for r in sides.collect()} == {("1", "missing"), ("2", "match"), ("3", "extra")}
    assert [r.id for r in pages.id_samples(sides, "id", "missing").collect()] == ["1"]


def test_audit(spark):
    df = spark.createDataFrame(
        [("f", "A", None), ("f", "", "nan"), ("f_backup", "A", "B")],
        "file string, annotator1_label string, annotator2_label string",
    )
    got = {r.file: (r.total_rows, r.annotator1_completed, r.annotator2_completed) for r in audit.completion_audit(df).collect()}
    assert got == {"f": (2, 1, 1), "f_backup": (1, 1, 1), "all": (3, 2, 2)}
    got = {r.file for r in audit.completion_audit(df, skip_backups=True).collect()}
    assert got == {"f", "all"}
    rows = spark.createDataFrame([("f", "x", None), ("f", "x", None), ("f", "x", None), ("g", "x", None)], "file string, a string, b string")
    got = {r.file: r.duplicates for r in audit.duplicate_rows(rows, "file").collect()}
    assert got == {"f": 2, "g": 0, "all": 2}


def test_row_functions_on_a_stream(spark, tmp_path):
    """Row-wise expressions hold no state, so they run on streaming input unchanged."""
    src = str(tmp_path / "in")
    df = spark.createDataFrame([("1", "(1, 2, 3, 4)", 0.9), ("9", "x", 0.1)], "pred string, bboxes string, prob double")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out = labels.decode_column(pages.with_coordinates(stream), ["O", "B-ORG"], "UNK").withColumn(
        "flat", fn.strip_bio("pred")
    ).withColumn("band", fn.confidence_band("prob"))
    query = (
        out.writeStream.format("memory").queryName("rows")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {(r.pred, r.x1, r.flat, r.band) for r in spark.table("rows").collect()}
    assert got == {("B-ORG", 1, "ORG", "high"), ("UNK_9", None, "UNK_9", "low")}


def test_numbers(spark):
    texts = ["1", " +2 ", "-3", "1.5", "1e2", ".5", "5.", "inf", "NaN", "x", "", None, "1_0", "0x1", "--1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    whole = [r[0] for r in df.select(fn.whole_number("t")).collect()]
    assert whole == [1, 2, -3] + [None] * 12
    real = [r[0] for r in df.select(fn.real_number("t")).collect()]
    assert real[:8] == [1.0, 2.0, -3.0, 1.5, 100.0, 0.5, 5.0, float("inf")]
    assert real[8] != real[8] and real[9:] == [None] * 6
    ranks = [r[0] for r in df.select(fn.ranking_probability("t")).collect()]
    assert ranks[8:] == [0.0] * 7 and ranks[7] == float("inf")
