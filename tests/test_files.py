"""Scans and sinks over real files."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from fixtures import TRACK6, UPDATES3
from pagemark import sinks, sources
from pagemark.operators.confusion import page_metrics
from pagemark.plans import cleanup, evaluate_annotations, evaluate_predictions, fill, prepare, track
from pagemark.schemas import ASSIGNMENT_COLUMNS, TOKEN_FILE_COLUMNS
from pagemark.vocabularies import BIO_VOCABULARY

CASES = {
    "1-12ABCDEF": [
        ("9876543210_01_0", "1", "10", "form", "(10, 20, 100, 40)", "FIELD", "0", "0.95"),
        ("9876543210_01_0", "2", "11", 'say "hi", you', "(150, 25, 250, 45)", "VALUE", "1", "0.87"),
        ("9876543210_01_0", "2", "11", 'say "hi", you', "(150, 25, 250, 45)", "VALUE", "3", "0.10"),
        ("9876543210_01_0", "3", "12", "NA", "(5, 5, 9, 9)", "OTHER", "0", "x"),
        ("9876543210_02_0", "4", "13", "date", "none", "DATE", "1", "0.92"),
    ],
    "1-15XYZWQP": [("1122334455_01_1", "10", "20", "null", "(15, 25, 120, 45)", "FIELD", "0", "0.91")],
}


def write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture()
def cases(tmp_path):
    root = tmp_path / "cases"
    for case, rows in CASES.items():
        write(root / case / "processing" / "form-recogniser" / "df_check.csv", TOKEN_FILE_COLUMNS, rows)
        (root / case / "images").mkdir()
        (root / case / "extracted_text_json").mkdir()
    (root / "1-12ABCDEF" / "images" / "9876543210_01_0.jpeg").write_bytes(b"abc")
    (root / "1-12ABCDEF" / "extracted_text_json" / "9876543210_01_0.json").write_text(
        json.dumps({"extracted_lines": [{"text": "a\nb"}]})
    )
    return root


def test_tokens(spark, cases):
    df = sources.scan_tokens(spark, str(cases))
    assert df.count() == 6
    assert df.columns[:2] == ["case_id", "page_id"] and {"pos", "prob_text"} <= set(df.columns)
    first = df.filter("case_id = '1-12ABCDEF'").orderBy("pos")
    assert [r.words for r in first.collect()] == ["form", 'say "hi", you', 'say "hi", you', "NA", "date"]
    assert [r.prob for r in first.collect()][3] is None
    assert df.filter("words = 'null'").count() == 1


def test_layouts(spark, tmp_path):
    write(tmp_path / "a" / "processing" / "x" / "f.csv", ["page_id", "words", "prob"], [("p", "w", "0.5")])
    write(tmp_path / "b" / "processing" / "x" / "g.csv", ["image_id", "words"], [("q", "v")])
    df = sources.scan_tokens(
        spark,
        layouts={
            f"{tmp_path}/*/processing/x/f.csv": ["page_id", "words", "prob"],
            f"{tmp_path}/*/processing/x/g.csv": ["image_id", "words"],
        },
    )
    got = {(r.case_id, r.page_id, r.words, r.prob) for r in df.collect()}
    assert got == {("a", "p", "w", 0.5), ("b", "q", "v", None)}
    wrong = sources.scan_tokens(spark, layouts={f"{tmp_path}/*/processing/x/f.csv": ["words", "page_id", "prob"]})
    with pytest.raises(Exception, match="header"):
        wrong.collect()


def test_position_over_splits(spark, tmp_path):
    """A file read in many splits keeps its order."""
    path = tmp_path / "c" / "processing" / "form-recogniser" / "df_check.csv"
    rows = [("p", "1", str(i), "w" * 40, "(1, 2, 3, 4)", "O", "0", "0.5") for i in range(70_000)]
    write(path, TOKEN_FILE_COLUMNS, rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        df = sources.scan_tokens(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 2
        assert [int(r.word_ids) for r in df.orderBy("pos").collect()] == list(range(70_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_pages_and_updates(spark, tmp_path):
    write(tmp_path / "pages.csv", ["case_id", "image_id", "x"], [("c", 'p" 1', "1"), ("c", "p2", "1"), ("c", "p2", "1")])
    got = [tuple(r)[:2] for r in sources.scan_pages(spark, str(tmp_path / "pages.csv"), strip=True).orderBy("ord").collect()]
    assert got == [("c", "p1"), ("c", "p2"), ("c", "p2")]
    write(tmp_path / "bad.csv", ["a", "b"], [("1", "2")])
    with pytest.raises(ValueError):
        sources.scan_pages(spark, str(tmp_path / "bad.csv"))
    write(tmp_path / "updates.csv", ["case_id", "image_id", "status"], [("c", "p", "yes")])
    row = sources.scan_updates(spark, str(tmp_path / "updates.csv")).first()
    assert (row.page_id, row.annotator, row.status) == ("p", None, "yes")
    with pytest.raises(ValueError):
        sources.scan_updates(spark, str(tmp_path / "pages.csv"))


def test_assignments(spark, tmp_path):
    path = tmp_path / "master.csv"
    write(path, [*ASSIGNMENT_COLUMNS, "team"], [(*r, "red") for r in TRACK6])
    with path.open("a") as f:
        f.write('1-1,p,"=LINK("Z:x\\y","View")","=LINK("Z:x","View")",annotator1,no,annotator2,no,,red\n')
        f.write("1-1,q,a,b,annotator1,maybe,annotator2,no,,red\n")
    good, bad = sources.scan_assignments(spark, str(path))
    assert good.count() == 6 and good.columns == [*ASSIGNMENT_COLUMNS, "team"]
    assert good.first().notes == "" and bad.count() == 2
    write(tmp_path / "updates.csv", ["case_id", "image_id", "annotator", "status"], [u[:4] for u in UPDATES3])
    out = track(good, sources.scan_updates(spark, str(tmp_path / "updates.csv")))
    root = str(tmp_path / "assignments")
    sinks.write_version(good, root, 1)
    sinks.write_version(out["assignments"], root, 2)
    again = sinks.latest_version(spark, root)
    assert again.filter("has_assignee1_completed = 'yes'").count() == 2
    with pytest.raises(Exception):
        sinks.write_version(good, root, 2)
    sinks.write_annotator_views(out["assignments"], str(tmp_path / "views"))
    views = spark.read.parquet(str(tmp_path / "views"))
    assert views.filter("annotator = 'annotator2' and case_id = '1-15XYZWQP'").count() == 2
    sinks.write_lines(sinks.progress_markdown(out["progress"]), str(tmp_path / "progress"))
    text = [r.value for r in spark.read.text(str(tmp_path / "progress"), wholetext=True).collect()]
    assert sum("| 1-15XYZWQP | 2 |" in t for t in text) == 1


def test_prepare_to_evaluation(spark, cases, tmp_path):
    write(tmp_path / "pages.csv", ["case_id", "page_id"],
          [("1-12ABCDEF", "9876543210_01_0"), ("1-12ABCDEF", "9876543210_02_0"), ("1-12ABCDEF", "9876543210_09_0"),
           ("1-15XYZWQP", "1122334455_01_1"), ("1-19R5T7G3", "5566778899_01_0"), ("1-12ABCDEF", "9876543210_01_0")])
    tokens = sources.scan_tokens(spark, str(cases))
    listed = sources.scan_pages(spark, str(tmp_path / "pages.csv"))
    out = prepare(tokens, listed, "Z:", images=sources.scan_images(spark, str(cases)))
    reasons = {(r.page_id): r.status for r in out["reconciliation"].collect()}
    assert reasons == {
        "9876543210_01_0": "ok", "9876543210_02_0": "image_missing", "9876543210_09_0": "image_missing",
        "1122334455_01_1": "image_missing", "5566778899_01_0": "tokens_missing",
    }
    rows = out["annotations"].orderBy("reading_pos").collect()
    # collapsed to three words and read top to bottom
    assert [(r.words, r.reading_pos, r.x1, r.y1, r.pred) for r in rows] == [
        ("NA", 1, 5, 5, "0"), ("form", 2, 10, 20, "0"), ('say "hi", you', 3, 150, 25, "1")]
    names = out["annotations"].columns
    at = names.index("bboxes")
    assert names[at + 1 : at + 5] == ["x1", "y1", "x2", "y2"] and names[-2:] == ["annotator1_label", "annotator2_label"]
    assert out["assignments"].count() == 1 and out["index"].first().num_images == 1
    assert {r.file_name for r in out["images"].filter("reason is null").collect()} == {"1-12ABCDEF_9876543210_01_0.jpeg"}

    everything = prepare(tokens, listed, "Z:")
    stored = str(tmp_path / "annotations")
    sinks.write_annotations(everything["annotations"], stored)
    back = sources.scan_annotations(spark, stored)
    assert {r.file for r in back.select("file").distinct().collect()} == {
        "1-12ABCDEF_9876543210_01_0", "1-12ABCDEF_9876543210_02_0", "1-15XYZWQP_1122334455_01_1"}
    sinks.write_annotations(everything["annotations"], str(tmp_path / "by_case"), by=["case_id"])
    assert spark.read.parquet(str(tmp_path / "by_case")).count() == back.count() == 5
    filled = fill(back, BIO_VOCABULARY, ["reading_pos"])
    assert filled["annotations"].filter("annotator1_label = 'O' or annotator1_label = 'B-PER'").count() == 5
    cleaned = cleanup(filled["annotations"], "annotator1", ["reading_pos"])
    stats = {r.level: r for r in cleaned["statistics"].collect()}
    assert stats["overall"].final_rows == 5
    report = sinks.job_markdown(
        filled["statistics"], "Annotation Update Report", "file",
        {"original_rows": "Original Rows", "final_rows": "Final Rows", "annotator1_filled": "Ann1 Filled"})
    lines = [r.line for r in report.orderBy("section", "ord").collect()]
    assert "- **Total Original Rows**: 5" in lines and "- **Files Processed**: 3" in lines
    assert "| 1-15XYZWQP_1122334455_01_1 | 1 | 1 | 1 |" in lines
    scores = evaluate_annotations(filled["annotations"].withColumn("file", F.col("file")), BIO_VOCABULARY)
    assert scores["sequence_accuracy"].first().total_sequences == 3
    for name, frame in scores.items():
        frame.collect()
        assert frame.columns, name


def test_predictions(spark, tmp_path):
    header = ["bboxes", "pred", "prob", "labels"]
    write(tmp_path / "in" / "b.csv", header, [("(1, 2, 3, 4)", "1", "0.9", "1"), ("(1, 2, 3, 4)", "2", "0.9", "1")])
    write(tmp_path / "in" / "a.csv", header, [("(1, 2, 3, 4)", "1", "0.9", "1")])
    write(tmp_path / "in" / "empty.csv", header, [])
    df = sources.scan_predictions(spark, str(tmp_path / "in"))
    out = evaluate_predictions(df, page_index=True)
    pages = {r.file: (r.page_index, r.num_tokens, r.accuracy) for r in out["pages"].collect()}
    assert pages == {"a.csv": (0, 1, 1.0), "b.csv": (1, 2, 0.5)}
    row = out["summary"].first()
    assert (row.total_pages, row.pages_perfect_accuracy, row.page_accuracy_mean, row.page_accuracy_std) == (2, 1, 0.75, 0.25)
    assert row.avg_tokens_per_page == 1.5
    token = out["token_metrics"].first()
    assert token.accuracy == token.micro_f1 == pytest.approx(2 / 3)
    assert out["low_score_pages"].count() == 0
    for name in ("classes", "confusion", "pages"):
        sinks.write_csv(out[name], str(tmp_path / "out" / name))
    sinks.write_json(out["summary"], str(tmp_path / "out" / "summary"))
    assert spark.read.json(str(tmp_path / "out" / "summary")).first().total_tokens == 3
    write(tmp_path / "bad" / "a.csv", ["pred"], [("1",)])
    with pytest.raises(ValueError):
        sources.scan_predictions(spark, str(tmp_path / "bad"))
    assert page_metrics(out["confusion"].withColumn("p", F.lit(1)), "p").count() == 1


def test_json_and_images(spark, cases):
    row = sources.scan_json_pages(spark, str(cases)).first()
    assert (row.case_id, row.page_id) == ("1-12ABCDEF", "9876543210_01_0")
    assert json.loads(row.json)["extracted_lines"][0]["text"] == "a\nb"
    row = sources.scan_images(spark, str(cases)).first()
    assert (row.case_id, row.page_id, row.length) == ("1-12ABCDEF", "9876543210_01_0", 3)
