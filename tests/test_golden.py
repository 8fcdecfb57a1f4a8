"""Committed results of small fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from fixtures import ner17, track6, updates3
from pagemark.plans import evaluate_annotations, track
from pagemark.sinks import evaluation_markdown, productivity_markdown, progress_markdown


@pytest.fixture(scope="module")
def frames(spark):
    return evaluate_annotations(ner17(spark), None, pos="pos")


FLAT = {
    "all": (0.5882352941176471, 0.4373219373219373, 0.5693815987933636, 0.5138888888888888, 0.42592592592592593),
    "test_annotation": (0, 0, 0, 0, 0),
    "realistic_test": (0.3333333333333333, 0.27777777777777773, 0.38888888888888884, 0.3333333333333333, 0.25),
    "flat_vs_bio_test": (1, 1, 1, 1, 1),
}


@pytest.mark.parametrize("scope", FLAT)
def test_flat_averages(frames, scope):
    row = frames["averages_flat"].filter(F.col("file") == scope).first()
    got = (row.accuracy, row.macro_f1, row.weighted_f1, row.macro_precision, row.macro_recall)
    assert got == pytest.approx(FLAT[scope], abs=1e-12)


def test_bio_averages(frames):
    row = frames["averages_bio"].filter(F.col("level") == "overall").first()
    got = (row.accuracy, row.macro_f1, row.weighted_f1, row.macro_precision, row.macro_recall)
    want = (0.47058823529411764, 0.284375, 0.4029411764705882, 0.26666666666666666, 0.3125)
    assert got == pytest.approx(want, abs=1e-12)


def test_kappa(frames):
    got = {r.file: (r.kappa_score, r.agreement_count, r.total_dual_annotations) for r in frames["kappa"].collect()}
    want = {
        "all": (0.9294605809128631, 16, 17),
        "test_annotation": (1.0, 3, 3),
        "realistic_test": (0.7777777777777778, 5, 6),
        "flat_vs_bio_test": (1.0, 8, 8),
    }
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


def test_errors(frames):
    pairs = [(r.truth, r.pred, r.n) for r in frames["error_pairs"].collect()]
    assert pairs == [
        ("I-PER", "PER", 2),
        ("ADDRESS", "ORG", 1),
        ("B-PER", "PER", 1),
        ("FIELD", "ADDRESS", 1),
        ("FIELD", "ORG", 1),
        ("VALUE", "ORG", 1),
    ]
    rate = frames["error_rate"].first()
    assert (rate.total_errors, rate.error_rate) == (7, pytest.approx(0.4117647058823529, abs=1e-12))
    labels = [(r.truth, r.errors) for r in frames["confused_labels"].collect()]
    assert labels == [("FIELD", 2), ("I-PER", 2), ("ADDRESS", 1), ("B-PER", 1), ("VALUE", 1)]


def test_sequence_frames(frames):
    acc = frames["sequence_accuracy"].first()
    assert acc.total_sequences == 3
    assert acc.sequence_accuracy == pytest.approx(0.47058823529411764)
    rows = {(r.scope, r.entity_type): r for r in frames["sequence_scores"].collect()}
    # spans of the last document all match: ORG twice, MONEY once
    assert rows["type", "MONEY"].f1 == 1.0
    assert rows["type", "ORG"].recall == 1.0
    assert rows["type", "ORG"].precision == pytest.approx(2 / 3)


def test_tracking(spark):
    out = track(track6(spark), updates3(spark))
    got = {r.case_id: (r.total, r.completed1, r.completed2, r.completed_both) for r in out["progress"].collect()}
    assert got == {
        "1-12ABCDEF": (2, 1, 0, 0),
        "1-15XYZWQP": (2, 1, 1, 1),
        "1-19R5T7G3": (2, 0, 1, 0),
        "all": (6, 2, 2, 1),
    }
    overall = out["progress"].filter(F.col("level") == "overall").first()
    assert (overall.completed1_pct, overall.completed_both_pct) == (33.3, 16.7)
    people = {r.annotator: (r.assigned, r.completed, r.completion_rate) for r in out["productivity"].collect()}
    assert people == {"annotator1": (6, 2, 33.3), "annotator2": (6, 2, 33.3)}
    assert out["applied"].first()[0] == 4


def lines(report):
    return [r.line for r in report.orderBy("section", "ord").collect()]


def test_reports(spark, frames):
    out = track(track6(spark), updates3(spark))
    text = lines(progress_markdown(out["progress"]))
    assert text[0] == "# Annotation Progress Report"
    assert text[1].startswith("Generated: ")
    assert text[3:8] == [
        "## Overall Statistics",
        "- Total images: 6",
        "- Annotator 1 completion: 2/6 (33.3%)",
        "- Annotator 2 completion: 2/6 (33.3%)",
        "- Both annotators completion: 1/6 (16.7%)",
    ]
    assert text[-3:] == [
        "| 1-12ABCDEF | 2 | 1/2 (50.0%) | 0/2 (0.0%) | 0/2 (0.0%) |",
        "| 1-15XYZWQP | 2 | 1/2 (50.0%) | 1/2 (50.0%) | 1/2 (50.0%) |",
        "| 1-19R5T7G3 | 2 | 0/2 (0.0%) | 1/2 (50.0%) | 0/2 (0.0%) |",
    ]
    text = lines(productivity_markdown(out["productivity"]))
    assert text[-2:] == ["| annotator1 | 6 | 2 | 33.3% |", "| annotator2 | 6 | 2 | 33.3% |"]
    text = lines(evaluation_markdown(frames, "annotator1"))
    assert "- **Token Accuracy**: 0.588" in text
    assert "- **Weighted F1-Score**: 0.569" in text
    assert "- **Cohen's Kappa**: 0.929" in text
    at = text.index("| I-PER → PER | 2 |")
    assert text[at + 1] == "| ADDRESS → ORG | 1 |"
    assert "| realistic_test | 0.333 | 0.389 | 0.000 | 6 |" in text
    assert "| flat_vs_bio_test | 1.000 | 1.000 | 1.000 | 8 |" in text


def test_kappa_edges(spark):
    from pagemark.operators.agreement import kappa, label_pairs

    df = spark.createDataFrame(
        [("X", "X"), ("X", "X"), (None, "X")], "annotator1_label string, annotator2_label string"
    )
    row = kappa(label_pairs(df)).first()
    assert math.isnan(row.kappa_score) and row.total_dual_annotations == 2
    row = kappa(label_pairs(df, include_unlabelled=True)).first()
    assert row.total_dual_annotations == 3
