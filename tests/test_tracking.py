"""Status updates against a row-by-row fold, views and reports of assignments."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import track6
from pagemark.operators import tracking
from pagemark.schemas import ASSIGNMENTS

UPDATE = "case_id string, image_id string, annotator string, status string, ord bigint"


def fold(rows, updates):
    rows, writes = [list(r) for r in rows], 0
    for case, page, who, status, _ in sorted(updates, key=lambda u: u[4]):
        if status.lower() not in ("yes", "no"):
            continue
        for r in rows:
            if r[:2] == [case, page]:
                for slot in (4, 6):
                    if not who or who == r[slot]:
                        r[slot + 1] = status.lower()
                        writes += 1
    return sorted(tuple(r) for r in rows), writes


@pytest.mark.parametrize("seed", range(3))
def test_updates(spark, seed):
    rng = random.Random(seed)
    people = ["ann", "bob", "cy"]
    rows = [
        (f"c{rng.randrange(3)}", f"p{rng.randrange(4)}", "", "", rng.choice(people), "no", rng.choice(people), "yes", "")
        for _ in range(14)
    ]
    updates = [
        (f"c{rng.randrange(3)}", f"p{rng.randrange(4)}", rng.choice([*people, "", None]), rng.choice(["yes", "No", "done"]), i)
        for i in range(60)
    ]
    out = tracking.apply_updates(
        spark.createDataFrame(rows, ASSIGNMENTS), spark.createDataFrame(updates, UPDATE).repartition(4)
    )
    want, writes = fold(rows, updates)
    assert sorted(tuple(r)[:-1] for r in out.collect()) == want
    assert out.agg(F.sum("slot_writes")).first()[0] == writes
    bad = sum(u[3] == "done" for u in updates)
    assert tracking.rejected_updates(spark.createDataFrame(updates, UPDATE)).count() == bad


def test_set_status(spark):
    df = track6(spark)
    out = tracking.set_status(df, "Yes", case_ids=["1-12ABCDEF"], annotators=["annotator2"])
    done = out.filter("has_assignee2_completed = 'yes'")
    assert {r.case_id for r in done.collect()} == {"1-12ABCDEF"} and done.count() == 2
    assert out.filter("has_assignee1_completed = 'yes'").count() == 0
    assert out.agg(F.sum("slot_writes")).first()[0] == 2
    wanted = spark.createDataFrame([("9876543210_01_0",), ("9876543210_01_0",)], "x string")
    out = tracking.set_status(df, "yes", page_ids=wanted)
    assert out.count() == 6 and out.agg(F.sum("slot_writes")).first()[0] == 2
    with pytest.raises(ValueError):
        tracking.set_status(df, "done", case_ids=["x"])
    with pytest.raises(ValueError):
        tracking.set_status(df, "yes")


def test_rows_and_views(spark):
    pages = spark.createDataFrame([("c1", "p1"), ("c1", "p2"), ("c0", "p1")], "case_id string, page_id string")
    rows = tracking.tracking_rows(pages, "Z:")
    first = rows.orderBy("case_id", "page_id").first()
    assert first.image_file_path == "Z:\\annotation_images\\c0_p1.jpeg"
    assert first.label_file_path == "Z:\\annotation_labels\\c0_p1.xlsx"
    assert (first.assignee1, first.has_assignee1_completed, first.assignee2, first.notes) == ("annotator1", "no", "annotator2", "")
    view = tracking.annotator_view(rows)
    assert view.count() == 6
    assert view.columns == ["slot", "case_id", "page_id", "image_file_path", "label_file_path", "assignee", "has_completed", "notes"]
    index = [tuple(r) for r in tracking.case_index(rows, ["ann", "bob"], ".xlsx").collect()]
    assert index == [("c0", 1, "ann/c0.xlsx", "bob/c0.xlsx"), ("c1", 2, "ann/c1.xlsx", "bob/c1.xlsx")]
    assert tracking.two_annotators(["one"]) == ["annotator1", "annotator2"]
    with pytest.raises(ValueError):
        tracking.tracking_rows(pages, "Z:", ["a", "b", "c"])


def test_empty_progress(spark):
    df = track6(spark).limit(0)
    assert tracking.progress(df).filter("level = 'group'").count() == 0
    assert tracking.productivity(df).count() == 0


def test_case_named_like_total(spark):
    df = track6(spark).withColumn("case_id", F.lit("all"))
    rows = {r.level: r.total for r in tracking.progress(df).collect()}
    assert rows == {"group": 6, "overall": 6}
