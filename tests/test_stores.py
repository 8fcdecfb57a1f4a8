"""Results of a run as one folder, and tables kept in buckets."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from fixtures import ner17
from pagemark import plans, sinks
from pagemark.operators import tracking

ASSIGNED = "case_id string, page_id string, assignee1 string, has_assignee1_completed string, assignee2 string, has_assignee2_completed string, notes string"


def files_of(path):
    """Every data file below a folder with its time of change."""
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                full = os.path.join(folder, n)
                found[full] = os.stat(full).st_mtime_ns
    return found


def test_a_run_comes_back_whole(spark, tmp_path):
    df = spark.createDataFrame(
        [("f1", "A", "A"), ("f1", "B", "A"), ("f2", "A", "A")], "file string, labels string, pred string"
    )
    frames = plans.evaluate_predictions(df)
    path, config = str(tmp_path / "run"), {"predictions": "s3://x", "save_details": True, "limit": None}
    manifest = sinks.write_results(frames, path, config, ["token_metrics", "summary"])
    assert set(manifest["frames"]) == set(frames)
    got_config, summary, got = sinks.read_results(spark, path)
    assert got_config == config
    for name, frame in frames.items():
        assert got[name].schema.names == frame.schema.names
        assert sorted(map(str, got[name].collect())) == sorted(map(str, frame.collect())), name
        assert manifest["frames"][name]["rows"] == got[name].count()
    metrics, pages = frames["token_metrics"].first(), frames["summary"].first()
    assert summary["accuracy"] == metrics["accuracy"] and set(pages.asDict()) <= set(summary)
    with pytest.raises(FileExistsError):
        sinks.write_results(frames, path, config)


def test_annotation_scores_as_a_run(spark, tmp_path):
    frames = plans.evaluate_annotations(ner17(spark), None, pos="pos") if "pos" in ner17(spark).columns else plans.evaluate_annotations(ner17(spark), None)
    path = str(tmp_path / "run")
    sinks.write_results(frames, path, {"annotator": "annotator1"}, ["summary"])
    _, summary, got = sinks.read_results(spark, path)
    assert summary["total_files"] == frames["summary"].first().total_files
    assert set(got) == set(frames)


def test_a_torn_run_is_not_taken(spark, tmp_path):
    good = spark.range(3)
    bad = good.select(F.raise_error(F.lit("lost")).alias("x"))
    path = str(tmp_path / "run")
    with pytest.raises(Exception, match="lost"):
        sinks.write_results({"good": good, "bad": bad}, path, {"a": 1})
    assert json.loads((tmp_path / "run" / "config.json").read_text()) == {"a": 1}
    with pytest.raises(FileNotFoundError):
        sinks.read_results(spark, path)
    whole = str(tmp_path / "whole")
    sinks.write_results({"one": good, "two": good}, whole, {})
    os.rename(f"{whole}/frames/two", f"{whole}/frames/gone")
    with pytest.raises(FileNotFoundError, match="two"):
        sinks.read_results(spark, whole)


def test_no_number_is_null_in_the_summary(spark, tmp_path):
    frame = spark.sql("select double('nan') as kappa, 0.5D as share, date'2024-01-01' as day, cast(null as int) as n")
    path = str(tmp_path / "run")
    sinks.write_results({"s": frame, "none": frame.limit(0)}, path, {}, ["none", "s"])
    assert sinks.read_results(spark, path)[1] == {"kappa": None, "share": 0.5, "day": "2024-01-01", "n": None}
    with pytest.raises(ValueError):
        sinks.write_results({"s": frame.union(frame)}, str(tmp_path / "two"), {}, ["s"])


@pytest.fixture
def assignments(spark):
    rows = [(f"c{i % 40}", f"p{i}", "ann", "no", "bob", "no", "") for i in range(400)]
    return spark.createDataFrame(rows, ASSIGNED)


def test_an_update_replaces_its_buckets_only(spark, tmp_path, assignments):
    path = str(tmp_path / "store")
    sinks.write_store(assignments, path, buckets=16)
    before = files_of(path)
    updates = spark.createDataFrame(
        [("c3", "p3", "ann", "yes", 1), ("c3", "p43", None, "yes", 2), ("c7", "p7", "bob", "maybe", 3), ("zz", "q", "ann", "yes", 4)],
        "case_id string, page_id string, annotator string, status string, ord long",
    )
    out = sinks.update_store(spark, path, updates)
    assert out["applied"].first().applied_updates == 3
    assert [r.status for r in out["rejected_updates"].collect()] == ["maybe"]
    after = files_of(path)
    kept = {f for f in before if after.get(f) == before[f]}
    touched = {f.split("/bucket=")[1].split("/")[0] for f in set(before) - kept}
    assert 1 <= len(touched) <= 2 and len({f.split("/bucket=")[1].split("/")[0] for f in kept}) >= 10
    want = tracking.apply_updates(assignments, updates).drop("slot_writes")
    assert sorted(map(tuple, sinks.scan_store(spark, path).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    # applying the batch again changes nothing
    sinks.update_store(spark, path, updates)
    assert sorted(map(tuple, sinks.scan_store(spark, path).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_an_update_without_valid_rows_changes_no_file(spark, tmp_path, assignments):
    path = str(tmp_path / "store")
    sinks.write_store(assignments, path, buckets=8)
    before = files_of(path)
    updates = spark.createDataFrame([("c1", "p1", "ann", "x", 1)], "case_id string, page_id string, annotator string, status string, ord long")
    assert sinks.update_store(spark, path, updates)["applied"].first().applied_updates == 0
    assert files_of(path) == before


def test_a_page_list_reads_its_buckets_only(spark, tmp_path):
    rows = [(f"c{i % 50}", f"p{i % 200}", i, f"w{i}") for i in range(2_000)]
    tokens = spark.createDataFrame(rows, "case_id string, page_id string, pos long, words string")
    path = str(tmp_path / "tokens")
    sinks.write_store(tokens, path, buckets=32, order=["page_id", "pos"])
    pages = spark.createDataFrame([("c3", "p3"), ("c3", "p53"), ("c3", "p3"), ("none", "p1")], "case_id string, page_id string")
    out = sinks.scan_store(spark, path, pages)
    assert sorted(map(tuple, out.select("case_id", "page_id", "pos", "words").collect())) == sorted(
        r for r in rows if r[:2] in {("c3", "p3"), ("c3", "p53")}
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = plan.partition("PartitionFilters: [")[2].partition("]")[0]
    assert "bucket#" in filters
    whole = sinks.scan_store(spark, path)
    assert whole.count() == len(rows) and set(whole.columns) == set(tokens.columns)
    wanted = {r[0] for r in pages.select(F.pmod(F.xxhash64("case_id"), F.lit(32))).distinct().collect()}
    named = re.search(r"bucket#\d+ IN \(([\d,]+)\)", filters) or re.search(r"bucket#\d+ = (\d+)", filters)
    assert {int(x) for x in named[1].split(",")} == wanted
