"""Differences, appends, exports and JSON documents."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemark.operators import datasets, jsonops
from pagemark.plans import export_columns

COLUMNS = "k string, v int"


def summary(df):
    return {r.metric: r["count"] for r in df.collect()}


def test_diff_with_duplicates_and_nulls(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("l", 3)], COLUMNS)
    right = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("r", 4)], COLUMNS)
    got = summary(datasets.diff_summary(left, right))
    assert got == {
        "only_in_left": 1, "only_in_right": 1, "common_rows": 5, "rows_left": 4, "rows_right": 4,
        "joined_rows": 7, "keys_only_left": 1, "keys_only_right": 1, "keys_common": 2,
    }
    rows = {(r.k, r.v): (r.side, r.copies) for r in datasets.diff_rows(left, right).collect()}
    assert rows == {("a", 1): ("both", 4), (None, 2): ("both", 1), ("l", 3): ("left_only", 1), ("r", 4): ("right_only", 1)}


def test_diff_by_key(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), (None, 2), ("l", 3)], COLUMNS)
    right = spark.createDataFrame([("a", 1), (None, 9), ("r", 4)], COLUMNS)
    got = sorted(map(str, (tuple(r) for r in datasets.diff_rows_by_key(left, right, ["k"]).collect())))
    assert got == sorted(map(str, [
        ("a", 1, "left", "both", 1), ("a", 2, "left", "both", 1), (None, 2, "left", "both", 1),
        ("l", 3, "left", "left_only", 0), ("a", 1, "right", "both", 2), (None, 9, "right", "both", 1),
        ("r", 4, "right", "right_only", 0),
    ]))
    assert summary(datasets.diff_summary(left, right, ["k"]))["joined_rows"] == 5
    with pytest.raises(ValueError):
        datasets.diff_summary(left, right, ["x"])
    with pytest.raises(ValueError):
        datasets.diff_summary(left, right.withColumnRenamed("v", "w"))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), max_size=12))
def test_diff_with_itself(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    got = summary(datasets.diff_summary(df, df))
    assert got["only_in_left"] == got["only_in_right"] == 0 and got["rows_left"] == len(rows)


def test_union(spark):
    a = spark.createDataFrame([("a", 1)], COLUMNS)
    assert datasets.strict_union(a, a).count() == 2
    swapped = a.select("v", "k")
    with pytest.raises(ValueError):
        datasets.strict_union(a, swapped)
    assert datasets.strict_union(a, swapped.limit(0)).columns == ["k", "v"]
    assert datasets.strict_union(a.limit(0), swapped).columns == ["v", "k"]


def test_exports(spark):
    a = spark.createDataFrame([("a", 1)], COLUMNS)
    assert datasets.export_strict(a).columns == ["k", "v"]
    assert datasets.export_strict(a, ["v"]).columns == ["v"]
    with pytest.raises(ValueError):
        datasets.export_strict(a, ["v", "x"])
    frames, status = export_columns({"one": a, "two": a.select("v"), "none": a.selectExpr("v as z")}, " k, v ")
    assert {n: f.columns for n, f in frames.items()} == {"one_extracted": ["k", "v"], "two_extracted": ["v"]}
    got = {r.dataset: (r.exported, r.missing) for r in status.collect()}
    assert got == {"one": (True, ""), "two": (True, "k"), "none": (False, "k,v")}
    rows = {r.dataset: (r.idx, r.rows, r.columns, r.column_count) for r in datasets.catalogue({"one": a, "e": a.limit(0)}).collect()}
    assert rows == {"one": (0, 1, "k,v", 2), "e": (1, 0, "k,v", 2)}


PAGES = [
    {"extracted_lines": [{"text": "a"}, {"t": 1}, {"text": "b"}, {"text": None}, "x", {"text": 5}]},
    {"extracted_lines": {"l1": {"text": "c"}, "l10": {"text": "d"}, "l2": {"text": "e"}, "x": {"t": 0}}},
    {"other": 1},
    {"extracted_lines": "text"},
]


def pages(spark):
    rows = [(i, json.dumps(p)) for i, p in enumerate(PAGES)] + [(9, "{broken")]
    return spark.createDataFrame(rows, "i int, json string")


def test_text_lines(spark):
    got = sorted(tuple(r) for r in jsonops.text_lines(pages(spark), ["i"]).fillna("-").collect())
    assert got == [(0, 0, "a"), (0, 2, "b"), (0, 3, "-"), (0, 5, "5"), (1, 0, "c"), (1, 1, "d"), (1, 2, "e")]


def test_json_path(spark):
    df = spark.createDataFrame([('{"a":{"b":[{"c":7}]}}',), ('{"a":1}',), ("[5]",)], "json string")
    v = jsonops.parsed()
    got = [r[0] for r in df.select(jsonops.json_path(v, "a.b[0].c", "int")).collect()]
    assert got == [7, None, None]
    assert [r[0] for r in df.select(jsonops.json_path(v, "[0]", "int")).collect()] == [None, None, 5]
    assert df.limit(1).select(jsonops.require_path(v, "a.b[0].c", "int")).first()[0] == 7
    with pytest.raises(Exception, match="path not found"):
        df.select(jsonops.require_path(v, "a.b[0].c", "int")).collect()


def test_profile(spark):
    got = {(r.path, r.kind): (r["values"], r.min_size, r.max_size) for r in jsonops.structure_profile(pages(spark)).collect()}
    assert got["$", "OBJECT"] == (4, 1, 1)
    assert got["$.extracted_lines", "ARRAY"] == (1, 6, 6)
    assert got["$.extracted_lines", "OBJECT"] == (1, 4, 4)
    assert got["$.extracted_lines", "STRING"] == (1, None, None)
    assert got["$.extracted_lines[]", "OBJECT"][0] == 5
    assert got["$.extracted_lines[].text", "STRING"][0] == 2
    assert got["$.extracted_lines.l10.text", "STRING"][0] == 1
    shallow = {r.path for r in jsonops.structure_profile(pages(spark), max_depth=1).collect()}
    assert shallow == {"$", "$.extracted_lines", "$.other"}
    assert "extracted_lines" in jsonops.merged_schema(pages(spark).limit(1)).first()[0]
