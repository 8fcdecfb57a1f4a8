"""Ids, positions, versions and reports through real files and odd inputs."""

import json
import re
import time

import pytest
from pyspark.sql import functions as F

from fixtures import ner17
from pagemark import plans, sinks, sources
from pagemark.operators import audit, dedup, jsonops
from pagemark.operators.labels import decode_by_table
from pagemark.operators.pages import image_manifest
from pagemark.plans import cleanup, evaluate_annotations
from pagemark.sources.files import file_position

IDS = [("000123", "0012"), ("2024-01-01", "1e5"), ("1e5", "007"), ("true", "2024-01-01 00:00:00"), ("a+b", "x y")]


@pytest.mark.parametrize("by", [["case_id"], ["case_id", "page_id"]])
def test_ids_survive_storage(spark, tmp_path, by):
    rows = [(case, page, i, "w") for i, (case, page) in enumerate(IDS)]
    df = spark.createDataFrame(rows, "case_id string, page_id string, reading_pos bigint, words string")
    sinks.write_annotations(df, str(tmp_path / "a"), by=by)
    back = sources.scan_annotations(spark, str(tmp_path / "a")).collect()
    assert sorted((r.case_id, r.page_id) for r in back) == sorted(IDS)
    assert {r.file for r in back} == {f"{c}_{p}" for c, p in IDS}


def test_folder_per_case_by_default(spark, tmp_path):
    df = spark.createDataFrame([("c", "p", 1)], "case_id string, page_id string, reading_pos bigint")
    sinks.write_annotations(df, str(tmp_path / "a"))
    assert not list((tmp_path / "a").glob("case_id=c/page_id=*"))


def test_positions_with_small_splits(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("n\n" + "".join(f"{i},{'x' * 20}\n" for i in range(40_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = spark.read.schema("n string, x string").option("header", True).csv(str(path))
        rows = df.select("n", file_position().alias("pos")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r.pos for r in rows}) == len(rows) == 40_000
    assert [int(r.n) for r in sorted(rows, key=lambda r: r.pos)] == list(range(40_000))


def test_plus_signs_in_folders(spark, tmp_path):
    folder = tmp_path / "a+b 100%" / "extracted_text_json"
    folder.mkdir(parents=True)
    (folder / "p.json").write_text("{}")
    assert sources.scan_json_pages(spark, str(tmp_path)).first().case_id == "a+b 100%"
    images = tmp_path / "a+b 100%" / "images"
    images.mkdir()
    (images / "q+1.jpeg").write_bytes(b"x")
    row = sources.scan_images(spark, str(tmp_path)).first()
    assert (row.case_id, row.page_id) == ("a+b 100%", "q+1")


def test_newest_version_by_number(spark, tmp_path):
    root = str(tmp_path / "t")
    for version, columns in ((2, ["a"]), (10, ["a", "b"]), (9, ["a"])):
        df = spark.createDataFrame([tuple(str(version) for _ in columns)], columns)
        sinks.write_version(df, root, version)
    newest = sinks.latest_version(spark, root)
    assert newest.columns == ["a", "b"] and newest.first().a == "10"
    with pytest.raises(FileNotFoundError):
        sinks.latest_version(spark, str(tmp_path))


def test_cleanup_takes_repeated_rows_out(spark):
    rows = [("f", 0, 5, "w", "X", None), ("f", 1, 6, "w", "X", "A"), ("f", 2, 7, "v", "X", None)]
    df = spark.createDataFrame(
        rows, "file string, pos bigint, reading_pos bigint, words string, pred string, annotator1_label string"
    ).withColumn("annotator2_label", F.lit("B"))
    out = cleanup(df, "annotator1", ["reading_pos"])
    assert sorted(r.pos for r in out["annotations"].collect()) == [0, 2]
    assert {r.duplicates_removed for r in out["statistics"].collect()} == {1}
    assert "pos" not in dedup.duplicate_key_columns(df)
    plain = df.drop("annotator1_label")
    assert {r.duplicates for r in audit.duplicate_rows(plain, "file").collect()} == {1}


def test_report_of_one_annotator_and_another_scope(spark):
    df = ner17(spark).withColumnRenamed("file", "page_id")
    for frame in (df, df.drop("annotator2_label")):
        frames = evaluate_annotations(frame, None, pos="pos", scope="page_id")
        report = sinks.evaluation_markdown(frames, "annotator1", scope="page_id")
        text = [r.line for r in report.orderBy("section", "ord").collect()]
        assert ("## Inter-Annotator Agreement" in text) == ("annotator2_label" in frame.columns)
        assert any(x.startswith("| realistic_test | 0.333") for x in text)
        similarity = {r.page_id: r.similarity for r in frames["reading_order_similarity"].collect()}
        assert similarity["flat_vs_bio_test"] == 1.0 and 0 < similarity["all"] < 1


def test_picks_do_not_depend_on_the_run(spark):
    images = spark.createDataFrame(
        [("c", "p", f"/{i}", i) for i in (5, 1, 3)], "case_id string, page_id string, path string, length bigint"
    )
    pages = images.select("case_id", "page_id").distinct()
    assert image_manifest(pages, images.repartition(3)).first().path == "/1"
    vocab = spark.createDataFrame([(0, "Z"), (0, "A")], "idx int, label string")
    df = spark.createDataFrame([("0",)], "pred string")
    assert decode_by_table(df, vocab, "O").first().pred == "A"


def test_profile_of_any_depth(spark):
    docs = ['{"a":{"b":{"c":{"d":{"e":1}}}}}', '{"s":"{[\\"{"}', '[[[["x"]]]]', "no json {{{{"]
    df = spark.createDataFrame([(d,) for d in docs], "json string")
    paths = {r.path: r.kind for r in jsonops.structure_profile(df).collect()}
    assert paths["$.a.b.c.d.e"] == "BIGINT" and paths["$[][][][]"] == "STRING" and paths["$.s"] == "STRING"
    limited = {r.path: r.unopened for r in jsonops.structure_profile(df, max_depth=3).collect()}
    assert limited["$.a.b.c"] == 1 and limited["$[][][]"] == 1 and limited["$.s"] == 0
    assert "$.a.b.c.d" not in limited


def plain_profile(docs):
    """path, kind -> number of values, in plain Python."""
    found, todo = {}, [("$", d) for d in docs]
    while todo:
        path, v = todo.pop()
        kind = "ARRAY" if isinstance(v, list) else "OBJECT" if isinstance(v, dict) else "STRING" if isinstance(v, str) else "BIGINT"
        found[path, kind] = found.get((path, kind), 0) + 1
        if isinstance(v, list):
            todo += [(path + "[]", x) for x in v]
        if isinstance(v, dict):
            todo += [(f"{path}.{k}", x) for k, x in v.items()]
    return found


def nest(depth, width=1):
    v = "end"
    for i in range(depth):
        v = [v, *["side"] * (width - 1)] if i % 3 else {"k": v, **{f"s{j}": j for j in range(width - 1)}}
    return v


@pytest.mark.parametrize("limit", [None, 0, 3, 8, 9, 20])
def test_profile_beside_plain_python(spark, limit):
    docs = [nest(d, w) for d, w in ((0, 1), (3, 2), (8, 1), (9, 3), (17, 2), (25, 1))] + [{"a.b": 1, "a": {"b": 2}}, [], {}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    got = {(r.path, r.kind): r["values"] for r in jsonops.structure_profile(df, max_depth=limit).collect()}
    want = plain_profile(docs)
    if limit is not None:
        deep = {k for k, _ in want if len(re.findall(r"\[\]|\.", k)) > limit}
        want = {k: n for k, n in want.items() if k[0] not in deep}
    want.pop(("$.a.b", "BIGINT"), None)  # two keys, one path: at two depths
    got.pop(("$.a.b", "BIGINT"), None)
    assert got == want


def test_very_deep_documents_take_time_in_proportion(spark):
    def seconds(depth):
        df = spark.createDataFrame([(json.dumps(nest(depth)),)], "json string")
        start = time.perf_counter()
        rows = jsonops.structure_profile(df).collect()
        assert len(rows) == depth + 1
        return time.perf_counter() - start

    seconds(20)
    once = seconds(60)
    assert seconds(200) < 5 * once + 5


@pytest.mark.parametrize(
    "held", ["C:\\dir\\", '}}}}"x', '\\"}}}}', "]" * 9 + "\\" + '"' * 3, "\\" * 4, "}" * 100_000 + '"']
)
def test_depth_is_not_hidden_by_a_string(spark, held):
    docs = [{"p": held, "a": {"b": {"c": {"d": 1}}}}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    assert jsonops.nesting_depth(df) == 4
    paths = {r.path: r.kind for r in jsonops.structure_profile(df).collect()}
    assert paths["$.a.b.c.d"] == "BIGINT" and len(paths) == 6


def test_text_lines_of_an_object_take_linear_time(spark):
    count = 50_000
    entries = [{"text": f"t{i}"} for i in range(count)]
    as_list = json.dumps({"extracted_lines": entries})
    as_object = json.dumps({"extracted_lines": {f"k{(i * 7919) % count}": e for i, e in enumerate(entries)}})

    def run(text):
        df = spark.createDataFrame([(1, text)], "id int, json string")
        start = time.perf_counter()
        rows = jsonops.text_lines(df, ["id"]).collect()
        assert [r.text for r in sorted(rows, key=lambda r: r.line_no)] == [f"t{i}" for i in range(count)]
        return time.perf_counter() - start

    run(as_list)
    assert run(as_object) < 6 * run(as_list) + 3


def test_export_of_a_folder(spark, tmp_path):
    data = tmp_path / "data"
    (data / "deep").mkdir(parents=True)
    (data / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (data / "b.csv").write_text("z\n1\n")
    (data / "broken.parquet").write_text("no parquet")
    (data / "notes.txt").write_text("passed over")
    spark.createDataFrame([(5,)], "x int").write.parquet(str(data / "deep" / "c.parquet"))
    flat = {r.dataset: r for r in plans.export_folder(spark, str(data), "x, y", str(tmp_path / "o1")).collect()}
    assert set(flat) == {"a", "b", "broken"}
    assert (flat["a"].exported, flat["a"].rows, flat["a"].missing, flat["a"].reason) == (True, 2, "", None)
    assert not flat["b"].exported and flat["b"].reason == "none of the columns"
    assert not flat["broken"].exported and flat["broken"].reason
    written = spark.read.option("header", True).csv(str(tmp_path / "o1" / "a_extracted"))
    assert sorted((r.x, r.y) for r in written.collect()) == [("1", "2"), ("3", "4")]
    deep = plans.export_folder(spark, str(data), ["x"], str(tmp_path / "o2"), keep_name=True, recursive=True)
    assert {r.dataset for r in deep.filter("exported").collect()} == {"a", "deep/c"}
    assert spark.read.option("header", True).csv(str(tmp_path / "o2" / "deep" / "c")).first().x == "5"
    (tmp_path / "none").mkdir()
    assert plans.export_folder(spark, str(tmp_path / "none"), ["x"], str(tmp_path / "o3")).count() == 0


def test_path_templates_of_prepare(spark):
    tokens = spark.createDataFrame(
        [("c", "p", 0, "w", "(1, 2, 3, 4)", "0", 0.5)],
        "case_id string, page_id string, pos bigint, words string, bboxes string, pred string, prob double",
    )
    out = plans.prepare(
        tokens, tokens.select("case_id", "page_id"), "Z:", image_template="{share}/{case_id}/{page_id}.png"
    )
    assert out["assignments"].first().image_file_path == "Z:/c/p.png"
