"""Shapes of physical plans that matter at scale."""

import re

import pytest

import workload

SMALL = "/root/testdata/sf0.001"
FORBIDDEN = re.compile(
    r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|CartesianProduct|BroadcastNestedLoopJoin"
)


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_no_python_and_no_cross_join(spark, name):
    assert not FORBIDDEN.search(plan(workload.queries()[name](spark, SMALL)))


@pytest.mark.parametrize("name", ["topk_collapse", "topk_collapse_by_word", "drop_duplicates_first", "annotation_table"])
def test_keys_are_cut_before_the_shuffle(spark, name):
    text = plan(workload.queries()[name](spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", text)


@pytest.mark.parametrize("name", ["reading_order", "annotation_table", "label_transitions", "page_metrics"])
def test_one_plan_for_all_sizes(spark, name):
    text = plan(workload.queries()[name](spark, SMALL), run=True)
    # one read for the rows, and a narrow one where the counts need fewer columns
    assert text.count("FileScan") <= 2 and "Union" not in text


def test_box_overlap_reads_each_table_once(spark):
    text = plan(workload.queries()["box_overlap"](spark, SMALL), run=True)
    assert text.count("FileScan") == 2


@pytest.mark.parametrize("name", ["error_patterns", "confused_labels", "worst_classes", "preview"])
def test_top_k_keeps_k_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan(workload.queries()[name](spark, SMALL))


def test_scan_reads_needed_columns_only(spark):
    text = plan(workload.queries()["productivity"](spark, SMALL))
    assert "o_totalprice" not in text and "o_custkey" not in text
    text = plan(workload.queries()["page_tokens"](spark, SMALL))
    assert "l_extendedprice" not in text and "EqualTo(o_orderstatus,F)" in text


def test_box_pairs_meet_per_cell(spark):
    text = plan(workload.queries()["box_overlap"](spark, SMALL))
    assert re.search(r"(SortMergeJoin|HashJoin) \[case_id#\d+, cx#\d+, cy#\d+\]", text)


def test_documents_are_cut_into_blocks(spark):
    for name in ("flat_to_bio", "entity_spans", "sequence_scores"):
        text = plan(workload.queries()[name](spark, SMALL))
        assert re.search(r"hashpartitioning\(case_id#\d+, _block#\d+L?", text), name


def test_diff_has_no_join(spark):
    assert "Join" not in plan(workload.queries()["dataset_diff"](spark, SMALL))


def test_class_ids_are_looked_up_without_a_join(spark):
    assert "Join" not in plan(workload.queries()["decode_unk"](spark, SMALL))


@pytest.mark.parametrize(
    "name, most",
    [("annotation_table", 2), ("reading_order", 2), ("label_transitions", 4), ("reading_order_similarity", 5),
     ("sequence_scores", 6)],
)
def test_small_documents_need_no_summaries(spark, name, most):
    """Rows are dealt once per order; what large documents take is gone from the plan where there are none."""
    text = plan(workload.queries()[name](spark, SMALL), run=True)
    assert len(re.findall(r"Exchange (hashpartitioning|SinglePartition)", text)) <= most
    assert text.count("FileScan") == (2 if name == "sequence_scores" else 1)


@pytest.mark.parametrize("name", ["box_region", "reading_order", "annotation_table"])
def test_box_texts_are_parsed_once_a_row(spark, name):
    """Where a projection of coordinates is merged with a filter on them, each one parses the text again."""
    text = workload.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert all(line.count("regexp_extract") <= 1 for line in text.splitlines())
