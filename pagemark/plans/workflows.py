"""Prepare, evaluate, track, clean and fill: the jobs users start.

Each returns named DataFrames. Nothing runs before a frame is written or shown, except that a
consecutive page number needs a sample of names first. Ranked frames hold all rows; reports cut them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.operators import audit, confusion, datasets, pages, sequences, tracking
from pagemark.operators.agreement import disagreements, kappa, label_pairs
from pagemark.operators.calibration import (
    calibration_bins,
    calibration_error,
    errors_by_band,
    errors_by_quadrant,
)
from pagemark.operators.labels import with_evaluation_labels
from pagemark.operators.ordering import indexed
from pagemark.schemas import ANNOTATORS
from pagemark.sinks.tables import write_csv
from pagemark.sources.files import scan_datasets


def prepare(
    tokens: DataFrame,
    page_list: DataFrame,
    share: str,
    images: DataFrame | None = None,
    cases: DataFrame | None = None,
    annotators=None,
    image_template: str = tracking.IMAGE_TEMPLATE,
    label_template: str = tracking.LABEL_TEMPLATE,
) -> dict[str, DataFrame]:
    """Annotation documents, assignments, case index and the reason for every page without one.

    Without ``images`` or ``cases`` those checks pass. The templates make the paths of the assignments.
    """
    listed = page_list.select("case_id", "page_id").distinct()
    token_pages = tokens.select("case_id", "page_id").distinct()
    reconciled = pages.page_reconciliation(
        listed, token_pages, cases=cases, token_cases=token_pages, images=images
    )
    ok = F.col("status") == "ok"
    ready = reconciled.filter(ok).select("case_id", "page_id")
    # pages without tokens add no rows to the table, so its list needs no look at the tokens
    wanted = pages.page_reconciliation(listed, cases=cases, images=images).filter(ok)
    assignments = tracking.tracking_rows(ready, share, annotators, image_template, label_template)
    out = {
        "annotations": pages.annotation_table(tokens, wanted),
        "assignments": assignments,
        "reconciliation": reconciled,
        "index": tracking.case_index(assignments, annotators),
    }
    if images is not None:
        out["images"] = pages.image_manifest(page_list, images)
    return out


def _both_levels(counts: DataFrame, scope: str) -> DataFrame:
    return confusion.with_overall(counts, scope, ["truth", "pred"], ["n"])


def evaluate_annotations(
    df: DataFrame,
    labels: list[str] | None,
    annotator: str = "annotator1",
    pos: str = "reading_pos",
    scope: str = "file",
) -> dict[str, DataFrame]:
    """Model and annotator scores per document and overall (`level`), from one confusion frame per
    label mode."""
    keys = [scope]
    judged = with_evaluation_labels(df, annotator, labels, keys, pos)
    combinations = confusion.label_combinations(
        df, keys, [c for c in ("annotator1_label", "annotator2_label", "pred") if c in df.columns]
    )
    out: dict[str, DataFrame] = {}
    levels = ["level", scope]
    per_mode = {
        "flat": confusion.flat_confusion(combinations, annotator, labels, keys),
        "bio": confusion.bio_confusion(df, annotator, labels, keys, pos, keys),
    }
    for mode, documents in per_mode.items():
        counts = _both_levels(documents, scope)
        report = confusion.class_report(counts, levels)
        out[f"confusion_{mode}"] = counts
        out[f"classes_{mode}"] = report
        out[f"averages_{mode}"] = confusion.report_averages(report, levels)
    flat = out["confusion_flat"].filter(F.col("level") == "overall")
    out["accuracy"] = confusion.accuracy(out["confusion_flat"], levels)
    out["error_pairs"] = confusion.error_pairs(flat, None)
    out["confused_labels"] = confusion.confused_labels(flat, None)
    out["error_rate"] = confusion.error_rate(
        with_evaluation_labels(combinations, annotator, labels, bio=False),
        "ground_truth_flat",
        "pred_flat",
        weight="n",
    )
    out["layout"] = confusion.layout_accuracy(flat)
    if {"annotator1_label", "annotator2_label"} <= set(df.columns):
        pairs = confusion.with_overall(
            label_pairs(combinations, scope=keys, weight="n"), scope, ["label1", "label2"], ["n"]
        )
        out["kappa"] = kappa(pairs, levels)
        out["disagreements"] = disagreements(pairs, levels)
    out["sequence_scores"] = sequences.span_scores(
        sequences.span_counts(judged, keys, pos, "ground_truth_bio", "pred_bio")
    )
    out["sequence_accuracy"] = sequences.sequence_accuracy(
        judged, keys, "ground_truth_bio", "pred_bio"
    )
    out["transitions"] = sequences.label_transitions(
        judged, keys, pos, "ground_truth_flat", "pred_flat"
    )
    out["reading_order_similarity"] = sequences.reading_order_similarity(out["transitions"], scope)
    if "prob" in df.columns:
        bins = calibration_bins(judged, "ground_truth_flat", "pred_flat")
        out["calibration"] = bins
        out["calibration_error"] = calibration_error(bins)
        out["errors_by_band"] = errors_by_band(judged, "ground_truth_flat", "pred_flat")
    if "x1" in df.columns and "y1" in df.columns:
        out["errors_by_quadrant"] = errors_by_quadrant(judged, "ground_truth_flat", "pred_flat")
    out["summary"] = evaluation_summary(df, labels, annotator, scope)
    return out


def evaluation_summary(
    df: DataFrame, labels: list[str] | None, annotator: str = "annotator1", scope: str = "file"
) -> DataFrame:
    """Documents evaluated, the annotator taken as truth, and the size of the vocabulary."""
    return df.agg(
        F.count_distinct(scope).alias("total_files"),
        F.lit(annotator).alias("ground_truth_annotator"),
        F.lit(len(labels or [])).alias("total_entity_labels"),
    )


def averages_by_annotator(
    df: DataFrame, labels: list[str] | None, scope: list[str] = (), run: str | None = None
) -> DataFrame:
    """Flat scores with either annotator as the truth, one pass; stack runs with `unionByName`."""
    sides = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("annotator"), F.col(f"{a}_label").alias("truth"))
                for a in ANNOTATORS
            ]
        )
    )
    # unpivoted and decoded as combinations, which are few
    long = (
        with_evaluation_labels(
            confusion.label_combinations(df, scope), "annotator1", labels, bio=False
        )
        .select(*scope, sides.alias("_side"), "pred_flat", "n")
        .select(*scope, "_side.annotator", "_side.truth", "pred_flat", "n")
    )
    by = ["annotator", *scope]
    counts = confusion.confusion(long, "truth", "pred_flat", by, weight="n")
    out = confusion.report_averages(confusion.class_report(counts, by), by)
    return out if run is None else out.withColumn("run", F.lit(run))


def evaluate_predictions(
    df: DataFrame, scope: str = "file", page_index: bool = False
) -> dict[str, DataFrame]:
    """Token and page scores of prediction files; labels and predictions are compared as text."""
    counts = confusion.confusion(df, "labels", "pred", [scope], valid_only=False)
    total = counts.groupBy("truth", "pred").agg(F.sum("n").alias("n"))
    report = confusion.class_report(total)
    per_page = confusion.page_metrics(counts, scope)
    if page_index:
        per_page = indexed(per_page, scope, "page_index", sample_from=df)
    return {
        "classes": report,
        "token_metrics": confusion.report_averages(report),
        "confusion": total,
        "pages": per_page,
        "summary": confusion.page_summary(per_page),
        "low_score_pages": confusion.low_score_pages(per_page),
        "worst_classes": confusion.worst_classes(report, None),
    }


def track(assignments: DataFrame, updates: DataFrame | None = None) -> dict[str, DataFrame]:
    """Assignments after a batch of updates, with progress and productivity."""
    out = {}
    current = assignments
    if updates is not None:
        merged = tracking.apply_updates(assignments, updates)
        out["applied"] = merged.agg(F.coalesce(F.sum("slot_writes"), F.lit(0)).alias("applied_updates"))
        out["rejected_updates"] = tracking.rejected_updates(updates)
        current = merged.drop("slot_writes")
    out["assignments"] = current
    out["progress"] = tracking.progress(current)
    out["productivity"] = tracking.productivity(current)
    return out


def cleanup(
    df: DataFrame, annotator: str, order: list[str], deduplicate: bool = True, scope: str = "file"
) -> dict[str, DataFrame]:
    after = audit.cleanup_job(df, annotator, order, deduplicate)
    return {
        "annotations": after.drop("label_filled"),
        "statistics": audit.cleanup_statistics(df, after, scope),
    }


def fill(
    df: DataFrame, labels: list[str], order: list[str], scope: str = "file"
) -> dict[str, DataFrame]:
    after = audit.fill_job(df, labels, order)
    return {
        "annotations": after.drop("annotator1_filled", "annotator2_filled"),
        "statistics": audit.fill_statistics(df, after, scope),
    }


def export_columns(
    named: dict[str, DataFrame], columns: str | list[str], keep_name: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Lenient export of several datasets: the frames by output name, and a status per dataset."""
    wanted = datasets.column_list(columns) if isinstance(columns, str) else list(columns)
    frames = {}
    for name, df in named.items():
        chosen = datasets.export_lenient(df, wanted)
        if chosen is not None:
            frames[name if keep_name else f"{name}_extracted"] = chosen
    return frames, datasets.export_status(named, wanted)


def export_folder(
    spark: SparkSession,
    folder: str,
    columns: str | list[str],
    out: str,
    keep_name: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Lenient export of all datasets of a folder as CSV; one status row per dataset.

    A dataset that cannot be read, or has none of the columns, fails alone: `exported` is false, and
    `reason` says why.
    """
    wanted = datasets.column_list(columns) if isinstance(columns, str) else list(columns)
    frames, failures = scan_datasets(spark, folder, recursive)
    chosen, status = ({}, None) if not frames else export_columns(frames, wanted, keep_name)
    for name, frame in chosen.items():
        write_csv(frame, f"{out}/{name}")
    schema = "dataset string, exported boolean, columns string, missing string, rows bigint, reason string"
    failed = spark.createDataFrame(
        [(name, False, "", ",".join(wanted), 0, reason) for name, reason in failures.items()], schema
    )
    if status is None:
        return failed
    reason = F.when(~F.col("exported"), F.lit("none of the columns"))
    return status.withColumn("reason", reason).unionByName(failed)
