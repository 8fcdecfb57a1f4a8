"""Completeness of annotation documents and statistics of batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemark.functions.text import is_blank, percent
from pagemark.operators.confusion import with_overall
from pagemark.operators.dedup import POSITION_COLUMNS, collapse_top_k_by_word, drop_duplicates_first
from pagemark.operators.labels import fill_predictions, standardise_annotator
from pagemark.schemas import ANNOTATORS, annotator_column


def completion_audit(
    df: DataFrame, scope: str = "file", skip_backups: bool = False, overall: str = "all"
) -> DataFrame:
    """Rows and labelled rows of both annotators, per document and overall. The text `nan` counts
    as a label here."""
    if skip_backups:
        df = df.filter(~F.col(scope).contains("backup"))
    done = [f"{a}_completed" for a in ANNOTATORS]
    counts = [
        F.count_if(~is_blank(annotator_column(a), False))
        if annotator_column(a) in df.columns
        else F.sum(F.lit(0))
        for a in ANNOTATORS
    ]
    per_document = df.groupBy(scope).agg(
        F.count(F.lit(1)).alias("total_rows"), *[c.alias(n) for c, n in zip(counts, done)]
    )
    out = with_overall(per_document, scope, [], ["total_rows", *done], overall)
    return out.select(
        "level", scope, "total_rows", *done, *[percent(n, "total_rows").alias(f"{n}_pct") for n in done]
    )


def duplicate_rows(
    df: DataFrame, scope: str, columns: list[str] | None = None, overall: str = "all"
) -> DataFrame:
    """Rows that repeat an earlier one of their document in all ``columns``, by default all but those
    for the row order."""
    if columns is None:
        columns = [c for c in df.columns if c not in POSITION_COLUMNS]
    columns = [c for c in columns if c != scope]
    repeated = df.groupBy(scope, *columns).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    per_document = repeated.groupBy(scope).agg(F.sum("_extra").alias("duplicates"))
    return with_overall(per_document, scope, [], ["duplicates"], overall).select(
        "level", scope, "duplicates"
    )


def _job_statistics(parts: list[DataFrame], scope: str, sums: list[str], overall: str) -> DataFrame:
    """Fold before and after counts, one row per document each, without joining them."""
    stacked = None
    for part in parts:
        padded = part.select(
            scope, *[F.col(c) if c in part.columns else F.lit(0).cast("bigint").alias(c) for c in sums]
        )
        stacked = padded if stacked is None else stacked.unionAll(padded)
    per_document = stacked.groupBy(scope).agg(*[F.sum(c).alias(c) for c in sums])
    return with_overall(per_document, scope, [], sums, overall).select("level", scope, *sums)


def _rows(df: DataFrame, scope: str, name: str) -> DataFrame:
    return df.groupBy(scope).agg(F.count(F.lit(1)).alias(name))


def fill_job(
    df: DataFrame, labels: list[str], order: list[str], word_key: list[str] | None = None
) -> DataFrame:
    """Collapse top-k rows, then fill blank labels with decoded predictions."""
    return fill_predictions(collapse_top_k_by_word(df, order, word_key), labels)


def fill_statistics(
    before: DataFrame, after: DataFrame, scope: str = "file", overall: str = "all"
) -> DataFrame:
    """Rows in and out, predictions decoded, labels filled per annotator, duplicates removed.

    ``after`` is `fill_job`'s result.
    """
    decoded = F.count(F.lit(1)) if "pred" in before.columns else F.sum(F.lit(0))
    results = after.groupBy(scope).agg(
        F.count(F.lit(1)).alias("final_rows"),
        decoded.alias("predictions_decoded"),
        *[F.count_if(F.col(f"{a}_filled")).alias(f"{a}_filled") for a in ANNOTATORS],
    )
    sums = ["original_rows", "final_rows", "predictions_decoded", *[f"{a}_filled" for a in ANNOTATORS]]
    stats = _job_statistics([_rows(before, scope, "original_rows"), results], scope, sums, overall)
    return stats.withColumn("duplicates_removed", F.col("original_rows") - F.col("final_rows"))


def cleanup_job(
    df: DataFrame,
    annotator: str,
    order: list[str],
    deduplicate: bool = True,
    keys: list[str] | None = None,
) -> DataFrame:
    """Drop repeated rows, then standardise labels to one annotator."""
    kept = drop_duplicates_first(df, order, keys) if deduplicate else df
    return standardise_annotator(kept, annotator)


def cleanup_statistics(
    before: DataFrame, after: DataFrame, scope: str = "file", overall: str = "all"
) -> DataFrame:
    """Rows in and out, duplicates removed and labels filled; ``after`` is `cleanup_job`'s result."""
    results = after.groupBy(scope).agg(
        F.count(F.lit(1)).alias("final_rows"),
        F.count_if(F.col("label_filled")).alias("labels_standardized"),
    )
    sums = ["original_rows", "final_rows", "labels_standardized"]
    stats = _job_statistics([_rows(before, scope, "original_rows"), results], scope, sums, overall)
    return stats.withColumn("duplicates_removed", F.col("original_rows") - F.col("final_rows"))
