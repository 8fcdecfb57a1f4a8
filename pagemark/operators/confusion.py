"""Confusion counts and everything that follows from them.

Rows are read once into (scope, truth, prediction, n); reports, averages, page metrics, error
patterns and accuracies are sums over that far smaller frame. The counts combine inside each task
before the shuffle, so neither a frequent class nor a large document gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.functions.text import column, is_blank, ratio
from pagemark.operators.labels import decode_column, flat_to_bio, with_evaluation_labels
from pagemark.schemas import annotator_column
from pagemark.vocabularies import SCORED_LAYOUT


def label_combinations(
    df: DataFrame,
    scope: list[str] = (),
    columns: list[str] = ("annotator1_label", "annotator2_label", "pred"),
) -> DataFrame:
    """(scope…, columns…, n): rows per combination of raw labels.

    Decoding and comparing then touch combinations instead of rows.
    """
    return df.groupBy(*scope, *columns).agg(F.count(F.lit(1)).alias("n"))


def confusion(
    df: DataFrame, truth, pred, scope: list[str] = (), valid_only: bool = True, weight: str | None = None
) -> DataFrame:
    """(scope…, truth, pred, n). With ``valid_only`` rows lacking either label are left out.

    ``weight`` names the count column of a frame that is counted already. There the test for gaps
    sits inside the sum, as a filter would be pushed down and run on every row of the source.
    """
    truth, pred = column(truth).cast("string"), column(pred).cast("string")
    valid = ~is_blank(truth) & ~is_blank(pred)
    if weight is None:
        df = df.filter(valid) if valid_only else df
        n = F.count(F.lit(1))
    else:
        n = F.sum(F.when(valid, F.col(weight)) if valid_only else F.col(weight))
    counts = df.groupBy(*scope, truth.alias("truth"), pred.alias("pred")).agg(n.alias("n"))
    return counts if weight is None else counts.filter(F.col("n").isNotNull())


def flat_confusion(
    combinations: DataFrame, annotator: str, labels: list[str] | None, scope: list[str] = ()
) -> DataFrame:
    """Flat confusion counts of one annotator from `label_combinations`."""
    judged = with_evaluation_labels(combinations, annotator, labels, bio=False)
    return confusion(judged, "ground_truth_flat", "pred_flat", scope, weight="n")


def bio_confusion(
    df: DataFrame,
    annotator: str,
    labels: list[str] | None,
    keys: list[str],
    pos: str,
    scope: list[str] = (),
) -> DataFrame:
    """BIO confusion counts: the truth is tagged row by row, predictions are decoded per count."""
    tagged = flat_to_bio(df, keys, pos, annotator_column(annotator), "_truth")
    counts = label_combinations(tagged, scope, ["_truth", "pred"])
    if labels:
        counts = decode_column(counts, labels, "UNK")
    return confusion(counts, "_truth", "pred", scope, weight="n")


def with_overall(
    counts: DataFrame, scope: str, by: list[str], sums: list[str], overall: str = "all"
) -> DataFrame:
    """Add the scope ``overall`` to counts already grouped by (scope, by…).

    Grouping sets over the small counted frame instead of a rollup over the rows. ``level`` is
    `overall` or `group`, so a document that happens to be named ``overall`` cannot be mistaken.
    """
    sets = [[scope, *by], list(by)]
    out = counts.groupingSets(
        [[F.col(c) for c in s] for s in sets], scope, *by
    ).agg(F.grouping(scope).alias("_total"), *[F.sum(s).alias(s) for s in sums])
    return out.withColumn(
        "level", F.when(F.col("_total") == 1, "overall").otherwise("group")
    ).withColumn(
        scope, F.when(F.col("_total") == 1, F.lit(overall)).otherwise(F.col(scope))
    ).drop("_total")


def class_counts(counts: DataFrame, scope: list[str] = ()) -> DataFrame:
    """(scope…, label, tp, n_true, n_pred) over the union of true and predicted classes."""

    def part(label: Column, tp: Column, n_true: Column, n_pred: Column) -> Column:
        return F.struct(
            label.alias("label"),
            tp.cast("bigint").alias("tp"),
            n_true.cast("bigint").alias("n_true"),
            n_pred.cast("bigint").alias("n_pred"),
        )

    n, zero = F.col("n"), F.lit(0)
    parts = F.when(
        F.col("truth").eqNullSafe(F.col("pred")), F.array(part(F.col("truth"), n, n, n))
    ).otherwise(
        F.array(part(F.col("truth"), zero, n, zero), part(F.col("pred"), zero, zero, n))
    )
    return (
        counts.select(*scope, F.explode(parts).alias("_part"))
        .select(*scope, "_part.*")
        .groupBy(*scope, "label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "n_true", "n_pred")])
    )


def class_report(counts: DataFrame, scope: list[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a ratio has no denominator."""
    zero = F.lit(0.0)
    return class_counts(counts, scope).select(
        *scope,
        "label",
        F.coalesce(ratio("tp", "n_pred"), zero).alias("precision"),
        F.coalesce(ratio("tp", "n_true"), zero).alias("recall"),
        F.coalesce(ratio(F.col("tp") * 2, F.col("n_true") + F.col("n_pred")), zero).alias("f1"),
        F.col("n_true").alias("support"),
        "tp",
        "n_pred",
    )


def report_averages(report: DataFrame, scope: list[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted averages of a class report, one row per scope.

    Micro F1 equals accuracy, as every row has exactly one true and one predicted class.
    """
    scores = ["precision", "recall", "f1"]
    grouped = report.groupBy(*scope).agg(
        F.sum("tp").alias("correct"),
        F.sum("support").alias("total"),
        F.count(F.lit(1)).alias("classes"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[F.sum(F.col(s) * F.col("support")).alias(f"_w_{s}") for s in scores],
    )
    accuracy = F.coalesce(ratio("correct", "total"), F.lit(0.0))
    return grouped.select(
        *scope,
        accuracy.alias("accuracy"),
        accuracy.alias("micro_f1"),
        *[F.coalesce(f"macro_{s}", F.lit(0.0)).alias(f"macro_{s}") for s in scores],
        *[F.coalesce(ratio(f"_w_{s}", "total"), F.lit(0.0)).alias(f"weighted_{s}") for s in scores],
        F.coalesce("correct", F.lit(0)).cast("bigint").alias("correct"),
        F.coalesce("total", F.lit(0)).cast("bigint").alias("total"),
        F.col("classes").cast("bigint").alias("classes"),
    )


def accuracy(counts: DataFrame, scope: list[str] = ()) -> DataFrame:
    """Correct, total and accuracy per scope."""
    hit = F.when(F.col("truth").eqNullSafe(F.col("pred")), F.col("n")).otherwise(0)
    return (
        counts.groupBy(*scope)
        .agg(F.sum(hit).alias("correct"), F.sum("n").alias("total"))
        .select(
            *scope,
            F.coalesce(ratio("correct", "total"), F.lit(0.0)).alias("token_accuracy"),
            F.coalesce("total", F.lit(0)).cast("bigint").alias("total_tokens"),
            F.coalesce("correct", F.lit(0)).cast("bigint").alias("correct_predictions"),
        )
    )


def confusion_wide(counts: DataFrame, labels: list[str]) -> DataFrame:
    """One row per true class, one column per predicted class of ``labels``, 0 for no row.

    ``other`` holds predictions of any other class, so a row sums up to all rows of its class.
    """
    listed = F.coalesce(F.col("pred").isin(list(labels)), F.lit(False))
    columns = {label: F.col("pred").eqNullSafe(F.lit(label)) for label in labels}
    columns["other"] = ~listed
    zero = F.lit(0).cast("bigint")
    return counts.groupBy("truth").agg(
        *[F.coalesce(F.sum(F.when(test, F.col("n"))), zero).alias(c) for c, test in columns.items()]
    )


def page_metrics(counts: DataFrame, scope: str) -> DataFrame:
    """Tokens, accuracy and macro F1 per page (or file)."""
    return report_averages(class_report(counts, [scope]), [scope]).select(
        scope,
        F.col("total").alias("num_tokens"),
        "accuracy",
        F.col("macro_f1").alias("f1_macro"),
        "correct",
    )


def page_summary(pages: DataFrame) -> DataFrame:
    """Mean and population deviation over pages, perfect pages, tokens per page."""
    zero = F.lit(0.0)
    return pages.agg(
        F.coalesce(F.avg("accuracy"), zero).alias("page_accuracy_mean"),
        F.coalesce(F.stddev_pop("accuracy"), zero).alias("page_accuracy_std"),
        F.coalesce(F.avg("f1_macro"), zero).alias("page_f1_mean"),
        F.coalesce(F.stddev_pop("f1_macro"), zero).alias("page_f1_std"),
        F.count_if(F.col("correct") == F.col("num_tokens")).alias("pages_perfect_accuracy"),
        F.count(F.lit(1)).alias("total_pages"),
        F.coalesce(F.sum("num_tokens"), F.lit(0)).cast("bigint").alias("total_tokens"),
        F.coalesce(ratio(F.sum("num_tokens"), F.count(F.lit(1))), zero).alias("avg_tokens_per_page"),
    )


def low_score_pages(pages: DataFrame, below: float = 0.5) -> DataFrame:
    return pages.filter(F.col("accuracy") < below)


def worst_classes(report: DataFrame, k: int | None = 10) -> DataFrame:
    """The k classes with the lowest F1, ties by label; None for all."""
    ranked = report.orderBy("f1", "label")
    return ranked if k is None else ranked.limit(k)


def error_pairs(counts: DataFrame, k: int | None = 20) -> DataFrame:
    """Most frequent (truth, pred) mistakes; ties by truth, then prediction."""
    errors = (
        counts.filter(F.col("truth") != F.col("pred"))
        .groupBy("truth", "pred")
        .agg(F.sum("n").alias("n"))
    )
    ranked = errors.orderBy(F.col("n").desc(), "truth", "pred")
    return ranked if k is None else ranked.limit(k)


def confused_labels(counts: DataFrame, k: int | None = 10) -> DataFrame:
    """True labels with the most errors; ties by label; None for all."""
    ranked = (
        counts.filter(F.col("truth") != F.col("pred"))
        .groupBy("truth")
        .agg(F.sum("n").alias("errors"))
        .orderBy(F.col("errors").desc(), "truth")
    )
    return ranked if k is None else ranked.limit(k)


def error_rate(df: DataFrame, truth, pred, weight: str | None = None) -> DataFrame:
    """Errors among valid rows over all rows: the denominator also counts rows with a blank label."""
    truth, pred = column(truth), column(pred)
    n = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    wrong = ~is_blank(truth) & ~is_blank(pred) & (truth != pred)
    summed = df.agg(
        F.coalesce(F.sum(F.when(wrong, n)), F.lit(0)).alias("total_errors"), F.sum(n).alias("_n")
    )
    return summed.select(
        "total_errors", F.coalesce(ratio("total_errors", "_n"), F.lit(0.0)).alias("error_rate")
    )


def layout_accuracy(counts: DataFrame, elements: list[str] = SCORED_LAYOUT) -> DataFrame:
    """Accuracy of each layout element that occurs in the truth."""
    return accuracy(counts.filter(F.col("truth").isin(list(elements))), ["truth"])
