"""Annotator labels: decoding, standardising, filling, BIO conversion and vocabulary checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemark.functions.labels import decode, flat_label, strip_bio
from pagemark.functions.text import is_blank, whole_number
from pagemark.operators.ordering import BLOCK_BITS, Prepare, indexed, with_previous
from pagemark.schemas import ANNOTATORS, annotator_column


def vocabulary(labels: DataFrame, label: str = "label") -> DataFrame:
    """Distinct non-blank labels in code-point order with their index from 0."""
    distinct = labels.select(F.col(label).alias("label")).filter(~is_blank("label", False)).distinct()
    return indexed(distinct, "label", "idx").select(F.col("idx").cast("int").alias("idx"), "label")


def decode_column(
    df: DataFrame, labels: list[str], missing: str, source: str = "pred", out: str | None = None
) -> DataFrame:
    """Replace class ids by labels; see `functions.decode`. Number columns are truncated first."""
    numeric = isinstance(df.schema[source].dataType, (T.DoubleType, T.FloatType, T.DecimalType))
    return df.withColumn(out or source, decode(source, labels, missing, numeric))


def decode_by_table(
    df: DataFrame, vocab: DataFrame, missing: str, source: str = "pred", out: str = "pred"
) -> DataFrame:
    """The same for a vocabulary that comes as a table (idx, label).

    The table has one row per model class; adaptive execution broadcasts it by its measured size.
    """
    lookup = vocab.select(
        F.col("idx").cast("bigint").alias("_idx"), "label"
    ).groupBy("_idx").agg(F.min("label").alias("_label"))
    number = whole_number(F.col(source).cast("string"))
    text = (
        F.when(F.col(source).isNull(), F.lit(missing))
        .when(F.col("_n").isNull(), F.col(source).cast("string"))
        .otherwise(F.coalesce("_label", F.concat(F.lit("UNK_"), F.col("_n").cast("string"))))
    )
    joined = df.withColumn("_n", number).join(lookup, F.col("_n") == F.col("_idx"), "left")
    return joined.withColumn(out, text).drop("_n", "_idx", "_label")


def flat_to_bio(
    df: DataFrame,
    keys: list[str],
    pos: str,
    label: str,
    out: str,
    bits: int = BLOCK_BITS,
    keep_block: bool = False,
    prepare: Prepare | None = None,
) -> DataFrame:
    """BIO tags of flat labels: a label equal to the previous one of its document continues it.

    ``keep_block`` leaves the column by which a step on the same blocks needs no exchange; ``prepare``
    as in `with_previous`.
    """

    def flat(rows: DataFrame) -> DataFrame:
        return (prepare(rows) if prepare else rows).withColumn("_flat", flat_label(label))

    tagged = with_previous(df, keys, pos, {"_before": "_flat"}, bits, keep_block, flat)
    tag = (
        F.when(F.col("_flat") == "O", F.lit("O"))
        .when(F.col("_flat") == F.col("_before"), F.concat(F.lit("I-"), "_flat"))
        .otherwise(F.concat(F.lit("B-"), "_flat"))
    )
    return tagged.withColumn(out, tag).drop("_flat", "_before")


def with_evaluation_labels(
    df: DataFrame,
    annotator: str = "annotator1",
    labels: list[str] | None = None,
    keys: list[str] = ("file",),
    pos: str = "pos",
    bio: bool = True,
    bits: int = BLOCK_BITS,
    keep_block: bool = False,
    prepare: Prepare | None = None,
) -> DataFrame:
    """Add ground_truth_flat and pred_flat and, with ``bio``, ground_truth_bio and pred_bio.

    A missing truth stays blank in flat mode, where such rows are left out, and counts as `O` in
    BIO mode. A prediction that was never decoded and is missing is `O` in flat mode and left out
    in BIO mode. These rules set the denominators of both modes. ``keep_block`` and ``prepare`` are
    handed to `flat_to_bio`.
    """
    truth = annotator_column(annotator)

    def judged(rows: DataFrame) -> DataFrame:
        rows = prepare(rows) if prepare else rows
        if labels:
            rows = decode_column(rows, labels, "UNK")
        return rows.withColumn("ground_truth_flat", F.col(truth)).withColumn("pred_flat", strip_bio("pred"))

    if not bio:
        return judged(df)
    tagged = flat_to_bio(df, list(keys), pos, truth, "ground_truth_bio", bits, keep_block, judged)
    return tagged.withColumn("pred_bio", F.col("pred"))


def standardise_annotator(df: DataFrame, annotator: str) -> DataFrame:
    """Fill the chosen annotator's blanks from the other one; adds `label_filled` per row."""
    target = annotator_column(annotator)
    other = annotator_column(next(a for a in ANNOTATORS if a != annotator))
    if target not in df.columns and other not in df.columns:
        return df.withColumn(target, F.lit("")).withColumn("label_filled", F.lit(False))
    if target not in df.columns:
        return df.withColumn(target, F.col(other)).withColumn("label_filled", F.lit(True))
    if other not in df.columns:
        return df.withColumn("label_filled", F.lit(False))
    fills = is_blank(target) & ~is_blank(other)
    return df.withColumn("label_filled", fills).withColumn(
        target, F.when(F.col("label_filled"), F.col(other)).otherwise(F.col(target))
    )


def fill_predictions(df: DataFrame, labels: list[str]) -> DataFrame:
    """Fill blank labels of both annotators with the decoded prediction; manual labels stay.

    Adds `annotator1_filled` and `annotator2_filled` per row.
    """
    if "pred" in df.columns:
        df = decode_column(df, labels, "O", out="_decoded")
    else:
        df = df.withColumn("_decoded", F.lit("O"))
    for annotator in ANNOTATORS:
        name = annotator_column(annotator)
        if name not in df.columns:
            df = df.withColumn(name, F.lit(""))
        df = df.withColumn(f"{annotator}_filled", is_blank(name)).withColumn(
            name, F.when(is_blank(name), F.col("_decoded")).otherwise(F.col(name))
        )
    return df.drop("_decoded")


def label_counts(df: DataFrame) -> DataFrame:
    """Rows per (annotator, label), blanks left out; counted per label pair before unpivoting."""
    columns = [annotator_column(a) for a in ANNOTATORS]
    pairs = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    sides = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("annotator"), F.col(c).alias("label"))
                for a, c in zip(ANNOTATORS, columns)
            ]
        )
    )
    return (
        pairs.select(sides.alias("s"), "n")
        .select("s.annotator", "s.label", "n")
        .filter(~is_blank("label"))
        .groupBy("annotator", "label")
        .agg(F.sum("n").alias("n"))
    )


def vocabulary_violations(df: DataFrame, labels: list[str]) -> DataFrame:
    """Labels outside the vocabulary with their row counts, per annotator."""
    return label_counts(df).filter(~F.col("label").isin(labels))


def vocabulary_violations_by_table(df: DataFrame, vocab: DataFrame) -> DataFrame:
    return label_counts(df).join(vocab.select("label").distinct(), "label", "left_anti")
