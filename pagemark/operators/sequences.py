"""Entity spans of BIO tag sequences and their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemark.functions.labels import bio_type
from pagemark.functions.text import is_blank, ratio
from pagemark.operators.confusion import with_overall
from pagemark.operators.ordering import (
    BLOCK_BITS,
    Prepare,
    with_previous,
    with_row_number,
    with_span_starts,
)


def _held(df: DataFrame) -> list[str]:
    return ["_block"] if "_block" in df.columns else []


def _span_starts(
    df: DataFrame, keys: list[str], pos: str, tags: list[str], bits: int, made: Prepare
) -> DataFrame:
    """Span starts of prepared rows; rows that come with a `_block` are prepared first, and it is taken."""
    if "_block" in df.columns:
        return with_span_starts(made(df), keys, pos, tags, bits)
    return with_span_starts(df, keys, pos, tags, bits, made)


def entity_spans(
    df: DataFrame,
    keys: list[str],
    pos: str,
    tag: str,
    bits: int = BLOCK_BITS,
    prepare: Prepare | None = None,
) -> DataFrame:
    """(keys…, entity_type, start, end, tokens): start and end are positions of the document.

    ``prepare`` as in `with_span_starts`.
    """

    def tagged(rows: DataFrame) -> DataFrame:
        made = prepare(rows) if prepare else rows
        return made.select(*keys, pos, tag, *_held(made))

    starts = _span_starts(df, keys, pos, [tag], bits, tagged)
    inside = starts.filter(F.col(f"{tag}_start").isNotNull())
    return inside.groupBy(
        *keys, bio_type(tag).alias("entity_type"), F.col(f"{tag}_start").alias("start")
    ).agg(F.max(pos).alias("end"), F.count(F.lit(1)).alias("tokens"))


def numbered_spans(
    df: DataFrame, keys: list[str], pos: str, tag: str, bits: int = BLOCK_BITS
) -> DataFrame:
    """Spans with 0-based indices of the rows that carry a tag, whatever gaps ``pos`` has."""
    tagged = df.filter(~is_blank(tag)).select(*keys, pos, tag)
    numbered = with_row_number(tagged, keys, pos, "_row", bits)
    numbered = numbered.withColumn("_row", F.col("_row") - 1)
    return entity_spans(numbered, keys, "_row", tag, bits)


def span_counts(
    df: DataFrame,
    keys: list[str],
    pos: str,
    truth: str,
    pred: str,
    bits: int = BLOCK_BITS,
    prepare: Prepare | None = None,
) -> DataFrame:
    """(entity_type, tp, n_true, n_pred): true, predicted and exactly matching spans.

    Rows lacking a tag leave the sequence first, so their neighbours meet. A true and a predicted
    span match when type, start and end agree; as one span starts at a position at most, grouping by
    (document, type, start) and comparing the ends replaces the span join. ``prepare`` as in
    `with_span_starts`.
    """

    def valid(rows: DataFrame) -> DataFrame:
        made = prepare(rows) if prepare else rows
        return made.filter(~is_blank(truth) & ~is_blank(pred)).select(
            *keys, pos, F.col(truth).alias("truth"), F.col(pred).alias("pred"), *_held(made)
        )

    starts = _span_starts(df, keys, pos, ["truth", "pred"], bits, valid)

    def side(name: str, other: str):
        return F.struct(
            bio_type(name).alias("entity_type"),
            F.col(f"{name}_start").alias("start"),
            F.col(pos).alias(f"{name}_at"),
            F.lit(None).cast(starts.schema[pos].dataType).alias(f"{other}_at"),
        )

    as_pred = side("pred", "truth")
    rows = starts.select(
        *keys,
        F.explode(
            F.array(
                side("truth", "pred"),
                F.struct(
                    as_pred["entity_type"].alias("entity_type"),
                    as_pred["start"].alias("start"),
                    as_pred["truth_at"].alias("truth_at"),
                    as_pred["pred_at"].alias("pred_at"),
                ),
            )
        ).alias("_side"),
    ).select(*keys, "_side.*")
    ends = (
        rows.filter(F.col("start").isNotNull())
        .groupBy(*keys, "entity_type", "start")
        .agg(F.max("truth_at").alias("truth_end"), F.max("pred_at").alias("pred_end"))
    )
    return ends.groupBy("entity_type").agg(
        F.count_if(F.col("truth_end") == F.col("pred_end")).alias("tp"),
        F.count("truth_end").alias("n_true"),
        F.count("pred_end").alias("n_pred"),
    )


def span_scores(counts: DataFrame) -> DataFrame:
    """Per type, then micro, macro and weighted averages, one row each (`scope`, `entity_type`).

    The averages come from one grouping over a column telling the row's role, so the counts are
    aggregated once.
    """
    zero = F.lit(0.0)
    typed = counts.select(
        "entity_type",
        "tp",
        "n_true",
        "n_pred",
        F.coalesce(ratio("tp", "n_pred"), zero).alias("precision"),
        F.coalesce(ratio("tp", "n_true"), zero).alias("recall"),
        F.coalesce(ratio(F.col("tp") * 2, F.col("n_true") + F.col("n_pred")), zero).alias("f1"),
    )
    scores = ["precision", "recall", "f1"]
    totals = typed.agg(
        *[F.sum(c).alias(c) for c in ("tp", "n_true", "n_pred")],
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[F.sum(F.col(s) * F.col("n_true")).alias(f"_w_{s}") for s in scores],
    )

    def average(name: str, p, r, f) -> "F.Column":
        return F.struct(
            F.lit(name).alias("scope"),
            F.coalesce(p, zero).alias("precision"),
            F.coalesce(r, zero).alias("recall"),
            F.coalesce(f, zero).alias("f1"),
        )

    averages = totals.select(
        F.explode(
            F.array(
                average(
                    "micro",
                    ratio("tp", "n_pred"),
                    ratio("tp", "n_true"),
                    ratio(F.col("tp") * 2, F.col("n_true") + F.col("n_pred")),
                ),
                average("macro", *[F.col(f"macro_{s}") for s in scores]),
                average("weighted", *[ratio(f"_w_{s}", "n_true") for s in scores]),
            )
        ).alias("a"),
        F.coalesce("n_true", F.lit(0)).cast("bigint").alias("support"),
    ).select("a.scope", F.lit(None).cast("string").alias("entity_type"), "a.precision", "a.recall",
             "a.f1", "support")
    return typed.select(
        F.lit("type").alias("scope"), "entity_type", *scores, F.col("n_true").alias("support")
    ).unionByName(averages)


def sequence_accuracy(df: DataFrame, keys: list[str], truth: str, pred: str) -> DataFrame:
    """Share of equal tags over all valid rows, and the number of documents that have any."""
    valid = df.filter(~is_blank(truth) & ~is_blank(pred))
    per_document = valid.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth) == F.col(pred)).alias("hit")
    )
    return per_document.agg(F.sum("hit").alias("hit"), F.sum("n").alias("n"),
                            F.count(F.lit(1)).alias("total_sequences")).select(
        F.coalesce(ratio("hit", "n"), F.lit(0.0)).alias("sequence_accuracy"), "total_sequences"
    )


def label_transitions(
    df: DataFrame,
    keys: list[str],
    pos: str,
    truth: str,
    pred: str,
    bits: int = BLOCK_BITS,
    prepare: Prepare | None = None,
) -> DataFrame:
    """Per document: label changes from word to word, and how many the prediction shares.

    The share of equal (previous, current) label pairs is this library's reading-order similarity.
    ``prepare`` as in `with_previous`.
    """

    def valid(rows: DataFrame) -> DataFrame:
        made = prepare(rows) if prepare else rows
        return made.filter(~is_blank(truth) & ~is_blank(pred)).select(
            *keys, pos, F.col(truth).alias("truth"), F.col(pred).alias("pred")
        )

    paired = with_previous(
        df, keys, pos, {"truth_before": "truth", "pred_before": "pred"}, bits, prepare=valid
    ).filter(F.col("truth_before").isNotNull())
    same = (F.col("truth") == F.col("pred")) & (F.col("truth_before") == F.col("pred_before"))
    return paired.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transitions"), F.count_if(same).alias("equal")
    )


def reading_order_similarity(transitions: DataFrame, scope: str, overall: str = "all") -> DataFrame:
    """Share of label changes the prediction has too, per document and overall (`level`)."""
    counts = with_overall(transitions, scope, [], ["transitions", "equal"], overall)
    share = F.coalesce(ratio("equal", "transitions"), F.lit(0.0))
    return counts.select("level", scope, "transitions", "equal", share.alias("similarity"))
