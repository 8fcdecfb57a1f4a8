"""Agreement of two annotators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemark.functions.text import column, is_blank, ratio
from pagemark.schemas import annotator_column


def label_pairs(
    df: DataFrame,
    first=annotator_column("annotator1"),
    second=annotator_column("annotator2"),
    scope: list[str] = (),
    include_unlabelled: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """(scope…, label1, label2, n) of rows both annotators labelled.

    ``include_unlabelled`` keeps the others too, a gap being the label `nan`. ``weight`` names the
    count column of a frame that is counted already.
    """
    one, two = column(first).cast("string"), column(second).cast("string")
    if include_unlabelled:
        one = F.when(is_blank(one), F.lit("nan")).otherwise(one)
        two = F.when(is_blank(two), F.lit("nan")).otherwise(two)
    else:
        df = df.filter(~is_blank(one) & ~is_blank(two))
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*scope, one.alias("label1"), two.alias("label2")).agg(n.alias("n"))


def kappa(pairs: DataFrame, scope: list[str] = ()) -> DataFrame:
    """Cohen's kappa and agreement share per scope; NaN where chance agreement is certain.

    The label marginals of both annotators come out of one aggregation over the pair counts.
    """
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    agreed = F.when(F.col("label1") == F.col("label2"), n).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("label1").alias("label"),
            n.alias("n1"),
            zero.alias("n2"),
            agreed.alias("agree"),
            n.alias("total"),
        ),
        F.struct(
            F.col("label2").alias("label"),
            zero.alias("n1"),
            n.alias("n2"),
            zero.alias("agree"),
            zero.alias("total"),
        ),
    )
    marginals = (
        pairs.select(*scope, F.explode(sides).alias("_side"))
        .select(*scope, "_side.*")
        .groupBy(*scope, "label")
        .agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "agree", "total")])
    )
    summed = marginals.groupBy(*scope).agg(
        F.sum("agree").alias("agreement_count"),
        F.sum("total").alias("total_dual_annotations"),
        F.sum(F.col("n1").cast("double") * F.col("n2").cast("double")).alias("_chance"),
    )
    total = F.col("total_dual_annotations").cast("double")
    room = total * total - F.col("_chance")
    score = F.when(room == 0, F.lit(float("nan"))).otherwise(
        F.try_divide(F.col("agreement_count") * total - F.col("_chance"), room)
    )
    return summed.filter(F.col("total_dual_annotations") > 0).select(
        *scope,
        score.alias("kappa_score"),
        ratio("agreement_count", "total_dual_annotations").alias("agreement_percentage"),
        "total_dual_annotations",
        "agreement_count",
    )


def disagreements(pairs: DataFrame, scope: list[str] = ()) -> DataFrame:
    """How often the annotators gave each pair of different labels."""
    return (
        pairs.filter(F.col("label1") != F.col("label2"))
        .groupBy(*scope, "label1", "label2")
        .agg(F.sum("n").alias("n"))
    )
