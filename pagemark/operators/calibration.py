"""How probabilities and positions relate to mistakes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemark.functions.boxes import confidence_band
from pagemark.functions.text import column, is_blank, ratio


def calibration_bins(df: DataFrame, truth, pred, prob="prob", bins: int = 10) -> DataFrame:
    """Rows, share correct and mean probability per non-empty uniform bin, closed on the right."""
    truth, pred, p = column(truth), column(pred), column(prob)
    number = F.greatest(F.ceil(p * bins).cast("int") - 1, F.lit(0))
    return (
        df.filter(~is_blank(truth) & ~is_blank(pred) & p.isNotNull() & ~F.isnan(p))
        .groupBy(number.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(truth == pred).alias("correct"),
            F.sum(p).alias("_p"),
        )
        .select(
            "bin",
            "n",
            ratio("correct", "n").alias("fraction_correct"),
            ratio("_p", "n").alias("mean_predicted"),
        )
    )


def calibration_error(bins: DataFrame) -> DataFrame:
    """Unweighted mean gap between confidence and accuracy over the non-empty bins."""
    gap = F.abs(F.col("fraction_correct") - F.col("mean_predicted"))
    return bins.agg(F.avg(gap).alias("ece"), F.count(F.lit(1)).alias("bins"))


def errors_by_band(df: DataFrame, truth, pred) -> DataFrame:
    """Rows and errors per confidence band."""
    truth, pred = column(truth), column(pred)
    return (
        df.filter(~is_blank(truth) & ~is_blank(pred))
        .groupBy(confidence_band("prob").alias("band"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(truth != pred).alias("errors"))
    )


def page_quadrant(middle: int = 500):
    """Quarter of the page a box's corner lies in, on the 1..1000 grid."""
    vertical = F.when(F.col("y1") <= middle, "top").otherwise("bottom")
    horizontal = F.when(F.col("x1") <= middle, "left").otherwise("right")
    known = F.col("x1").isNotNull() & F.col("y1").isNotNull()
    return F.when(known, F.concat_ws("-", vertical, horizontal)).otherwise("unknown")


def errors_by_quadrant(df: DataFrame, truth, pred) -> DataFrame:
    truth, pred = column(truth), column(pred)
    return (
        df.filter(~is_blank(truth) & ~is_blank(pred))
        .groupBy(page_quadrant().alias("quadrant"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(truth != pred).alias("errors"))
    )
