"""Bounding boxes written as text, word probabilities and page geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemark.functions.text import column, real_number

# Four non-negative integers in parentheses, anywhere in the text.
BOX_PATTERN = r"\((\s*\d+\s*,\s*\d+\s*,\s*\d+\s*,\s*\d+\s*)\)"
COORDINATES = ("x1", "y1", "x2", "y2")
HIGH_CONFIDENCE = 0.8
MEDIUM_CONFIDENCE = 0.5


def box_parts(bboxes) -> Column:
    """The four coordinate texts of a box text; one empty text when it holds no box, NULL for NULL."""
    return F.split(F.regexp_extract(column(bboxes), BOX_PATTERN, 1), ",")


def part_coordinate(parts, index: int) -> Column:
    """One coordinate of what `box_parts` gives; NULL without a box."""
    part = F.get(column(parts), F.lit(index))
    return F.when(part != "", part.try_cast("int"))


def box_coordinate(bboxes, index: int) -> Column:
    """One coordinate of a box text; NULL when the text holds no box.

    One regular expression per row finds the box and the split is shared by all four coordinates
    through common-subexpression elimination, as long as they stay in one projection: filters and sums
    over coordinates repeat the parse for each one they name (`operators.pages.with_coordinates` does not).
    """
    return part_coordinate(box_parts(bboxes), index)


def box_coordinates(bboxes) -> list[Column]:
    return [box_coordinate(bboxes, i).alias(n) for i, n in enumerate(COORDINATES)]


def ranking_probability(prob, text: bool = True) -> Column:
    """Probability used for ranking: text that is no number, NULL and NaN count as 0."""
    value = real_number(prob) if text else column(prob).cast("double")
    return F.nanvl(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def confidence_band(prob) -> Column:
    p = column(prob)
    return (
        F.when(p > HIGH_CONFIDENCE, "high").when(p >= MEDIUM_CONFIDENCE, "medium").otherwise("low")
    )


def inside_region(x1: int, y1: int, x2: int, y2: int) -> Column:
    """Whether a row's box lies wholly in the region."""
    return (F.col("x1") >= x1) & (F.col("y1") >= y1) & (F.col("x2") <= x2) & (F.col("y2") <= y2)


def within_coordinate_range(low: int = 1, high: int = 1000) -> Column:
    test = F.lit(True)
    for name in COORDINATES:
        test = test & F.col(name).between(low, high)
    return F.coalesce(test, F.lit(False))
