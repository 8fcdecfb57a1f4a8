"""Overlapping boxes on a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Width and height of the finest cells, as powers of two, and the step from one level to the next.
CELL_BITS, STEP_BITS = 7, 2
_BOX = ["x1", "y1", "x2", "y2"]
# The level of width and that of height on which boxes of two classes meet.
_WIDE = "greatest(shiftright({0}_one, 4), shiftright({0}_two, 4))"
_HIGH = "greatest({0}_one & 15, {0}_two & 15)"


def _level(size):
    """A level whose cells are at least that wide, the finest or, by rounding, the next one."""
    steps = F.log2(size / (1 << CELL_BITS)) / STEP_BITS
    return F.greatest(F.ceil(steps), F.lit(0)).cast("int")


def _cell(column: str, level: str):
    return F.expr(f"cast(shiftright(cast({column} as bigint), {CELL_BITS} + {STEP_BITS} * {level}) as int)")


def box_cells(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Where boxes of a page meet: those with the same keys, `cx` (two classes and a column) and `cy`.

    A box has a level for its width and one for its height, which make its class. Boxes of two classes meet in
    the cells of the wider and of the higher level, of which a box touches four at most. So a box is filed once
    per class its page has, whatever its size, and boxes of like classes only meet where they are near.
    """
    long = [F.col(c).cast("bigint") for c in _BOX]
    leveled = boxes.withColumn("_lx", _level(long[2] - long[0])).withColumn("_ly", _level(long[3] - long[1]))
    classed = leveled.withColumn("_class", F.col("_lx") * 16 + F.col("_ly"))
    # asks for all columns of the counted boxes, so that their exchange serves here, too
    counted = F.when(F.col("n") > 0, F.col("_class"))
    present = classed.groupBy(*keys).agg(F.collect_set(counted).alias("_classes"))
    held = classed.join(present, keys)
    met = held.withColumn("_other", F.explode("_classes")).withColumns(
        {"_one": F.least("_class", "_other"), "_two": F.greatest("_class", "_other")}
    )
    wide, high = _WIDE.format(""), _HIGH.format("")
    columns = F.explode(F.sequence(_cell("x1", wide), _cell("x2", wide)))
    rows = F.explode(F.sequence(_cell("y1", high), _cell("y2", high)))
    cells = met.withColumn("_x", columns).withColumn("cy", rows)
    cells = cells.withColumn("cx", F.struct("_one", "_two", "_x"))
    kept = [*keys, "cx", "cy", "_class", *_BOX, "n"]
    return cells.select(*kept)


def box_overlaps(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of overlapping boxes on a page with intersection area and its share of the smaller box.

    Words with the same box are counted first and give one row with the number of word pairs. The
    different boxes of a page meet per cell of a hierarchical grid, and a pair is taken in the one cell
    that holds the upper left corner of the intersection: no page is paired as a whole, and a wide or high
    box is not filed in more cells than a small one. Boxes without width or height take no part. The first
    box of a pair is the one that comes first by y1, x1, y2, x2.
    """
    boxes = (
        tokens.filter((F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")))
        .groupBy(*keys, *_BOX)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    place = [*keys, "cx", "cy"]
    held = ["_class", *_BOX, "n"]
    # dealt once: both sides of the join read the same exchange
    cells = box_cells(boxes, keys).repartition(*place)
    left = cells.select(*place, *[F.col(c).alias(f"l_{c}") for c in held])
    right = cells.select(*place, *[F.col(c).alias(f"r_{c}") for c in held])
    l, r = (F.struct(*[f"{side}_{c}" for c in ("y1", "x1", "y2", "x2")]) for side in "lr")
    meets = (
        (F.col("l_x1") < F.col("r_x2"))
        & (F.col("r_x1") < F.col("l_x2"))
        & (F.col("l_y1") < F.col("r_y2"))
        & (F.col("r_y1") < F.col("l_y2"))
    )
    # boxes of one class meet in both orders; a box that several words have meets itself
    one, two = F.col("cx._one"), F.col("cx._two")
    taken = (one != two) | (l < r) | ((l == r) & (F.col("l_n") > 1))
    corner = (F.col("cx._x") == _cell("greatest(l_x1, r_x1)", _WIDE.format("cx."))) & (
        F.col("cy") == _cell("greatest(l_y1, r_y1)", _HIGH.format("cx."))
    )
    # said in one comparison of both sides, as filters of either one would part the exchange
    classes = F.col("l__class") * 256 + F.col("r__class") == one * 256 + two
    pairs = left.join(right, place).filter(classes & taken & meets & corner)
    swap = l > r
    pairs = pairs.select(
        *keys,
        *[F.when(swap, F.col(f"r_{c}")).otherwise(F.col(f"l_{c}")).alias(f"a_{c}") for c in [*_BOX, "n"]],
        *[F.when(swap, F.col(f"l_{c}")).otherwise(F.col(f"r_{c}")).alias(f"b_{c}") for c in [*_BOX, "n"]],
    )
    a, b = (F.struct(*[f"{side}_{c}" for c in ("y1", "x1", "y2", "x2")]) for side in "ab")
    n = F.col("a_n")
    found = pairs.select(
        *keys,
        *[f"a_{c}" for c in _BOX],
        *[f"b_{c}" for c in _BOX],
        F.when(a < b, n * F.col("b_n")).otherwise(F.shiftright(n * (n - 1), 1)).alias("word_pairs"),
    )

    def long(name: str):
        return F.col(name).cast("bigint")

    def area(side: str):
        return (long(f"{side}_x2") - long(f"{side}_x1")) * (long(f"{side}_y2") - long(f"{side}_y1"))

    shared = (F.least(long("a_x2"), long("b_x2")) - F.greatest(long("a_x1"), long("b_x1"))) * (
        F.least(long("a_y2"), long("b_y2")) - F.greatest(long("a_y1"), long("b_y1"))
    )
    return (
        found.withColumn("overlap_area", shared)
        .withColumn(
            "overlap_share",
            F.try_divide(
                F.col("overlap_area").cast("double"), F.least(area("a"), area("b")).cast("double")
            ),
        )
    )


def overlap_summary(overlaps: DataFrame, keys: list[str]) -> DataFrame:
    """Per page: overlapping pairs of boxes, pairs of words in them, overlap area, largest share."""
    return overlaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("box_pairs"),
        F.sum("word_pairs").alias("word_pairs"),
        F.sum(F.col("word_pairs") * F.col("overlap_area")).alias("overlap_area"),
        F.max("overlap_share").alias("largest_share"),
    )
