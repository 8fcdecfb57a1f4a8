"""Page selection, reconciliation and the annotation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.functions.boxes import COORDINATES, box_parts, confidence_band, part_coordinate
from pagemark.operators.dedup import collapse_top_k
from pagemark.operators.ordering import Prepare, ranked
from pagemark.schemas import ANNOTATORS, annotator_column

PAGE_KEY = ["case_id", "page_id"]


def page_tokens(tokens: DataFrame, pages: DataFrame, keys: list[str] = PAGE_KEY) -> DataFrame:
    """Tokens of the listed pages in one scan.

    A semi join, as listing a page twice must not double its rows. Adaptive execution broadcasts
    the list when its measured size allows and splits a hot page of the token side otherwise.
    """
    return tokens.join(pages.select(*keys), keys, "left_semi")


def with_coordinates(tokens: DataFrame) -> DataFrame:
    """Insert x1, y1, x2, y2 right after `bboxes`.

    A box text is parsed once per row: filters and sums that name coordinates are merged with the
    projection that makes them, but stay above an `explode`, here of one item.
    """
    if "bboxes" not in tokens.columns:
        return tokens
    parsed = tokens.select("*", F.explode(F.array(box_parts("bboxes"))).alias("_parts"))
    columns: list = []
    for name in tokens.columns:
        if name not in COORDINATES:
            columns.append(F.col(name))
        if name == "bboxes":
            columns += [part_coordinate("_parts", i).alias(c) for i, c in enumerate(COORDINATES)]
    return parsed.select(*columns)


def reading_order(
    tokens: DataFrame,
    pos: str = "pos",
    keys: list[str] = PAGE_KEY,
    out: str = "reading_pos",
    prepare: Prepare | None = None,
) -> DataFrame:
    """Number the words of a page top to bottom, then left to right; words without a box last.

    ``prepare`` makes the words from the tokens, page by page, such as their collapse.
    """
    return ranked(tokens, keys, ["y1", "x1"], pos, out, prepare=prepare)


def annotation_table(
    tokens: DataFrame,
    pages: DataFrame | None = None,
    pos: str = "pos",
    word_key: list[str] | None = None,
    keys: list[str] = PAGE_KEY,
    tie_order: list[str] | None = None,
) -> DataFrame:
    """Tokens of the listed pages, collapsed, with coordinates, reading position, and two empty
    annotator columns at the end. ``tie_order`` settles ties of the collapse, ``pos`` by default."""
    chosen = tokens if pages is None else page_tokens(tokens, pages, keys)

    def words(rows: DataFrame) -> DataFrame:
        return with_coordinates(collapse_top_k(rows, tie_order or [pos], word_key))

    return with_annotator_columns(reading_order(chosen, pos, keys, prepare=words))


def with_annotator_columns(df: DataFrame) -> DataFrame:
    """Empty label columns for both annotators at the end."""
    return df.withColumns({annotator_column(a): F.lit("") for a in ANNOTATORS})


def document_name(case_id="case_id", page_id="page_id") -> Column:
    """Name of a page's annotation document."""
    return F.concat_ws("_", F.col(case_id), F.col(page_id))


def confidence_counts(tokens: DataFrame, by: list[str] = ()) -> DataFrame:
    return tokens.groupBy(*by, confidence_band("prob").alias("band")).agg(
        F.count(F.lit(1)).alias("n")
    )


def page_reconciliation(
    pages: DataFrame,
    token_pages: DataFrame | None = None,
    cases: DataFrame | None = None,
    token_cases: DataFrame | None = None,
    images: DataFrame | None = None,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """Why a listed page got no annotation document: the first reason that holds, else `ok`.

    `cases`, `token_cases` and `unreadable` hold `case_id`; `images` and `token_pages` hold page
    keys; a check whose table is not given passes. Each table is reduced to distinct keys before its
    join, so only the page side can be skewed, and adaptive execution splits that.
    """
    checks = [
        ("case_missing", cases, ["case_id"], False),
        ("tokens_missing", token_cases, ["case_id"], False),
        ("image_missing", images, PAGE_KEY, False),
        ("unreadable", unreadable, ["case_id"], True),
        ("no_rows", token_pages, PAGE_KEY, False),
    ]
    out, reasons = pages, []
    for reason, known, keys, found_is_bad in checks:
        if known is None:
            continue
        mark = f"_{reason}"
        out = out.join(known.select(*keys).distinct().withColumn(mark, F.lit(True)), keys, "left")
        found = F.col(mark).isNotNull()
        reasons.append(F.when(found if found_is_bad else ~found, reason))
    return out.select(*pages.columns, F.coalesce(*reasons, F.lit("ok")).alias("status"))


def id_reconciliation(listed: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Ids on both sides, listed only (missing) and found only (extra), one row per distinct id.

    The two id lists are stacked and folded by one aggregation, so repeated ids never meet in a
    join.
    """
    sides = listed.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        found.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        sides.groupBy(key)
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
        .select(
            key,
            F.when((F.col("_l") == 1) & (F.col("_r") == 1), "match")
            .when(F.col("_l") == 1, "missing")
            .otherwise("extra")
            .alias("side"),
        )
    )


def id_samples(reconciled: DataFrame, key: str, side: str, n: int = 5) -> DataFrame:
    """A few ids of one side, the first by name."""
    return reconciled.filter(F.col("side") == side).orderBy(key).limit(n)


def image_manifest(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Source path, presence, destination name and failure reason of each page's image.

    `images` is `scan_images`' output: case_id, page_id, path, length.
    """
    # of several images of a page, the first by path
    first = F.min(F.struct("path", "length")).alias("_image")
    known = images.groupBy(*PAGE_KEY).agg(first).select(*PAGE_KEY, "_image.*")
    destination = F.concat(document_name(), F.lit(".jpeg"))
    return pages.select(*PAGE_KEY).join(known, PAGE_KEY, "left").select(
        *PAGE_KEY,
        "path",
        "length",
        destination.alias("file_name"),
        F.when(F.col("path").isNull(), "image_missing").alias("reason"),
    )


def conformance(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows checked and violating rows per named rule, in one pass."""
    checks = [
        F.count_if(~F.coalesce(test, F.lit(False))).alias(f"_{i}")
        for i, test in enumerate(rules.values())
    ]
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *checks)
    listing = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("violations"))
                for i, name in enumerate(rules)
            ]
        )
    )
    return counted.select(F.col("_n").alias("checked"), listing.alias("_r")).select(
        "_r.rule", "checked", "_r.violations"
    )


# The form of case ids and page ids.
CASE_ID_PATTERN = r"^1-1[0-9][A-Z0-9]{6}$"
PAGE_ID_PATTERN = r"^[0-9]{10}_[0-9]{2}_[0-9]$"
