"""Keep one row per key.

All of these are ``row_number() = 1``: Spark then cuts each key to one row per task before the
shuffle (window group limit), so a key holding a third of the rows moves a row per task only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemark.functions.boxes import ranking_probability

PAGE_WORD_KEY = ["case_id", "page_id", "block_ids", "word_ids", "bboxes"]
# Row order a scan or the reading order has added; no two rows agree on them.
POSITION_COLUMNS = ("pos", "reading_pos", "ord")
WORD_TEXT_KEY = ["case_id", "page_id", "block_ids", "word_ids", "words", "bboxes"]


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranking)).filter(F.col("_rank") == 1).drop("_rank")
    )


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def _probability(df: DataFrame) -> Column:
    return ranking_probability("prob", isinstance(df.schema["prob"].dataType, T.StringType))


def collapse_top_k(df: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """One row per word position: highest probability, then a prediction equal to the label, then
    the prediction first in the alphabet, then the row order. Without `prob` nothing is collapsed."""
    keys = _present(df, keys or PAGE_WORD_KEY)
    if "prob" not in df.columns or not keys:
        return df
    ranking: list[Column] = [_probability(df).desc()]
    if "pred" in df.columns:
        if "labels" in df.columns:
            ranking.append(F.coalesce(F.col("pred") == F.col("labels"), F.lit(False)).desc())
        ranking.append(F.col("pred").asc_nulls_first())
    return keep_first(df, keys, [*ranking, *order])


def collapse_top_k_by_word(
    df: DataFrame, order: list[str], keys: list[str] | None = None
) -> DataFrame:
    """As above with the word text in the key: highest probability, the first row on ties. Rows
    with a NULL key column are dropped; `count_null_keys` tells how many."""
    keys = _present(df, keys or WORD_TEXT_KEY)
    if "prob" not in df.columns or not keys:
        return df
    complete = df.dropna(subset=keys)
    return keep_first(complete, keys, [_probability(df).desc(), *order])


def count_null_keys(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = _present(df, keys or WORD_TEXT_KEY)
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    return df.agg(F.count_if(incomplete).alias("rows_with_null_key"))


def duplicate_key_columns(df: DataFrame, order: list[str] = ()) -> list[str]:
    """All columns but the annotators' and the row-order ones."""
    left_out = {"annotator1_labels", "annotator2_labels", *POSITION_COLUMNS, *order}
    return [c for c in df.columns if not c.endswith("_label") and c not in left_out]


def drop_duplicates_first(
    df: DataFrame, order: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Drop rows repeating an earlier one on the key columns (NULLs are equal), keep the first."""
    keys = _present(df, keys) if keys is not None else duplicate_key_columns(df, order)
    if not keys:
        return df
    return keep_first(df, keys, list(order))
