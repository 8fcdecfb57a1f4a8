"""Compare, append, export and list datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemark.schemas import require_columns


def _check_same_columns(left: DataFrame, right: DataFrame) -> None:
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")


def key_counts(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys…, n_left, n_right): rows per key on either side; NULL keys match each other.

    Both sides are stacked and counted by one aggregation, which also combines repeated keys before
    the shuffle. No join, so a key repeated on both sides never multiplies.
    """
    _check_same_columns(left, right)
    keys = list(keys or left.columns)
    require_columns(left, keys, "the datasets")
    stacked = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return stacked.groupBy(*keys).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))


def _side():
    return (
        F.when(F.col("n_right") == 0, "left_only")
        .when(F.col("n_left") == 0, "right_only")
        .otherwise("both")
    )


def _copies():
    return F.greatest("n_left", F.lit(1)) * F.greatest("n_right", F.lit(1))


def diff_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Differences over all columns: each different row once with its side.

    `copies` says how often a full outer join would list the row: n_left x n_right when both sides
    have it. Repeating the row that often would be quadratic in a frequent row.
    """
    return key_counts(left, right).withColumn("side", _side()).withColumn("copies", _copies())


def diff_rows_by_key(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Differences by key columns: every row of either dataset with `source`, the key's `side` and
    `partners`, the number of rows with its key in the other dataset."""
    counts = key_counts(left, right, keys).withColumn("side", _side())

    def marked(df: DataFrame, source: str, other: str) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
        joined = df.alias("d").join(counts.alias("c"), same)
        return joined.select(
            *[F.col(f"d.{c}") for c in df.columns],
            F.lit(source).alias("source"),
            F.col("c.side").alias("side"),
            F.col(f"c.{other}").alias("partners"),
        )

    return marked(left, "left", "n_right").unionAll(marked(right, "right", "n_left"))


def diff_summary(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Row counts of a full outer join by side and of both datasets, and distinct keys by side."""
    counted = key_counts(left, right, keys).withColumn("side", _side())
    names = {
        "only_in_left": F.sum(F.when(F.col("side") == "left_only", F.col("n_left"))),
        "only_in_right": F.sum(F.when(F.col("side") == "right_only", F.col("n_right"))),
        "common_rows": F.sum(F.when(F.col("side") == "both", _copies())),
        "rows_left": F.sum("n_left"),
        "rows_right": F.sum("n_right"),
        "joined_rows": F.sum(_copies()),
        "keys_only_left": F.count_if(F.col("side") == "left_only"),
        "keys_only_right": F.count_if(F.col("side") == "right_only"),
        "keys_common": F.count_if(F.col("side") == "both"),
    }
    totals = counted.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in names.items()])
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("count")) for n in names])
    return totals.select(F.explode(entries).alias("e")).select("e.metric", "e.count")


def strict_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Append two datasets with identical columns in the same order; duplicates stay.

    An empty side is left out unchecked, so it is looked at only when the columns differ.
    """
    if left.columns == right.columns:
        return left.unionAll(right)
    if left.isEmpty():
        return right
    if right.isEmpty():
        return left
    _check_same_columns(left, right)
    return left


def export_strict(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The chosen columns, all by default; an unknown one is an error."""
    if columns is None:
        return df
    return require_columns(df, columns, "the dataset").select(*columns)


def column_list(text: str) -> list[str]:
    """Column names of a comma-separated list."""
    return [c.strip() for c in text.split(",")]


def export_lenient(df: DataFrame, columns: list[str]) -> DataFrame | None:
    """The chosen columns that exist; None when there is none."""
    present = [c for c in columns if c in df.columns]
    return df.select(*present) if present else None


def export_status(datasets: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Per dataset: whether a lenient export works, exported and missing columns, rows."""
    parts = []
    for name, df in datasets.items():
        present = [c for c in columns if c in df.columns]
        missing = [c for c in columns if c not in df.columns]
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("dataset"),
                F.lit(bool(present)).alias("exported"),
                F.lit(",".join(present)).alias("columns"),
                F.lit(",".join(missing)).alias("missing"),
                F.when(F.lit(bool(present)), F.col("rows")).otherwise(0).alias("rows"),
            )
        )
    return reduce(DataFrame.unionAll, parts)


def catalogue(datasets: dict[str, DataFrame]) -> DataFrame:
    """Index, name, row count and columns of each dataset."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i).alias("idx"),
            F.lit(name).alias("dataset"),
            "rows",
            F.lit(",".join(df.columns)).alias("columns"),
            F.lit(len(df.columns)).alias("column_count"),
        )
        for i, (name, df) in enumerate(datasets.items())
    ]
    return reduce(DataFrame.unionAll, parts)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows by ``order``: each task keeps n rows before they meet."""
    return df.orderBy(*order).limit(n)


def distinct_ids(df: DataFrame, by: str, key: str) -> DataFrame:
    return df.select(by, key).distinct()
