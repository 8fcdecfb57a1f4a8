"""Tables on disk. Nothing is ever written over a path that may still be read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.operators.tracking import annotator_view


def _write_partitioned(df: DataFrame, path: str, by: list[str], order: list[str]) -> None:
    # REBALANCE brings a partition's rows together for few files, and splits an oversized one
    df.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, *order).write.mode(
        "errorifexists"
    ).partitionBy(*by).parquet(path)


def write_annotations(
    df: DataFrame,
    path: str,
    order: list[str] = ("reading_pos",),
    by: list[str] = ("case_id",),
) -> None:
    """Annotation documents, one folder per case, sorted by page and reading order in its files.

    ``by=["case_id", "page_id"]`` makes the folder per page that annotators are handed; that is for
    small sets, as a large corpus has too many pages for folders.
    """
    rest = [c for c in ("case_id", "page_id") if c not in by]
    _write_partitioned(df, path, list(by), [*rest, *order])


def write_annotator_views(assignments: DataFrame, path: str) -> None:
    """Each annotator's assignments, one partition per annotator and case."""
    view = annotator_view(assignments).withColumn("annotator", F.col("assignee"))
    _write_partitioned(view, path, ["annotator", "case_id"], ["page_id"])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write a new version of a table (`root/version=N`); an existing one is an error."""
    path = f"{root}/version={int(version)}"
    write_csv(df, path)
    return path


def latest_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of a table: the folders are listed, and one of them is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [status.getPath().getName() for status in listed if status.isDirectory()]
    versions = [int(n.removeprefix("version=")) for n in names if re.fullmatch(r"version=\d+", n)]
    if not versions:
        raise FileNotFoundError(f"no version of a table in {root}")
    newest = f"{root}/version={max(versions)}"
    return spark.read.option("header", True).option("escape", '"').csv(newest)
