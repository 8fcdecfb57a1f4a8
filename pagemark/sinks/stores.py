"""Tables kept in buckets of cases: a part is read or replaced without touching the rest.

A store lies at `path/buckets=N/bucket=B/`. The bucket of a row is the hash of its case modulo N, so their
number is fixed when the store is written, whatever the number of cases, and is read from the folder again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.operators.tracking import apply_updates, rejected_updates, status_known
from pagemark.schemas import resolve_page_id
from pagemark.session import written

BUCKETS = 256


def _bucket(case: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(case), F.lit(buckets)).cast("int")


def write_store(df: DataFrame, path: str, buckets: int = BUCKETS, order: list[str] = ("page_id",)) -> None:
    """Write a table by buckets of `case_id`, sorted by case and ``order`` in its files.

    A bucket too large for a task is split over several files; so is a case that holds a large part of it.
    """
    by = ["buckets", "bucket"]
    cut = df.withColumns({"buckets": F.lit(buckets), "bucket": _bucket(F.col("case_id"), buckets)})
    rows = cut.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, "case_id", *order)
    rows.write.mode("errorifexists").partitionBy(*by).parquet(path)


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    df = spark.read.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    names = [s.getPath().getName() for s in listed if s.getPath().getName().startswith("buckets=")]
    if len(names) != 1:
        raise ValueError(f"{path} is no store")
    return df, int(names[0].partition("=")[2])


def _touched(cases: DataFrame, buckets: int) -> list[int]:
    """Buckets of the given cases: as many numbers as the store has buckets, at most."""
    return sorted(r[0] for r in cases.select(_bucket(F.col("case_id"), buckets)).distinct().collect())


def scan_store(spark: SparkSession, path: str, pages: DataFrame | None = None) -> DataFrame:
    """The rows of a store, or those of the listed pages (`case_id`, and `page_id` if it is there).

    The page list is read for the buckets of its cases first, and only these folders are scanned.
    """
    df, buckets = _stored(spark, path)
    if pages is not None:
        keys = [c for c in ("case_id", "page_id") if c in pages.columns]
        df = df.where(F.col("bucket").isin(_touched(pages, buckets)))
        df = df.join(pages.select(*keys), keys, "left_semi")
    return df.drop("buckets", "bucket")


def update_store(spark: SparkSession, path: str, updates: DataFrame) -> dict[str, DataFrame]:
    """Apply a batch of status updates to a store of assignments: `applied` and `rejected_updates`.

    Only the buckets with valid updates are read. Their merged rows are written to the shared folder first,
    and then replace these buckets; the files of all other buckets stay. If the job fails in between, the
    batch can be applied again: the result is the same.
    """
    df, buckets = _stored(spark, path)
    updates = resolve_page_id(updates)
    wanted = _touched(updates.where(status_known(["status"])), buckets)
    current = df.where(F.col("bucket").isin(wanted))
    merged = apply_updates(current.drop("buckets", "bucket"), updates)
    merged = merged.withColumns({"buckets": F.lit(buckets), "bucket": _bucket(F.col("case_id"), buckets)})
    merged = written(merged, "assignments")
    by = ["buckets", "bucket"]
    rows = merged.drop("slot_writes").hint("rebalance", *[F.col(c) for c in by])
    (
        rows.sortWithinPartitions(*by, "case_id", "page_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return {
        "applied": merged.agg(F.coalesce(F.sum("slot_writes"), F.lit(0)).alias("applied_updates")),
        "rejected_updates": rejected_updates(updates),
    }
