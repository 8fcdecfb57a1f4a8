"""What the training-data operators share: tables on the shared folder, hashing, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` computed once: written under `spark.checkpoint.dir`, which all executors share, and reread.

    A lost executor then costs a reread of files, not a run of everything before.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name` with as many underscores before it as no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) drawn from the parts' text; equal parts give equal numbers, anywhere."""
    return draw(*parts).cast("double") / F.lit(float(1 << 52))


def draw(*parts: Column) -> Column:
    """52 hashed bits of the parts' text as a long; a NULL part counts as the text `null`."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of `edges(a, b)`: columns `node`, `root`.

    Alternating large-star and small-star rounds: every round groups and joins by node, so the work
    of a round is a few shuffles of the edge list, and no neighbourhood is gathered anywhere. The
    list is written to the shared folder after each round. NULL ends are ignored.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        links = stored(small, "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
