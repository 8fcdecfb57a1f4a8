"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.llm.common import draw, uniform

#: Sources up to this number are joined as a broadcast; more go through a shuffle.
BROADCAST_SOURCES = 10_000


def repetition_rates(
    docs: DataFrame, weights: dict[str, float] | None, total: float | None, flatten: float
) -> DataFrame:
    """Per source: rows, target share, and rate = mean number of copies of a document."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("size"))
    if weights is not None and not weights:
        share = F.lit(0.0)
    elif weights is None:
        share = F.pow(F.col("size").cast("double"), F.lit(flatten))
    else:
        known = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, float(w))])
        share = F.coalesce(F.try_element_at(known, F.col("source")), F.lit(0.0))
    shares, rows = sizes.agg(F.sum(share), F.sum("size")).first()
    if not shares:
        shares = 1.0
    rows = float(rows or 0) if total is None else float(total)
    return sizes.select(
        "source",
        "size",
        (share / F.lit(shares)).alias("share"),
        (F.lit(rows) * share / F.lit(shares) / F.col("size")).alias("rate"),
    )


def fewest_copies(rate: Column) -> Column:
    """So many copies that fewer have no probability that doubles could tell from 0."""
    return F.greatest(F.floor(rate - 12 * F.sqrt(rate) - 20), F.lit(0)).cast("int")


def poisson_steps(rate: Column) -> Column:
    """Cumulative Poisson probabilities of `fewest_copies`, one more, ..., as far as doubles tell them from 1.

    Only numbers near the mean are looked at, so the array grows with the root of the rate. Far from 0 the
    probabilities are known by their ratios, and are divided by their sum.
    """
    first = fewest_copies(rate)
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    terms = F.transform(F.sequence(first + 1, last), lambda k: F.ln(rate / k))
    log_p = F.when(first == 0, -rate).otherwise(F.lit(0.0))
    start = F.struct(log_p.alias("log_p"), F.array(F.exp(log_p)).alias("steps"))

    def step(acc: Column, term: Column) -> Column:
        log_p = acc.log_p + term
        return F.struct(
            log_p.alias("log_p"),
            F.concat(acc.steps, F.array(F.element_at(acc.steps, -1) + F.exp(log_p))).alias("steps"),
        )

    def divided(acc: Column) -> Column:
        whole = F.when(first == 0, F.lit(1.0)).otherwise(F.element_at(acc.steps, -1))
        return F.transform(acc.steps, lambda s: s / whole)

    steps = F.aggregate(terms, start, step, divided)
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    total: float | None = None,
    flatten: float = 0.5,
    seed: int = 17,
) -> DataFrame:
    """Documents repeated by Poisson counts and put into random order.

    A document of source s is written N times, N being Poisson distributed with the mean
    total * share(s) / size(s). N is the inverse of that distribution at a number hashed from seed and
    doc_id, so it is the same in every run and at every partitioning. `weights` are the target shares by
    source (sources not named get none, so no rows are left where none is); with None shares follow size ** flatten. `total` is the
    expected number of rows out (default: as many as rows in).

    Result: the columns of `docs`, copy_no (int, from 1) and shuffle_key (long); rows lie in the order
    of a random permutation: dealt to partitions and sorted in them by the hashed key. A NULL source is
    a source of its own; rows that share a doc_id share their number of copies; NULL doc_id is hashed as
    the text `null`. Columns named copy_no or shuffle_key are replaced. An empty table gives an empty one.
    """
    docs = docs.drop("copy_no", "shuffle_key")
    rates = repetition_rates(docs, weights, total, flatten).select(
        F.col("source").alias("_source"),
        fewest_copies(F.col("rate")).alias("_fewest"),
        poisson_steps(F.col("rate")).alias("_steps"),
    )
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    point = uniform(F.lit(seed), F.col("doc_id"))
    copies = F.col("_fewest") + F.size(F.filter("_steps", lambda s: s <= F.col("_point")))
    return (
        docs.join(rates, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_point", point)
        .withColumn("_copies", copies)
        .where("_copies > 0")
        .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .drop("_source", "_fewest", "_steps", "_point", "_copies")
        .withColumn("shuffle_key", draw(F.lit(seed + 1), F.col("doc_id"), F.col("copy_no")))
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )
