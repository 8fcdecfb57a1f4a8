"""Token, word and assignment views over the driver's tables, for Spark and as SQL.

A line item is a word prediction, its order the page, the customer the case. Several line items of
an order share a line number, which makes them top-k predictions of one word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.functions.boxes import COORDINATES
from pagemark.operators.dedup import collapse_top_k
from pagemark.session import apply_runtime_conf
from pagemark.vocabularies import bio_labels

VOCAB = bio_labels(["ADDRESS", "MONEY", "ORG"])
WORD_KEY = ["page_id", "word_ids"]
# ties on probability and prediction fall to these, in this order
ROW_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_shipdate"]
HIDDEN = ROW_ORDER + ["l_discount"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return apply_runtime_conf(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.withColumn(n, r6(n))
    return df


def tokens(
    spark: SparkSession, sf_dir: str, case: bool = False, coordinates: bool = False
) -> DataFrame:
    """One row per prediction. ``case`` joins the orders for the case id, ``coordinates`` adds
    x1, y1, x2, y2 as an annotation table has them."""
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", "ADDRESS").when(flag == "R", "MONEY").otherwise("O")
    right = F.when(flag == "A", 1).when(flag == "R", 3).otherwise(0)
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    x1, y1 = part % 900 + 1, supp % 900 + 1
    box = [x1, y1, part % 900 + 41, supp % 900 + 21]
    pred = F.when(part % 4 == 0, right).otherwise(((part + supp) % 7).cast("int"))
    df = read(spark, sf_dir, "lineitem")
    if case:
        orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        df = df.join(orders, df.l_orderkey == orders.o_orderkey)
    return df.select(
        *([F.col("o_custkey").cast("string").alias("case_id")] if case else []),
        F.col("l_orderkey").cast("string").alias("page_id"),
        F.col("l_orderkey").alias("page_no"),
        F.col("l_linenumber").cast("string").alias("word_ids"),
        F.col("l_linenumber").cast("bigint").alias("word_no"),
        F.col("l_linestatus").alias("words"),
        F.concat(
            F.lit("("),
            F.concat_ws(", ", *[c.cast("string") for c in box]),
            F.lit(")"),
        ).alias("bboxes"),
        *([c.cast("int").alias(n) for c, n in zip(box, COORDINATES)] if coordinates else []),
        label.alias("labels"),
        pred.cast("string").alias("pred"),
        ((100 - 9 * F.round(F.col("l_discount") * 100).cast("int")) / F.lit(100).cast("double")).alias(
            "prob"
        ),
        F.when(supp % 10 == 0, F.lit(None))
        .when(supp % 10 < 8, label)
        .otherwise("O")
        .alias("annotator1_label"),
        F.when(supp % 11 == 0, "")
        .when(part % 9 < 7, label)
        .otherwise("ADDRESS")
        .alias("annotator2_label"),
        *HIDDEN,
    )


def words(
    spark: SparkSession, sf_dir: str, case: bool = False, coordinates: bool = False
) -> DataFrame:
    """One row per word: the best prediction of each (page, word)."""
    return best_words(tokens(spark, sf_dir, case, coordinates))


def best_words(df: DataFrame) -> DataFrame:
    return collapse_top_k(df, ROW_ORDER, WORD_KEY).drop(*HIDDEN)


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; its status tells which of the two slots are done."""
    status = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("case_id"),
        F.col("o_orderkey").cast("string").alias("page_id"),
        F.when(F.col("o_orderpriority") < "3", "annotator1").otherwise("annotator3").alias("assignee1"),
        F.when(status.isin("F", "P"), "yes").otherwise("no").alias("has_assignee1_completed"),
        F.lit("annotator2").alias("assignee2"),
        F.when(status == "F", "Yes").otherwise("no").alias("has_assignee2_completed"),
        F.col("o_orderpriority").alias("notes"),
    )


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two events per page in turn; `error` events carry an invalid status."""
    events = read(spark, sf_dir, "events").withColumn("o_orderkey", F.shiftright("event_id", 1))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    kind, user = F.col("event_type"), F.col("user_id") % 3
    return events.join(orders, "o_orderkey").select(
        F.col("o_custkey").cast("string").alias("case_id"),
        F.col("o_orderkey").cast("string").alias("image_id"),
        F.when(user == 1, "annotator1").when(user == 2, "annotator2").otherwise("").alias("annotator"),
        F.when(kind == "purchase", "YES")
        .when(kind == "signup", "yes")
        .when(kind == "error", "done")
        .otherwise("no")
        .alias("status"),
        F.col("event_id").alias("ord"),
    )


TOK = """
base AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS page_id, l_orderkey AS page_no,
         CAST(l_linenumber AS VARCHAR) AS word_ids, CAST(l_linenumber AS BIGINT) AS word_no,
         l_linestatus AS words,
         CAST(l_partkey % 900 + 1 AS INTEGER) AS x1, CAST(l_suppkey % 900 + 1 AS INTEGER) AS y1,
         CAST(l_partkey % 900 + 41 AS INTEGER) AS x2, CAST(l_suppkey % 900 + 21 AS INTEGER) AS y2,
         CASE l_returnflag WHEN 'A' THEN 'ADDRESS' WHEN 'R' THEN 'MONEY' ELSE 'O' END AS labels,
         CAST(CASE WHEN l_partkey % 4 = 0
              THEN CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 3 ELSE 0 END
              ELSE (l_partkey + l_suppkey) % 7 END AS VARCHAR) AS pred,
         (100 - 9 * CAST(round(l_discount * 100) AS INTEGER)) / CAST(100 AS DOUBLE) AS prob,
         l_partkey, l_suppkey, l_extendedprice, l_quantity, l_tax, l_shipdate, l_discount
  FROM lineitem),
tok AS (
  SELECT *, '(' || x1 || ', ' || y1 || ', ' || x2 || ', ' || y2 || ')' AS bboxes,
         CASE pred WHEN '0' THEN 'O' WHEN '1' THEN 'B-ADDRESS' WHEN '2' THEN 'I-ADDRESS'
              WHEN '3' THEN 'B-MONEY' WHEN '4' THEN 'I-MONEY' WHEN '5' THEN 'B-ORG'
              ELSE 'I-ORG' END AS tag,
         CASE pred WHEN '0' THEN 'O' WHEN '1' THEN 'ADDRESS' WHEN '2' THEN 'ADDRESS'
              WHEN '3' THEN 'MONEY' WHEN '4' THEN 'MONEY' ELSE 'ORG' END AS flat,
         CASE WHEN l_suppkey % 10 = 0 THEN NULL WHEN l_suppkey % 10 < 8 THEN labels
              ELSE 'O' END AS annotator1_label,
         CASE WHEN l_suppkey % 11 = 0 THEN '' WHEN l_partkey % 9 < 7 THEN labels
              ELSE 'ADDRESS' END AS annotator2_label
  FROM base)"""
SUFFIX = "l_partkey, l_suppkey, l_extendedprice, l_quantity, l_tax, l_shipdate"
WORDS = f"""{TOK},
word AS (
  SELECT * FROM tok QUALIFY row_number() OVER (
    PARTITION BY page_id, word_ids ORDER BY prob DESC, pred, {SUFFIX}) = 1)"""
CASED = "word JOIN orders ON page_no = o_orderkey"
ASSIGN = """
assign AS (
  SELECT CAST(o_custkey AS VARCHAR) AS case_id, CAST(o_orderkey AS VARCHAR) AS page_id,
         CASE WHEN o_orderpriority < '3' THEN 'annotator1' ELSE 'annotator3' END AS assignee1,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN 'yes' ELSE 'no' END AS has_assignee1_completed,
         'annotator2' AS assignee2,
         CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'no' END AS has_assignee2_completed,
         o_orderpriority AS notes
  FROM orders)"""
UPDATES = """
upd AS (
  SELECT CAST(o_custkey AS VARCHAR) AS case_id, CAST(o_orderkey AS VARCHAR) AS page_id,
         CASE user_id % 3 WHEN 1 THEN 'annotator1' WHEN 2 THEN 'annotator2' ELSE '' END AS annotator,
         CASE event_type WHEN 'purchase' THEN 'YES' WHEN 'signup' THEN 'yes'
              WHEN 'error' THEN 'done' ELSE 'no' END AS status,
         event_id AS ord
  FROM events JOIN orders ON o_orderkey = event_id // 2)"""
