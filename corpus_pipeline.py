"""Corpus pipeline: language, lines, near duplicates, mixture, token ids.

Each stage works on all rows the one before has kept, and all but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemark.llm import bpe, jaccard, language, lines, mixing
from pagemark.llm.common import stored, table

#: A document stays if this share of its words is labelled with one language.
LEAST_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is found: `und` and evenly mixed ones go.

    The field learns from the labelled rows whose fold is not held out. Without any, nothing can be told
    and nothing goes. NULL and empty texts, and texts without a letter, are `und` and go. Rows are judged one
    by one, so equal rows stay or go together, and NULL in any other column changes nothing.
    """
    model = language.train(docs.where(~language.held_out(F.col("doc_id"), 4, 2)))
    if model is None:
        return docs
    named = language.identify(docs, model)
    found = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)
    return named.where(found).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated lines out; a document all of whose lines go, goes.

    So NULL, empty and blank texts go. Rows that are equal in doc_id and text stay in all their copies; other rows
    of one doc_id, or of none, lose repeated lines like any. n_chars is that of the text that is left.
    """
    cleaned = lines.dedup_lines(docs).where("n_kept > 0")
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id.

    Word shingles of five words at a similarity of 0.8. Of a group's rows with that doc_id the one with the
    smallest text stays; rows that share a doc_id but are in different groups do not replace each other. Rows
    without doc_id stay, as nothing tells them apart.
    """
    key = F.xxhash64("text")
    # a row is told by its id and its text, so a group is named by the least of its rows
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", key.alias("text_key")))
    rows = docs.select(row.alias("doc_id"), "text")
    groups = stored(jaccard.near_duplicates(rows, width=5, percent=80), "groups")
    keep = groups.where("doc_id.doc_id = component_id.doc_id").select(
        "doc_id.doc_id", F.col("doc_id.text_key").alias("_key"), F.col("component_id.text_key").alias("_group")
    )
    order = Window.partitionBy("doc_id", "_group").orderBy("text", "source", "lang", "n_chars")
    known = docs.where("doc_id is not null").withColumn("_key", key).join(keep.distinct(), ["doc_id", "_key"])
    known = known.withColumn("_row", F.row_number().over(order)).where("_row = 1").select(docs.columns)
    return known.unionByName(docs.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts, shares following size ** 0.5, in random order.

    A NULL source is a source of its own; rows that share a doc_id share their number of copies; texts are not
    looked at. No rows give no rows.
    """
    return mixing.mix_sources(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes, one row per row of `docs`; NULL text is empty."""
    return bpe.digests(bpe.encode_documents(docs))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", near_duplicates),
    ("mixing", mix),
    ("byte_bpe", encode),
]
#: SQL can neither train the labeller nor merge byte pairs; the tests use plain Python beside each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
