"""Decoding, BIO conversion, standardising and filling of labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemark.functions.labels import strip_bio
from pagemark.operators import audit, labels
from workload.views import ROW_ORDER, SUFFIX, TOK, VOCAB, WORDS, read, tokens, words

QUERIES, ORACLE = {}, {}
ID = ["page_id", "word_ids"]


def _odd_predictions(spark, sf):
    """Class ids, ids outside the vocabulary, plain text and gaps."""
    number = F.col("l_linenumber") + F.floor(F.col("l_quantity") / 10) - 2
    pred = (
        F.when(F.col("l_tax") == 0.08, F.lit(None))
        .when(F.col("l_tax") == 0.07, F.concat(number.cast("string"), F.lit(".0")))
        .when(F.col("l_tax") == 0.06, F.col("l_returnflag"))
        .otherwise(number.cast("string"))
    )
    return read(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("page_id"),
        F.col("l_linenumber").cast("string").alias("word_ids"),
        pred.alias("pred"),
    )


_ODD = """odd AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS page_id, CAST(l_linenumber AS VARCHAR) AS word_ids,
         l_linenumber + CAST(floor(l_quantity / 10) AS BIGINT) - 2 AS n, l_tax, l_returnflag
  FROM lineitem),
voc AS (SELECT * FROM (VALUES (0, 'O'), (1, 'B-ADDRESS'), (2, 'I-ADDRESS'), (3, 'B-MONEY'),
                              (4, 'I-MONEY'), (5, 'B-ORG'), (6, 'I-ORG')) AS v(idx, label))"""
_DECODED = """SELECT page_id, word_ids,
       CASE WHEN l_tax = 0.08 THEN NULL WHEN l_tax = 0.07 THEN n || '.0'
            WHEN l_tax = 0.06 THEN l_returnflag ELSE CAST(n AS VARCHAR) END AS pred,
       CASE WHEN l_tax = 0.08 THEN '{missing}' WHEN l_tax = 0.07 THEN n || '.0'
            WHEN l_tax = 0.06 THEN l_returnflag ELSE coalesce(label, 'UNK_' || n) END AS decoded
FROM odd LEFT JOIN voc ON n = idx"""


def decode_unk(spark, sf):
    return labels.decode_column(_odd_predictions(spark, sf), VOCAB, "UNK", out="decoded")


QUERIES["decode_unk"] = decode_unk
ORACLE["decode_unk"] = f"WITH {_ODD} {_DECODED.format(missing='UNK')}"


def decode_o(spark, sf):
    vocab = _derived_vocabulary(spark, sf)
    return labels.decode_by_table(_odd_predictions(spark, sf), vocab, "O", out="decoded")


def _derived_vocabulary(spark, sf):
    """Index table of the part types, the way annotation labels are numbered."""
    return labels.vocabulary(read(spark, sf, "part"), "p_type")


QUERIES["decode_o"] = decode_o
ORACLE["decode_o"] = f"""WITH {_ODD.split('voc AS')[0]}
voc AS (SELECT row_number() OVER (ORDER BY p_type) - 1 AS idx, p_type AS label
        FROM (SELECT DISTINCT p_type FROM part)) {_DECODED.format(missing='O')}"""


def vocabulary(spark, sf):
    return labels.vocabulary(read(spark, sf, "part"), "p_name").select(
        F.col("idx").cast("bigint").alias("idx"), "label"
    )


QUERIES["vocabulary"] = vocabulary
ORACLE["vocabulary"] = """
SELECT row_number() OVER (ORDER BY p_name) - 1 AS idx, p_name AS label
FROM (SELECT DISTINCT p_name FROM part WHERE p_name <> '')"""


def strip_bio_query(spark, sf):
    df = labels.decode_column(tokens(spark, sf), VOCAB, "UNK", out="tag")
    gap = F.when(F.col("l_tax") == 0.08, F.lit(None)).when(F.col("l_tax") == 0.07, "nan").when(
        F.col("l_tax") == 0.06, F.concat(F.lit("  "), "tag", F.lit(" "))
    ).otherwise(F.col("tag"))
    return df.select(*ID, gap.alias("tag")).withColumn("flat", strip_bio("tag"))


QUERIES["strip_bio"] = strip_bio_query
ORACLE["strip_bio"] = f"""WITH {TOK}
SELECT page_id, word_ids,
       CASE WHEN l_tax = 0.08 THEN NULL WHEN l_tax = 0.07 THEN 'nan'
            WHEN l_tax = 0.06 THEN '  ' || tag || ' ' ELSE tag END AS tag,
       CASE WHEN l_tax IN (0.08, 0.07) THEN 'O' ELSE flat END AS flat
FROM tok"""


def strip_bio_white(spark, sf):
    """White space of other kinds than blanks around a tag."""
    df = labels.decode_column(tokens(spark, sf), VOCAB, "UNK", out="tag")
    wide = F.concat(F.lit("\t "), "tag", F.lit("\r\n\u00a0"))
    return df.select(*ID, strip_bio(wide).alias("flat"))


QUERIES["strip_bio_white"] = strip_bio_white
ORACLE["strip_bio_white"] = f"WITH {TOK} SELECT page_id, word_ids, flat FROM tok"


def flat_to_bio(spark, sf):
    """Documents are cases here: the words of a case's pages in order."""
    df = words(spark, sf, case=True).withColumn("pos", F.col("page_no") * 8 + F.col("word_no"))
    return labels.flat_to_bio(df, ["case_id"], "pos", "annotator1_label", "bio", bits=10).select(
        "case_id", "page_id", "word_ids", "annotator1_label", "bio"
    )


QUERIES["flat_to_bio"] = flat_to_bio
ORACLE["flat_to_bio"] = f"""WITH {WORDS},
f AS (SELECT CAST(o_custkey AS VARCHAR) AS case_id, page_id, page_no, word_no, word_ids, annotator1_label,
             coalesce(annotator1_label, 'O') AS lab
      FROM word JOIN orders ON page_no = o_orderkey),
g AS (SELECT *, lag(lab) OVER (PARTITION BY case_id ORDER BY page_no, word_no) AS prev FROM f)
SELECT case_id, page_id, word_ids, annotator1_label,
       CASE WHEN lab = 'O' THEN 'O' WHEN lab = prev THEN 'I-' || lab ELSE 'B-' || lab END AS bio
FROM g"""


def standardise_annotator(spark, sf):
    return labels.standardise_annotator(tokens(spark, sf), "annotator2").select(
        *ID, "annotator1_label", "annotator2_label", "label_filled"
    )


QUERIES["standardise_annotator"] = standardise_annotator
ORACLE["standardise_annotator"] = f"""WITH {TOK}
SELECT page_id, word_ids, annotator1_label,
       CASE WHEN annotator2_label = '' AND annotator1_label IS NOT NULL THEN annotator1_label
            ELSE annotator2_label END AS annotator2_label,
       annotator2_label = '' AND annotator1_label IS NOT NULL AS label_filled
FROM tok"""


def fill_predictions(spark, sf):
    return labels.fill_predictions(tokens(spark, sf), VOCAB).select(
        *ID, "annotator1_label", "annotator2_label", "annotator1_filled", "annotator2_filled"
    )


QUERIES["fill_predictions"] = fill_predictions
ORACLE["fill_predictions"] = f"""WITH {TOK}
SELECT page_id, word_ids, coalesce(annotator1_label, tag) AS annotator1_label,
       CASE WHEN annotator2_label = '' THEN tag ELSE annotator2_label END AS annotator2_label,
       annotator1_label IS NULL AS annotator1_filled, annotator2_label = '' AS annotator2_filled
FROM tok"""


def vocab_violations(spark, sf):
    return labels.vocabulary_violations(tokens(spark, sf), ["ADDRESS", "ORG"])


QUERIES["vocab_violations"] = vocab_violations
ORACLE["vocab_violations"] = f"""WITH {TOK},
l AS (SELECT 'annotator1' AS annotator, annotator1_label AS label FROM tok
      UNION ALL SELECT 'annotator2', annotator2_label FROM tok)
SELECT annotator, label, count(*) AS n FROM l
WHERE label <> '' AND label NOT IN ('ADDRESS', 'ORG') GROUP BY ALL"""


def vocab_violations_by_table(spark, sf):
    """Labels one annotator gave that the other never did."""
    df = tokens(spark, sf)
    known = labels.label_counts(df).filter(F.col("annotator") == "annotator1").filter(
        F.col("n") > F.lit(0)
    )
    shown = df.withColumn("annotator2_label", F.when(F.col("l_tax") == 0.08, F.col("words")).otherwise(
        F.col("annotator2_label")))
    return labels.vocabulary_violations_by_table(shown, known.select("label"))


QUERIES["vocab_violations_by_table"] = vocab_violations_by_table
ORACLE["vocab_violations_by_table"] = f"""WITH {TOK},
l AS (SELECT 'annotator1' AS annotator, annotator1_label AS label FROM tok
      UNION ALL SELECT 'annotator2', CASE WHEN l_tax = 0.08 THEN words ELSE annotator2_label END FROM tok)
SELECT label, annotator, count(*) AS n FROM l
WHERE label <> '' AND label NOT IN (SELECT annotator1_label FROM tok WHERE annotator1_label IS NOT NULL)
GROUP BY ALL"""


def fill_stats(spark, sf):
    df = tokens(spark, sf, case=True)
    after = audit.fill_job(df, VOCAB, ROW_ORDER, ["case_id", "page_id", "word_ids", "words"])
    return audit.fill_statistics(df, after, "case_id")


QUERIES["fill_stats"] = fill_stats
ORACLE["fill_stats"] = f"""WITH {TOK},
t AS (SELECT tok.*, CAST(o_custkey AS VARCHAR) AS case_id FROM tok JOIN orders ON page_no = o_orderkey),
k AS (SELECT * FROM t QUALIFY row_number() OVER (
        PARTITION BY case_id, page_id, word_ids, words ORDER BY prob DESC, {SUFFIX}) = 1),
a AS (SELECT case_id, count(*) AS final_rows, count(*) FILTER (annotator1_label IS NULL) AS f1,
             count(*) FILTER (annotator2_label = '') AS f2 FROM k GROUP BY 1),
b AS (SELECT case_id, count(*) AS original_rows FROM t GROUP BY 1),
s AS (SELECT 'group' AS level, case_id, original_rows, final_rows, f1, f2 FROM a JOIN b USING (case_id)
      UNION ALL SELECT 'overall', 'all', sum(original_rows), sum(final_rows), sum(f1), sum(f2)
      FROM a JOIN b USING (case_id))
SELECT level, case_id, CAST(original_rows AS BIGINT) AS original_rows,
       CAST(final_rows AS BIGINT) AS final_rows, CAST(final_rows AS BIGINT) AS predictions_decoded,
       CAST(f1 AS BIGINT) AS annotator1_filled, CAST(f2 AS BIGINT) AS annotator2_filled,
       CAST(original_rows - final_rows AS BIGINT) AS duplicates_removed
FROM s"""
