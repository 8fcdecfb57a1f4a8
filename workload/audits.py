"""Completeness and clean-up of annotation documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemark.operators import audit
from workload.views import ROW_ORDER, SUFFIX, TOK, tokens

QUERIES, ORACLE = {}, {}


def completion_audit(spark, sf):
    return audit.completion_audit(tokens(spark, sf, case=True), "case_id")


QUERIES["completion_audit"] = completion_audit
ORACLE["completion_audit"] = f"""WITH {TOK},
c AS (SELECT CAST(o_custkey AS VARCHAR) AS case_id, count(*) AS n,
             count(*) FILTER (annotator1_label IS NOT NULL) AS d1,
             count(*) FILTER (annotator2_label <> '') AS d2
      FROM tok JOIN orders ON page_no = o_orderkey GROUP BY 1),
s AS (SELECT 'group' AS level, * FROM c UNION ALL SELECT 'overall', 'all', sum(n), sum(d1), sum(d2) FROM c)
SELECT level, case_id, CAST(n AS BIGINT) AS total_rows, CAST(d1 AS BIGINT) AS annotator1_completed,
       CAST(d2 AS BIGINT) AS annotator2_completed,
       round(CAST(d1 * 100 AS DOUBLE) / CAST(n AS DOUBLE), 1) AS annotator1_completed_pct,
       round(CAST(d2 * 100 AS DOUBLE) / CAST(n AS DOUBLE), 1) AS annotator2_completed_pct
FROM s"""


def duplicate_rows(spark, sf):
    return audit.duplicate_rows(tokens(spark, sf), "page_id", ["labels", "pred", "annotator1_label"])


QUERIES["duplicate_rows"] = duplicate_rows
ORACLE["duplicate_rows"] = f"""WITH {TOK},
d AS (SELECT page_id, count(*) - 1 AS extra FROM tok GROUP BY page_id, labels, pred, annotator1_label),
p AS (SELECT page_id, CAST(sum(extra) AS BIGINT) AS duplicates FROM d GROUP BY 1)
SELECT 'group' AS level, page_id, duplicates FROM p
UNION ALL SELECT 'overall', 'all', CAST(sum(duplicates) AS BIGINT) FROM p"""


def cleanup_stats(spark, sf):
    df = tokens(spark, sf, case=True)
    after = audit.cleanup_job(
        df, "annotator1", ["word_no", *ROW_ORDER], keys=["page_id", "labels", "pred"]
    )
    return audit.cleanup_statistics(df, after, "case_id")


QUERIES["cleanup_stats"] = cleanup_stats
ORACLE["cleanup_stats"] = f"""WITH {TOK},
t AS (SELECT tok.*, CAST(o_custkey AS VARCHAR) AS case_id FROM tok JOIN orders ON page_no = o_orderkey),
k AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY page_id, labels, pred
                                                 ORDER BY word_no, {SUFFIX}) = 1),
a AS (SELECT case_id, count(*) AS fin, count(*) FILTER (annotator1_label IS NULL AND annotator2_label <> '')
             AS std FROM k GROUP BY 1),
b AS (SELECT case_id, count(*) AS orig FROM t GROUP BY 1),
s AS (SELECT 'group' AS level, case_id, orig, fin, std FROM a JOIN b USING (case_id)
      UNION ALL SELECT 'overall', 'all', sum(orig), sum(fin), sum(std) FROM a JOIN b USING (case_id))
SELECT level, case_id, CAST(orig AS BIGINT) AS original_rows, CAST(fin AS BIGINT) AS final_rows,
       CAST(std AS BIGINT) AS labels_standardized, CAST(orig - fin AS BIGINT) AS duplicates_removed
FROM s"""


def _stored(spark, sf):
    """Annotation rows as a table holds them, with the positions a scan and the reading order gave."""
    place = F.col("word_no") * 10**14 + F.col("l_partkey") * 10**7 + F.col("l_suppkey")
    return tokens(spark, sf, case=True).select(
        "case_id", "page_id", "labels", "pred", "annotator1_label", "annotator2_label",
        place.alias("pos"), F.col("l_suppkey").alias("reading_pos"),
    )


def duplicate_rows_stored(spark, sf):
    return audit.duplicate_rows(_stored(spark, sf), "case_id")


QUERIES["duplicate_rows_stored"] = duplicate_rows_stored
ORACLE["duplicate_rows_stored"] = f"""WITH {TOK},
d AS (SELECT CAST(o_custkey AS VARCHAR) AS case_id, count(*) - 1 AS extra
      FROM tok JOIN orders ON page_no = o_orderkey
      GROUP BY o_custkey, page_id, labels, pred, annotator1_label, annotator2_label),
p AS (SELECT case_id, CAST(sum(extra) AS BIGINT) AS duplicates FROM d GROUP BY 1)
SELECT 'group' AS level, case_id, duplicates FROM p
UNION ALL SELECT 'overall', 'all', CAST(sum(duplicates) AS BIGINT) FROM p"""


def cleanup_stats_stored(spark, sf):
    df = _stored(spark, sf)
    return audit.cleanup_statistics(df, audit.cleanup_job(df, "annotator1", ["pos"]), "case_id")


QUERIES["cleanup_stats_stored"] = cleanup_stats_stored
ORACLE["cleanup_stats_stored"] = f"""WITH {TOK},
t AS (SELECT tok.*, CAST(o_custkey AS VARCHAR) AS case_id FROM tok JOIN orders ON page_no = o_orderkey),
k AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY page_id, labels, pred
                                                 ORDER BY word_no, l_partkey, l_suppkey) = 1),
a AS (SELECT case_id, count(*) AS fin, count(*) FILTER (annotator1_label IS NULL AND annotator2_label <> '')
             AS std FROM k GROUP BY 1),
b AS (SELECT case_id, count(*) AS orig FROM t GROUP BY 1),
s AS (SELECT 'group' AS level, case_id, orig, fin, std FROM a JOIN b USING (case_id)
      UNION ALL SELECT 'overall', 'all', sum(orig), sum(fin), sum(std) FROM a JOIN b USING (case_id))
SELECT level, case_id, CAST(orig AS BIGINT) AS original_rows, CAST(fin AS BIGINT) AS final_rows,
       CAST(std AS BIGINT) AS labels_standardized, CAST(orig - fin AS BIGINT) AS duplicates_removed
FROM s"""
