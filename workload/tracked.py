"""Assignments, status updates and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemark.operators import tracking
from workload.views import ASSIGN, UPDATES, assignments, read, updates

QUERIES, ORACLE = {}, {}
SHARE = "Z:\\gold"


def tracking_rows(spark, sf):
    pages = read(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("case_id"),
        F.col("o_orderkey").cast("string").alias("page_id"),
    )
    return tracking.tracking_rows(pages, SHARE)


QUERIES["tracking_rows"] = tracking_rows
ORACLE["tracking_rows"] = r"""
SELECT CAST(o_custkey AS VARCHAR) AS case_id, CAST(o_orderkey AS VARCHAR) AS page_id,
       'Z:\gold\annotation_images\' || o_custkey || '_' || o_orderkey || '.jpeg' AS image_file_path,
       'Z:\gold\annotation_labels\' || o_custkey || '_' || o_orderkey || '.xlsx' AS label_file_path,
       'annotator1' AS assignee1, 'no' AS has_assignee1_completed,
       'annotator2' AS assignee2, 'no' AS has_assignee2_completed, '' AS notes
FROM orders"""


def annotator_view(spark, sf):
    return tracking.annotator_view(assignments(spark, sf))


QUERIES["annotator_view"] = annotator_view
ORACLE["annotator_view"] = f"""WITH {ASSIGN}
SELECT 1 AS slot, case_id, page_id, assignee1 AS assignee, has_assignee1_completed AS has_completed, notes
FROM assign
UNION ALL SELECT 2, case_id, page_id, assignee2, has_assignee2_completed, notes FROM assign"""


def case_index(spark, sf):
    return tracking.case_index(assignments(spark, sf), ["annotator1", "annotator2"])


QUERIES["case_index"] = case_index
ORACLE["case_index"] = f"""WITH {ASSIGN}
SELECT case_id, count(*) AS num_images, 'annotator1/' || case_id AS annotator1,
       'annotator2/' || case_id AS annotator2
FROM assign GROUP BY case_id ORDER BY case_id"""


def status_merge(spark, sf):
    return tracking.apply_updates(assignments(spark, sf), updates(spark, sf))


_HITS = f"""{ASSIGN}, {UPDATES},
ok AS (SELECT * REPLACE (lower(status) AS status) FROM upd WHERE lower(status) IN ('yes', 'no')),
h1 AS (SELECT a.page_id, arg_max(u.status, u.ord) AS status, count(*) AS n FROM assign a JOIN ok u
       ON a.case_id = u.case_id AND a.page_id = u.page_id AND (u.annotator = '' OR u.annotator = a.assignee1)
       GROUP BY 1),
h2 AS (SELECT a.page_id, arg_max(u.status, u.ord) AS status, count(*) AS n FROM assign a JOIN ok u
       ON a.case_id = u.case_id AND a.page_id = u.page_id AND (u.annotator = '' OR u.annotator = a.assignee2)
       GROUP BY 1),
merged AS (
  SELECT a.case_id, a.page_id, a.assignee1, coalesce(h1.status, has_assignee1_completed) AS
         has_assignee1_completed, a.assignee2, coalesce(h2.status, has_assignee2_completed) AS
         has_assignee2_completed, notes, coalesce(h1.n, 0) + coalesce(h2.n, 0) AS slot_writes
  FROM assign a LEFT JOIN h1 ON a.page_id = h1.page_id LEFT JOIN h2 ON a.page_id = h2.page_id)"""
QUERIES["status_merge"] = status_merge
ORACLE["status_merge"] = f"WITH {_HITS} SELECT * FROM merged"


def update_rejects(spark, sf):
    return tracking.rejected_updates(updates(spark, sf))


QUERIES["update_rejects"] = update_rejects
ORACLE["update_rejects"] = f"""WITH {UPDATES}
SELECT case_id, page_id AS image_id, annotator, status, ord FROM upd
WHERE lower(status) NOT IN ('yes', 'no')"""


def set_status(spark, sf):
    cases = read(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").cast("string")
    )
    return tracking.set_status(
        assignments(spark, sf), "YES", case_ids=cases, annotators=["annotator2", "annotator3"]
    )


QUERIES["set_status"] = set_status
ORACLE["set_status"] = f"""WITH {ASSIGN},
m AS (SELECT assign.*, c_mktsegment = 'BUILDING' AS hit FROM assign JOIN customer
      ON case_id = CAST(c_custkey AS VARCHAR))
SELECT case_id, page_id, assignee1,
       CASE WHEN hit AND assignee1 = 'annotator3' THEN 'yes' ELSE has_assignee1_completed END AS
         has_assignee1_completed,
       assignee2, CASE WHEN hit THEN 'yes' ELSE has_assignee2_completed END AS has_assignee2_completed,
       notes, CAST(CASE WHEN hit THEN 1 + CASE WHEN assignee1 = 'annotator3' THEN 1 ELSE 0 END
                   ELSE 0 END AS BIGINT) AS slot_writes
FROM m"""


def progress(spark, sf):
    merged = tracking.apply_updates(assignments(spark, sf), updates(spark, sf))
    return tracking.progress(merged)


QUERIES["progress"] = progress
ORACLE["progress"] = f"""WITH {_HITS},
c AS (SELECT case_id, count(*) AS t, count(*) FILTER (lower(has_assignee1_completed) = 'yes') AS d1,
             count(*) FILTER (lower(has_assignee2_completed) = 'yes') AS d2,
             count(*) FILTER (lower(has_assignee1_completed) = 'yes'
                              AND lower(has_assignee2_completed) = 'yes') AS d3
      FROM merged GROUP BY 1),
s AS (SELECT 'group' AS level, * FROM c
      UNION ALL SELECT 'overall', 'all', sum(t), sum(d1), sum(d2), sum(d3) FROM c)
SELECT level, case_id, CAST(t AS BIGINT) AS total, CAST(d1 AS BIGINT) AS completed1,
       CAST(d2 AS BIGINT) AS completed2, CAST(d3 AS BIGINT) AS completed_both,
       round(CAST(d1 * 100 AS DOUBLE) / CAST(t AS DOUBLE), 1) AS completed1_pct,
       round(CAST(d2 * 100 AS DOUBLE) / CAST(t AS DOUBLE), 1) AS completed2_pct,
       round(CAST(d3 * 100 AS DOUBLE) / CAST(t AS DOUBLE), 1) AS completed_both_pct
FROM s"""


def productivity(spark, sf):
    return tracking.productivity(assignments(spark, sf))


QUERIES["productivity"] = productivity
ORACLE["productivity"] = f"""WITH {ASSIGN},
s AS (SELECT assignee1 AS annotator, lower(has_assignee1_completed) = 'yes' AS d FROM assign
      UNION ALL SELECT assignee2, lower(has_assignee2_completed) = 'yes' FROM assign)
SELECT annotator, count(*) AS assigned, count(*) FILTER (d) AS completed,
       round(CAST(count(*) FILTER (d) * 100 AS DOUBLE) / CAST(count(*) AS DOUBLE), 1) AS completion_rate
FROM s GROUP BY 1"""
