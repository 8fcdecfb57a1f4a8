"""Comparing, appending, exporting and listing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemark.operators import datasets
from pagemark.schemas import resolve_page_id
from workload.views import read

QUERIES, ORACLE = {}, {}


def _sides(spark, sf):
    """Pages as assigned and pages as seen by the model, by case: columns agree, rows repeat."""
    left = read(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 1000).alias("band")
    )
    right = read(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 1000).alias("band")
    )
    return left, right


_SIDES = """l AS (SELECT c_nationkey AS nation, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM customer),
r AS (SELECT s_nationkey AS nation, CAST(floor(s_acctbal / 1000) AS BIGINT) AS band FROM supplier),
lc AS (SELECT nation, band, count(*) AS n FROM l GROUP BY ALL),
rc AS (SELECT nation, band, count(*) AS n FROM r GROUP BY ALL),
j AS (SELECT coalesce(lc.nation, rc.nation) AS nation, coalesce(lc.band, rc.band) AS band,
             coalesce(lc.n, 0) AS n_left, coalesce(rc.n, 0) AS n_right,
             CASE WHEN rc.n IS NULL THEN 'left_only' WHEN lc.n IS NULL THEN 'right_only' ELSE 'both' END AS side,
             greatest(coalesce(lc.n, 1), 1) * greatest(coalesce(rc.n, 1), 1) AS copies
      FROM lc FULL JOIN rc ON lc.nation = rc.nation AND lc.band = rc.band)"""


def dataset_diff(spark, sf):
    return datasets.diff_summary(*_sides(spark, sf))


QUERIES["dataset_diff"] = dataset_diff
ORACLE["dataset_diff"] = f"""WITH {_SIDES},
t AS (SELECT sum(n_left) FILTER (side = 'left_only') AS a, sum(n_right) FILTER (side = 'right_only') AS b,
             sum(copies) FILTER (side = 'both') AS c, sum(n_left) AS d, sum(n_right) AS e, sum(copies) AS f,
             count(*) FILTER (side = 'left_only') AS g, count(*) FILTER (side = 'right_only') AS h,
             count(*) FILTER (side = 'both') AS i FROM j),
u AS (SELECT unnest(['only_in_left', 'only_in_right', 'common_rows', 'rows_left', 'rows_right', 'joined_rows',
                     'keys_only_left', 'keys_only_right', 'keys_common']) AS metric,
             unnest([a, b, c, d, e, f, g, h, i]) AS v FROM t)
SELECT metric, CAST(coalesce(v, 0) AS BIGINT) AS count FROM u"""


def dataset_diff_rows(spark, sf):
    return datasets.diff_rows(*_sides(spark, sf))


QUERIES["dataset_diff_rows"] = dataset_diff_rows
ORACLE["dataset_diff_rows"] = f"WITH {_SIDES} SELECT nation, band, n_left, n_right, side, copies FROM j"


def dataset_diff_by_key(spark, sf):
    """Line items against orders by page, each row with the number of its partners."""
    left = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.col("l_linestatus").alias("status")
    )
    right = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("page"), F.col("o_orderstatus").alias("status")
    )
    return datasets.diff_rows_by_key(left, right, ["page"])


QUERIES["dataset_diff_by_key"] = dataset_diff_by_key
ORACLE["dataset_diff_by_key"] = """
WITH n AS (SELECT l_orderkey AS page, count(*) AS k FROM lineitem GROUP BY 1)
SELECT l_orderkey AS page, l_linestatus AS status, 'left' AS source, 'both' AS side, 1 AS partners
FROM lineitem
UNION ALL
SELECT o_orderkey, o_orderstatus, 'right', CASE WHEN k IS NULL THEN 'right_only' ELSE 'both' END,
       coalesce(k, 0) FROM orders LEFT JOIN n ON o_orderkey = page"""


def strict_union(spark, sf):
    def side(table, p):
        return read(spark, sf, table).select(
            F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation"),
            F.col(f"{p}_acctbal").alias("balance"),
        )

    return datasets.strict_union(side("customer", "c"), side("supplier", "s"))


QUERIES["strict_union"] = strict_union
ORACLE["strict_union"] = """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier"""


def export_strict(spark, sf):
    return datasets.export_strict(read(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "o_totalprice"])


QUERIES["export_strict"] = export_strict
ORACLE["export_strict"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


def export_lenient(spark, sf):
    return datasets.export_lenient(
        read(spark, sf, "customer"), datasets.column_list("c_custkey, c_mktsegment, c_phone")
    )


QUERIES["export_lenient"] = export_lenient
ORACLE["export_lenient"] = "SELECT c_custkey, c_mktsegment FROM customer"


def export_status(spark, sf):
    named = {t: read(spark, sf, t) for t in ("customer", "supplier", "orders", "nation")}
    return datasets.export_status(named, ["c_custkey", "s_suppkey", "o_orderkey"])


QUERIES["export_status"] = export_status
ORACLE["export_status"] = """
SELECT 'customer' AS dataset, true AS exported, 'c_custkey' AS columns, 's_suppkey,o_orderkey' AS missing,
       count(*) AS rows FROM customer
UNION ALL SELECT 'supplier', true, 's_suppkey', 'c_custkey,o_orderkey', count(*) FROM supplier
UNION ALL SELECT 'orders', true, 'o_orderkey', 'c_custkey,s_suppkey', count(*) FROM orders
UNION ALL SELECT 'nation', false, '', 'c_custkey,s_suppkey,o_orderkey', 0"""


def catalogue(spark, sf):
    return datasets.catalogue({t: read(spark, sf, t) for t in ("labels", "events", "lineitem", "region")})


QUERIES["catalogue"] = catalogue
ORACLE["catalogue"] = """
SELECT 0 AS idx, 'labels' AS dataset, count(*) AS rows, 'doc_id,quality,toxic' AS columns, 3 AS column_count
FROM labels
UNION ALL SELECT 1, 'events', count(*), 'event_id,ts,user_id,event_type,value,props', 6 FROM events
UNION ALL SELECT 2, 'lineitem', count(*), 'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,'
  || 'l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate', 11 FROM lineitem
UNION ALL SELECT 3, 'region', count(*), 'r_regionkey,r_name', 2 FROM region"""


def preview(spark, sf):
    return datasets.preview(read(spark, sf, "orders"), ["o_orderkey"], 10).select("o_orderkey", "o_custkey")


QUERIES["preview"] = preview
ORACLE["preview"] = "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10"


def resolved_ids(spark, sf):
    """A page list whose id column has the older name."""
    listed = read(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("case_id"), F.col("o_orderkey").cast("string").alias("image_id")
    )
    return resolve_page_id(listed).select("case_id", "page_id")


QUERIES["resolved_ids"] = resolved_ids
ORACLE["resolved_ids"] = """
SELECT CAST(o_custkey AS VARCHAR) AS case_id, CAST(o_orderkey AS VARCHAR) AS page_id FROM orders"""


def concatenated(spark, sf):
    """Frames of several sources in one table, columns by name, gaps NULL."""
    docs = read(spark, sf, "documents").select(
        "doc_id", F.lit("documents").alias("file"), F.length("text").cast("bigint").alias("size")
    )
    pages = read(spark, sf, "pages").select(
        "url", F.lit("pages").alias("file"), F.col("page_id").alias("doc_id")
    )
    return docs.unionByName(pages, allowMissingColumns=True)


QUERIES["concatenated"] = concatenated
ORACLE["concatenated"] = """
SELECT doc_id, 'documents' AS file, CAST(length(text) AS BIGINT) AS size, NULL::VARCHAR AS url FROM documents
UNION ALL SELECT page_id, 'pages', NULL, url FROM pages"""
