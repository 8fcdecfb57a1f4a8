"""Words, boxes, pages and collapsing of top-k predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemark.functions.boxes import box_coordinates, inside_region, within_coordinate_range
from pagemark.functions.labels import decode, strip_bio
from pagemark.operators import dedup, pages
from pagemark.operators.overlap import box_overlaps, overlap_summary
from workload.views import (
    ROW_ORDER,
    SUFFIX,
    TOK,
    VOCAB,
    WORD_KEY,
    WORDS,
    read,
    rounded,
    tokens,
    words,
)

QUERIES, ORACLE = {}, {}
_BOX = ["x1", "y1", "x2", "y2"]


def _odd_boxes(df):
    """Replace some box texts by ones no box can be read from."""
    return df.withColumn(
        "bboxes",
        F.when(F.col("l_tax") == 0.08, "(1.5, 2, 3, 4)")
        .when(F.col("l_tax") == 0.07, "(-1, 2, 3, 4)")
        .when(F.col("l_tax") == 0.06, "box")
        .otherwise(F.col("bboxes")),
    )


_ODD = """odd AS (
  SELECT * EXCLUDE (bboxes, x1, y1, x2, y2),
         CASE WHEN l_tax = 0.08 THEN '(1.5, 2, 3, 4)' WHEN l_tax = 0.07 THEN '(-1, 2, 3, 4)'
              WHEN l_tax = 0.06 THEN 'box' ELSE bboxes END AS bboxes
  FROM {source}),
boxed AS (
  SELECT *, {coordinates} FROM odd)"""
_PATTERN = r"\(\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\)"
_COORD = ", ".join(
    f"TRY_CAST(nullif(regexp_extract(bboxes, '{_PATTERN}', {i}), '') AS INTEGER) AS {c}"
    for i, c in enumerate(_BOX, 1)
)


def bbox_parse(spark, sf):
    return _odd_boxes(tokens(spark, sf)).select("page_id", "word_ids", "bboxes", *box_coordinates("bboxes"))


QUERIES["bbox_parse"] = bbox_parse
ORACLE["bbox_parse"] = f"""WITH {TOK}, {_ODD.format(source='tok', coordinates=_COORD)}
SELECT page_id, word_ids, bboxes, x1, y1, x2, y2 FROM boxed"""


def box_region(spark, sf):
    df = pages.with_coordinates(tokens(spark, sf))
    width, height = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return df.filter(inside_region(100, 100, 800, 800)).select(
        "page_id", "word_ids", "x1", "y1", width.alias("width"), height.alias("height"),
        (width * height).alias("area"),
    )


QUERIES["box_region"] = box_region
ORACLE["box_region"] = f"""WITH {TOK}
SELECT page_id, word_ids, x1, y1, x2 - x1 AS width, y2 - y1 AS height, (x2 - x1) * (y2 - y1) AS area
FROM tok WHERE x1 >= 100 AND y1 >= 100 AND x2 <= 800 AND y2 <= 800"""


def id_conformance(spark, sf):
    df = read(spark, sf, "lineitem").select(
        F.concat(F.when(F.col("l_returnflag") == "N", "1-2").otherwise("1-1"), "l_linenumber",
                 F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("case_id"),
        F.concat(F.lpad(F.col("l_orderkey").cast("string"), 10, "0"), F.lit("_0"), "l_linenumber",
                 F.lit("_"), F.when(F.col("l_linestatus") == "O", "0").otherwise("F")).alias("page_id"),
        (F.col("l_partkey") % 900 + 1).cast("int").alias("x1"),
        (F.col("l_suppkey") % 900 + 1).cast("int").alias("y1"),
        (F.col("l_partkey") % 900 + 141).cast("int").alias("x2"),
        (F.col("l_suppkey") % 900 + 21).cast("int").alias("y2"),
    )
    return pages.conformance(
        df,
        {
            "case_id": F.col("case_id").rlike(pages.CASE_ID_PATTERN),
            "page_id": F.col("page_id").rlike(pages.PAGE_ID_PATTERN),
            "coordinates": within_coordinate_range(),
        },
    )


QUERIES["id_conformance"] = id_conformance
ORACLE["id_conformance"] = """WITH t AS (
  SELECT (CASE WHEN l_returnflag = 'N' THEN '1-2' ELSE '1-1' END) || l_linenumber
           || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS case_id,
         lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '_0' || l_linenumber || '_'
           || (CASE WHEN l_linestatus = 'O' THEN '0' ELSE 'F' END) AS page_id,
         l_partkey % 900 + 1 AS x1, l_suppkey % 900 + 1 AS y1,
         l_partkey % 900 + 141 AS x2, l_suppkey % 900 + 21 AS y2
  FROM lineitem)
SELECT 'case_id' AS rule, count(*) AS checked,
       count(*) FILTER (NOT regexp_matches(case_id, '^1-1[0-9][A-Z0-9]{6}$')) AS violations FROM t
UNION ALL
SELECT 'page_id', count(*),
       count(*) FILTER (NOT regexp_matches(page_id, '^[0-9]{10}_[0-9]{2}_[0-9]$')) FROM t
UNION ALL
SELECT 'coordinates', count(*),
       count(*) FILTER (NOT (x1 BETWEEN 1 AND 1000 AND y1 BETWEEN 1 AND 1000
                             AND x2 BETWEEN 1 AND 1000 AND y2 BETWEEN 1 AND 1000)) FROM t"""


def confidence_bands(spark, sf):
    return pages.confidence_counts(tokens(spark, sf), ["labels"])


QUERIES["confidence_bands"] = confidence_bands
ORACLE["confidence_bands"] = f"""WITH {TOK}
SELECT labels, CASE WHEN prob > 0.8 THEN 'high' WHEN prob >= 0.5 THEN 'medium' ELSE 'low' END AS band,
       count(*) AS n FROM tok GROUP BY 1, 2"""


def page_tokens(spark, sf):
    listed = read(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").cast("string").alias("case_id"),
        F.col("o_orderkey").cast("string").alias("page_id"),
    )
    return pages.page_tokens(tokens(spark, sf, case=True), listed).select(
        "case_id", "page_id", "word_ids", "labels", "pred", "prob"
    )


QUERIES["page_tokens"] = page_tokens
ORACLE["page_tokens"] = f"""WITH {TOK}
SELECT CAST(o_custkey AS VARCHAR) AS case_id, page_id, word_ids, labels, pred, prob
FROM tok JOIN orders ON page_no = o_orderkey WHERE o_orderstatus = 'F'"""


def page_reconciliation(spark, sf):
    orders = read(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("case_id"),
        F.col("o_orderkey").cast("string").alias("page_id"),
        "o_totalprice",
        "o_orderpriority",
    )
    customer = read(spark, sf, "customer").withColumn("case_id", F.col("c_custkey").cast("string"))
    return pages.page_reconciliation(
        orders.select("case_id", "page_id"),
        cases=customer.filter(F.col("c_acctbal") > 0),
        token_cases=customer.filter(F.col("c_mktsegment") != "MACHINERY"),
        images=orders.filter(F.col("o_totalprice") > 50000),
        token_pages=tokens(spark, sf, case=True),
        unreadable=customer.filter(F.col("c_nationkey") == 7),
    )


QUERIES["page_reconciliation"] = page_reconciliation
ORACLE["page_reconciliation"] = """
SELECT CAST(o_custkey AS VARCHAR) AS case_id, CAST(o_orderkey AS VARCHAR) AS page_id,
       CASE WHEN c_acctbal <= 0 THEN 'case_missing' WHEN c_mktsegment = 'MACHINERY' THEN 'tokens_missing'
            WHEN o_totalprice <= 50000 THEN 'image_missing' WHEN c_nationkey = 7 THEN 'unreadable'
            WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN 'no_rows'
            ELSE 'ok' END AS status
FROM orders JOIN customer ON o_custkey = c_custkey"""


def id_reconciliation(spark, sf):
    listed = read(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"))
    found = read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") + F.col("l_linenumber") * 100).alias("page_id")
    )
    return pages.id_reconciliation(listed, found, "page_id")


QUERIES["id_reconciliation"] = id_reconciliation
ORACLE["id_reconciliation"] = """
WITH l AS (SELECT DISTINCT o_orderkey AS page_id FROM orders),
     r AS (SELECT DISTINCT l_orderkey + l_linenumber * 100 AS page_id FROM lineitem)
SELECT coalesce(l.page_id, r.page_id) AS page_id,
       CASE WHEN r.page_id IS NULL THEN 'missing' WHEN l.page_id IS NULL THEN 'extra' ELSE 'match' END AS side
FROM l FULL JOIN r ON l.page_id = r.page_id"""


def distinct_page_ids(spark, sf):
    """Distinct page ids per case, counted."""
    from pagemark.operators.datasets import distinct_ids

    ids = distinct_ids(tokens(spark, sf, case=True), "case_id", "page_id")
    return ids.groupBy("case_id").agg(F.count(F.lit(1)).alias("pages"))


QUERIES["distinct_page_ids"] = distinct_page_ids
ORACLE["distinct_page_ids"] = """
SELECT CAST(o_custkey AS VARCHAR) AS case_id, count(DISTINCT l_orderkey) AS pages
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""


def image_manifest(spark, sf):
    web = read(spark, sf, "pages").select(
        F.regexp_extract("url", r"^https?://([^/:?#]+)", 1).alias("case_id"),
        F.col("page_id").cast("string").alias("page_id"),
        F.col("url").alias("path"),
        F.length("html").cast("bigint").alias("length"),
    )
    return pages.image_manifest(web, web.filter(F.col("length") > 2000))


QUERIES["image_manifest"] = image_manifest
ORACLE["image_manifest"] = r"""
WITH w AS (SELECT regexp_extract(url, '^https?://([^/:?#]+)', 1) AS case_id,
                  CAST(page_id AS VARCHAR) AS page_id, url, CAST(length(html) AS BIGINT) AS n FROM pages)
SELECT case_id, page_id, CASE WHEN n > 2000 THEN url END AS path, CASE WHEN n > 2000 THEN n END AS length,
       case_id || '_' || page_id || '.jpeg' AS file_name,
       CASE WHEN n > 2000 THEN NULL ELSE 'image_missing' END AS reason
FROM w"""


def annotation_table(spark, sf):
    df = tokens(spark, sf).withColumnRenamed("word_no", "pos")
    df = df.drop("page_no", "l_discount", "annotator1_label", "annotator2_label")
    # ties inside a word fall to the row order before the positions of words matter
    return pages.annotation_table(
        df, None, "pos", WORD_KEY, ["page_id"], tie_order=ROW_ORDER
    ).drop("pos", *ROW_ORDER)


QUERIES["annotation_table"] = annotation_table
ORACLE["annotation_table"] = f"""WITH {WORDS}
SELECT page_id, word_ids, words, bboxes, x1, y1, x2, y2, labels, pred, prob,
       row_number() OVER (PARTITION BY page_id ORDER BY y1, x1, word_no) AS reading_pos,
       '' AS annotator1_label, '' AS annotator2_label
FROM word"""


def topk_collapse(spark, sf):
    df = tokens(spark, sf).withColumn("pred", strip_bio(decode("pred", VOCAB, "UNK")))
    return dedup.collapse_top_k(df, ROW_ORDER, WORD_KEY).select(
        "page_id", "word_ids", "bboxes", "labels", "pred", "prob"
    )


QUERIES["topk_collapse"] = topk_collapse
ORACLE["topk_collapse"] = f"""WITH {TOK}
SELECT page_id, word_ids, bboxes, labels, flat AS pred, prob FROM tok
QUALIFY row_number() OVER (PARTITION BY page_id, word_ids
  ORDER BY prob DESC, CASE WHEN flat = labels THEN 0 ELSE 1 END, flat, {SUFFIX}) = 1"""


def topk_collapse_by_word(spark, sf):
    df = tokens(spark, sf).withColumn(
        "words", F.when(F.col("l_tax") > 0, F.col("words"))
    )
    return dedup.collapse_top_k_by_word(df, ROW_ORDER, ["page_id", "word_ids", "words"]).select(
        "page_id", "word_ids", "words", "bboxes", "pred", "prob"
    )


QUERIES["topk_collapse_by_word"] = topk_collapse_by_word
ORACLE["topk_collapse_by_word"] = f"""WITH {TOK}
SELECT page_id, word_ids, words, bboxes, pred, prob FROM tok WHERE l_tax > 0
QUALIFY row_number() OVER (PARTITION BY page_id, word_ids, words ORDER BY prob DESC, {SUFFIX}) = 1"""


def drop_duplicates_first(spark, sf):
    df = tokens(spark, sf).select("page_id", "labels", "pred", "annotator1_label", "word_no", *ROW_ORDER)
    order = ["word_no", *ROW_ORDER]
    return dedup.drop_duplicates_first(df, order).select("page_id", "labels", "pred", "annotator1_label",
                                                         "word_no")


QUERIES["drop_duplicates_first"] = drop_duplicates_first
ORACLE["drop_duplicates_first"] = f"""WITH {TOK}
SELECT page_id, labels, pred, annotator1_label, word_no FROM tok
QUALIFY row_number() OVER (PARTITION BY page_id, labels, pred ORDER BY word_no, {SUFFIX}) = 1"""


def reading_order(spark, sf):
    def best(rows):
        return pages.with_coordinates(_odd_boxes(dedup.collapse_top_k(rows, ROW_ORDER, WORD_KEY)))

    return pages.reading_order(tokens(spark, sf), "word_no", ["page_id"], prepare=best).select(
        "page_id", "word_ids", "y1", "x1", "reading_pos"
    )


QUERIES["reading_order"] = reading_order
ORACLE["reading_order"] = f"""WITH {WORDS}, {_ODD.format(source='word', coordinates=_COORD)}
SELECT page_id, word_ids, y1, x1, row_number() OVER (
  PARTITION BY page_id ORDER BY y1 NULLS LAST, x1 NULLS LAST, word_no) AS reading_pos
FROM boxed"""


def box_overlap(spark, sf):
    out = box_overlaps(tokens(spark, sf, case=True, coordinates=True), ["case_id"])
    return rounded(out, "overlap_share")


_OVERLAPS = f"""{TOK},
b AS (SELECT CAST(o_custkey AS VARCHAR) AS case_id, x1, y1, x2, y2, count(*) AS n
      FROM tok JOIN orders ON page_no = o_orderkey GROUP BY ALL),
p AS (
  SELECT a.case_id, a.x1 AS a_x1, a.y1 AS a_y1, a.x2 AS a_x2, a.y2 AS a_y2,
         b.x1 AS b_x1, b.y1 AS b_y1, b.x2 AS b_x2, b.y2 AS b_y2, a.n * b.n AS word_pairs
  FROM b AS a JOIN b ON a.case_id = b.case_id AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2
       AND b.y1 < a.y2 AND (a.y1, a.x1, a.y2, a.x2) < (b.y1, b.x1, b.y2, b.x2)
  UNION ALL
  SELECT case_id, x1, y1, x2, y2, x1, y1, x2, y2, n * (n - 1) // 2 FROM b WHERE n > 1),
met AS (
  SELECT *, CAST((least(a_x2, b_x2) - greatest(a_x1, b_x1)) * (least(a_y2, b_y2) - greatest(a_y1, b_y1))
               AS BIGINT) AS overlap_area,
       round((least(a_x2, b_x2) - greatest(a_x1, b_x1)) * (least(a_y2, b_y2) - greatest(a_y1, b_y1))
             / CAST(least((a_x2 - a_x1) * (a_y2 - a_y1), (b_x2 - b_x1) * (b_y2 - b_y1)) AS DOUBLE), 6)
         AS overlap_share
  FROM p)"""
QUERIES["box_overlap"] = box_overlap
ORACLE["box_overlap"] = f"WITH {_OVERLAPS} SELECT * FROM met"


def box_overlap_summary(spark, sf):
    found = box_overlaps(tokens(spark, sf, case=True, coordinates=True), ["case_id"])
    return rounded(overlap_summary(found, ["case_id"]), "largest_share")


QUERIES["box_overlap_summary"] = box_overlap_summary
ORACLE["box_overlap_summary"] = f"""WITH {_OVERLAPS}
SELECT case_id, count(*) AS box_pairs, CAST(sum(word_pairs) AS BIGINT) AS word_pairs,
       CAST(sum(word_pairs * overlap_area) AS BIGINT) AS overlap_area, max(overlap_share) AS largest_share
FROM met GROUP BY 1"""


def topk_collapse_text(spark, sf):
    """Probabilities as a file has them: text, some of it no number."""
    prob = F.when(F.col("l_quantity") < 5, "x").otherwise(F.col("prob").cast("string"))
    df = tokens(spark, sf).withColumn("prob", prob)
    return dedup.collapse_top_k(df, ROW_ORDER, WORD_KEY).select("page_id", "word_ids", "pred", "prob")


QUERIES["topk_collapse_text"] = topk_collapse_text
ORACLE["topk_collapse_text"] = f"""WITH {TOK},
t AS (SELECT *, CASE WHEN l_quantity < 5 THEN 'x' ELSE CAST(prob AS VARCHAR) END AS written,
             CASE WHEN l_quantity < 5 THEN NULL ELSE prob END AS known FROM tok)
SELECT page_id, word_ids, pred, written AS prob FROM t
QUALIFY row_number() OVER (PARTITION BY page_id, word_ids
  ORDER BY known DESC NULLS LAST, pred = labels DESC, pred, {SUFFIX}) = 1"""
