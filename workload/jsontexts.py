"""JSON documents: path queries, structure and text lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemark.functions.text import file_stem, shorten
from pagemark.operators import jsonops
from workload.views import read

QUERIES, ORACLE = {}, {}


def json_path(spark, sf):
    df = read(spark, sf, "events").select("event_id", jsonops.parsed("props").alias("v"))
    return df.select(
        "event_id",
        jsonops.json_path("v", "k", "bigint").alias("k"),
        jsonops.json_path("v", "k.missing[0]", "string").alias("missing"),
    )


QUERIES["json_path"] = json_path
ORACLE["json_path"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing
FROM events"""


def _documents(spark, sf):
    """Document texts as page JSON: a list of lines, or an object of lines for English ones."""
    lines = F.split("text", "\n")
    entry = F.transform(lines, lambda t: F.struct(t.alias("text"), F.length(t).alias("width")))
    named = F.map_from_arrays(
        F.transform(lines, lambda t, i: F.concat(F.lit("line"), i.cast("string"))), entry
    )
    as_list = F.to_json(F.struct(entry.alias("extracted_lines"), F.col("lang").alias("lang")))
    as_object = F.to_json(F.struct(named.alias("extracted_lines"), F.col("lang").alias("lang")))
    return read(spark, sf, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", as_object).otherwise(as_list).alias("json")
    )


def text_lines(spark, sf):
    return jsonops.text_lines(_documents(spark, sf), ["doc_id"])


QUERIES["text_lines"] = text_lines
ORACLE["text_lines"] = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
SELECT doc_id, CAST(i AS INTEGER) AS line_no, parts[i + 1] AS text
FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM l)"""


def json_profile(spark, sf):
    return jsonops.structure_profile(read(spark, sf, "events"), "props")


QUERIES["json_profile"] = json_profile
ORACLE["json_profile"] = """
SELECT '$' AS path, 'OBJECT' AS kind, count(*) AS "values", CAST(1 AS BIGINT) AS min_size,
       CAST(1 AS BIGINT) AS max_size, CAST(NULL AS VARCHAR) AS sample FROM events
UNION ALL
SELECT '$.k', 'BIGINT', count(*), NULL, NULL, min(json_extract_string(props, '$.k')) FROM events"""


def _nested(spark, sf):
    """Objects five levels deep, one of them holding a list of objects."""
    inner = F.struct(F.struct(F.struct(F.col("source").alias("e")).alias("d")).alias("c"))
    listed = F.array(F.struct(F.col("n_chars").alias("n")), F.struct(F.col("doc_id").alias("n")))
    whole = F.struct(F.struct(inner.alias("b"), listed.alias("l")).alias("a"))
    return read(spark, sf, "documents").select("doc_id", F.to_json(whole).alias("json"))


def json_profile_deep(spark, sf):
    return jsonops.structure_profile(_nested(spark, sf)).select("path", "kind", "values", "sample")


QUERIES["json_profile_deep"] = json_profile_deep
ORACLE["json_profile_deep"] = """
SELECT unnest(['$', '$.a', '$.a.b', '$.a.b.c', '$.a.b.c.d']) AS path, 'OBJECT' AS kind,
       count(*) AS "values", CAST(NULL AS VARCHAR) AS sample FROM documents
UNION ALL SELECT '$.a.b.c.d.e', 'STRING', count(*), min(source) FROM documents
UNION ALL SELECT '$.a.l', 'ARRAY', count(*), NULL FROM documents
UNION ALL SELECT '$.a.l[]', 'OBJECT', 2 * count(*), NULL FROM documents
UNION ALL SELECT '$.a.l[].n', 'BIGINT', 2 * count(*),
  least(min(CAST(n_chars AS VARCHAR)), min(CAST(doc_id AS VARCHAR))) FROM documents"""


def text_lines_mixed(spark, sf):
    """Items that have no text, a null text, or are no objects, among those that do."""
    items = F.array(
        F.struct(F.col("lang").alias("text"), F.lit(1).alias("w")),
        F.struct(F.lit(None).cast("string").alias("text"), F.lit(2).alias("w")),
        F.struct(F.col("source").alias("text"), F.lit(3).alias("w")),
    )
    packed = F.concat(
        F.lit('{"extracted_lines": {"z": {"w": 0}, "b": '), F.to_json(items[2]),
        F.lit(', "k": 5, "a": {"text": null}, "c": '), F.to_json(items[0]), F.lit("}}"),
    )
    return jsonops.text_lines(read(spark, sf, "documents").select("doc_id", packed.alias("json")), ["doc_id"])


QUERIES["text_lines_mixed"] = text_lines_mixed
ORACLE["text_lines_mixed"] = """
SELECT doc_id, 1 AS line_no, source AS text FROM documents
UNION ALL SELECT doc_id, 3, NULL FROM documents
UNION ALL SELECT doc_id, 4, lang FROM documents"""


def file_stems(spark, sf):
    return read(spark, sf, "pages").select("page_id", file_stem("url").alias("stem"))


QUERIES["file_stems"] = file_stems
ORACLE["file_stems"] = r"""
SELECT page_id, CASE WHEN length(n) > 1 THEN substr(n, 1, 1) || regexp_replace(substr(n, 2), '\.[^.]*$', '')
                     ELSE n END AS stem
FROM (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS n FROM pages)"""


def shortened_texts(spark, sf):
    return read(spark, sf, "documents").select("doc_id", shorten("text").alias("text"))


QUERIES["shortened_texts"] = shortened_texts
ORACLE["shortened_texts"] = """
SELECT doc_id, CASE WHEN length(text) > 50 THEN left(text, 47) || '...' ELSE text END AS text
FROM documents"""
