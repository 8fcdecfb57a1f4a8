"""Extracted page texts in JSON: lines, path queries and structure profiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.functions.text import shorten
from pagemark.session import written


def parsed(json="json") -> Column:
    """Text as VARIANT; NULL when it is no JSON."""
    return F.try_parse_json(F.col(json) if isinstance(json, str) else json)


def json_path(variant, path: str, kind: str = "string", strict: bool = False) -> Column:
    """Value at a path such as ``a.b[0].c``; with ``strict`` a value of another type is an error.

    NULL for a missing key; `require_path` turns that into an error.
    """
    full = path if path.startswith("$") else "$" + (path if path.startswith("[") else f".{path}")
    get = F.variant_get if strict else F.try_variant_get
    return get(F.col(variant) if isinstance(variant, str) else variant, full, kind)


def require_path(variant, path: str, kind: str = "string") -> Column:
    """As above, but a document without the path stops the job."""
    present = json_path(variant, path, "variant").isNotNull()
    message = F.lit(f"path not found: {path}")
    return F.when(present, json_path(variant, path, kind)).otherwise(
        F.raise_error(message).cast(kind)
    )


def text_lines(
    df: DataFrame, keys: list[str], json: str = "json", field: str = "extracted_lines"
) -> DataFrame:
    """(keys…, line_no, text) from a field holding a list or an object of objects with `text`.

    Items without `text` are skipped, those with a null text stay. Lines of an object come in the
    order its keys have in the document.
    """
    as_list = F.try_variant_get(json_path(parsed(json), field, "variant"), "$", "array<variant>")
    # an object is read as a map from its text, as that keeps the entries in document order
    as_object = F.from_json(F.get_json_object(json, f"$.{field}"), "map<string,variant>")
    items = F.coalesce(as_list, F.map_values(as_object))
    exploded = (
        df.withColumn("_items", items)
        .filter(F.col("_items").isNotNull())
        .select(*keys, F.posexplode("_items").alias("line_no", "_item"))
    )
    text = F.try_variant_get(F.col("_item"), "$.text", "variant")
    return exploded.filter(text.isNotNull()).select(
        *keys, "line_no", F.try_variant_get(F.col("_item"), "$.text", "string").alias("text")
    )


def nesting_depth(df: DataFrame, json: str = "json") -> int:
    """How deep the deepest document nests its objects and lists: one number, one pass."""
    # brackets inside strings go with their strings
    tokens = F.regexp_extract_all(F.col(json), F.lit(r'"(?:[^"\\]|\\.)*+"|[\[\]{}]'), F.lit(0))

    def step(acc: Column, token: Column) -> Column:
        move = F.when(token.isin("[", "{"), 1).when(token.isin("]", "}"), -1).otherwise(0)
        now = acc["now"] + move
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deepest = F.aggregate(tokens, start, step, lambda acc: acc["most"])
    return df.agg(F.max(deepest)).first()[0] or 0


# Levels that are opened in one pass over what is still open.
LEVELS = 8


def _below(levels: int) -> list[Column]:
    """The nodes (path, v) of each level under the row's own node, from that node itself on."""
    level = F.array(F.struct(F.col("path"), F.col("v")))
    out = [level]
    for _ in range(levels):
        level = F.flatten(F.transform(level, _children))
        out.append(level)
    return out


def _described(last: bool) -> Callable[[Column], Column]:
    """What the profile keeps of a node; `last` says whether it lies at the depth limit."""
    return lambda node: _facts(node, last)


def _facts(node: Column, last: bool) -> Column:
    v = node["v"]
    items, members = _as_list(v), _as_object(v)
    is_list, is_object = items.isNotNull(), members.isNotNull()
    # only values are asked for their schema, as that of a container takes in all it holds
    kind = F.when(is_list, "ARRAY").when(is_object, "OBJECT").otherwise(
        F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)
    )
    size = F.when(is_list, F.size(items)).when(is_object, F.size(members)).cast("bigint")
    text = F.when(~is_list & ~is_object, F.try_variant_get(v, "$", "string"))
    return F.struct(
        node["path"].alias("path"),
        kind.alias("kind"),
        size.alias("size"),
        text.alias("text"),
        F.lit(last).alias("last"),
    )


def structure_profile(df: DataFrame, json: str = "json", max_depth: int | None = None) -> DataFrame:
    """(path, kind, values, min_size, max_size, sample) of all documents, however deep.

    Size counts the entries of an object or list. List items share the path ``name[]``. With ``max_depth``
    containers at that depth are listed without looking inside, and the column ``unopened`` counts those that
    hold anything. Documents that do not parse have no rows.

    A pass opens some levels of every document. Containers that hold more are written to the shared folder
    with their paths, and the next pass goes on from them alone, until none is left. Shallow documents take
    one pass, and each node of a deep one is opened once.
    """
    limited = max_depth is not None
    still_open = (
        df.select(F.lit("$").alias("path"), parsed(json).alias("v")).filter(F.col("v").isNotNull())
    )
    nodes, depth = None, 0
    while True:
        levels = min(LEVELS, max_depth - depth) if limited else LEVELS
        below = _below(levels)
        ended = limited and depth + levels >= max_depth
        # the first node of a later pass was described as the last one of the pass before
        described = [
            F.transform(level, _described(ended and i == levels))
            for i, level in enumerate(below)
            if i > 0 or depth == 0
        ]
        if described:
            found = still_open.select(F.inline(F.concat(*described)))
            nodes = found if nodes is None else nodes.unionByName(found)
        depth += levels
        if ended:
            break
        holds = F.filter(
            below[-1],
            lambda n: (F.size(F.coalesce(_as_list(n["v"]), F.array().cast("array<variant>"))) > 0)
            | (F.size(F.coalesce(F.map_keys(_as_object(n["v"])), F.array().cast("array<string>"))) > 0),
        )
        still_open = written(still_open.select(F.inline(holds)), "json_open")
        if still_open.isEmpty():
            break
    return nodes.groupBy("path", "kind").agg(
        F.count(F.lit(1)).alias("values"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        shorten(F.min("text")).alias("sample"),
        *([F.count_if(F.col("last") & (F.col("size") > 0)).alias("unopened")] if limited else []),
    )


def _as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _children(node: Column) -> Column:
    """The entries of an object or list node with their paths; nothing for a value."""

    def entry(suffix: Column, v: Column) -> Column:
        return F.struct(F.concat(node["path"], suffix).alias("path"), v.alias("v"))

    items = F.transform(_as_list(node["v"]), lambda e: entry(F.lit("[]"), e))
    members = F.transform(
        F.map_entries(_as_object(node["v"])),
        lambda e: entry(F.concat(F.lit("."), e["key"]), e["value"]),
    )
    return F.coalesce(items, members, F.filter(F.array(node), lambda _: F.lit(False)))


def merged_schema(df: DataFrame, json: str = "json") -> DataFrame:
    """One schema covering all documents."""
    return df.agg(F.schema_of_variant_agg(parsed(json)).alias("schema"))
