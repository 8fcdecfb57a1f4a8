"""Queries of the operators over whole texts and tables that came last, beside their SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.llm import collocations, merkle, repeats
from pagemark.llm.common import table


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, top=2_000)


OP11 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from split),
grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from places, range(1, 6) as t(k) where i + k - 1 <= len(w)),
totals as (select lang, sum(len(w))::bigint as n from split group by lang),
counts as (
  select lang, k, phrase, string_split(phrase, ' ') as w, count(*) as f
  from grams group by lang, k, phrase having count(*) >= 100),
inner_parts as (
  select lang, f, unnest(flatten(list_transform(range(2, k), lambda s:
    list_transform(range(1, k - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))))) as phrase
  from counts where k > 2),
covered as (select lang, phrase, max(f) as within from inner_parts group by lang, phrase),
kept as (
  select c.* from counts c left join covered v using (lang, phrase)
  where k >= 2 and (within is null or 100 * within < 100 * f)),
cuts as (
  select lang, phrase, f as a, j, array_to_string(w[1:j], ' ') as one, array_to_string(w[j + 1:k], ' ') as other
  from kept, range(1, 5) as t(j) where j < k),
scored as (
  select c.lang, c.phrase, c.a, c.j, x.f as l, y.f as r, t.n,
    (1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f) as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = c.one
  join counts y on y.lang = c.lang and y.phrase = c.other
  join totals t on t.lang = c.lang),
lowest as (
  select lang, phrase, a, n, unnest(min({'score': score, 'j': j, 'l': l, 'r': r})) from scored group by lang, phrase, a, n),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase)::int as rank from lowest)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked where rank <= 2000
"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), width=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP12 = r"""
with split as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
places as (select doc_id, w, unnest(range(1, len(w) - 11)) as i from split),
windows as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as held from places),
firsts as (select held, min(doc_id) as first from windows group by held),
gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as i
  from windows join firsts using (held) where first < doc_id),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from split),
kept as (
  select k.doc_id, string_agg(k.word, ' ' order by k.i) as left_text, count(*) as n
  from words k anti join gone g on k.doc_id = g.doc_id and k.i = g.i group by k.doc_id)
select s.doc_id, len(s.w)::bigint as n_words, (len(s.w) - coalesce(k.n, 0))::bigint as n_removed,
  sha256(coalesce(k.left_text, '')) as kept_sha256
from split s left join kept k using (doc_id)
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.leaf_digest(*fields, F.col("text")).alias("leaf"),
        F.when(chosen, merkle.leaf_digest(*fields, lower)).alias("altered"),
    )
    out = merkle.manifest(leaves)
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("proof"))
    return out.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _levels(first: str, name: str, depth: int) -> tuple[list[str], str]:
    """SQL tables of the levels above `first(tree, pos, digest, size)`, and the name of the last one."""
    parts, last = [], first
    for i in range(depth):
        here = f"{name}{i + 1}"
        parts.append(
            f"{here} as (select tree, pos // 16 as pos, case when any_value(size) = 1 then any_value(digest) "
            "else sha256(string_agg(digest, '' order by pos)) end as digest, "
            f"(any_value(size) + 15) // 16 as size from {last} group by tree, pos // 16)"
        )
        last = here
    return parts, last


def op13_sql() -> str:
    """Six levels below the subroots, four above, in plain joins."""
    code = ", ".join(
        f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars")
    )
    text = "coalesce(strlen({0}) || ':' || {0}, '-')"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    crc = (
        "xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform("
        "string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, 3988292384 * (c & 1)) end))"
    )
    parts = [
        f"docs as (select doc_id, coalesce('s' || source, 'n') as tree, sha256(concat({code}, {text.format('text')})) as leaf, "
        f"case when {crc} % 5 = 0 then sha256(concat({code}, {text.format(lower)})) end as altered from documents)",
        "low0 as (select tree, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, leaf as digest, "
        "count(*) over (partition by tree) as size, doc_id, leaf, altered from docs)",
    ]
    more, low = _levels("low0", "low", 6)
    parts += more
    parts.append(
        f"up0 as (select '' as tree, row_number() over (order by tree) - 1 as pos, digest, count(*) over () as size, tree as name from {low})"
    )
    more, up = _levels("up0", "up", 4)
    parts += more
    # a row per leaf and level: the siblings before and after, both empty where a tree has ended
    runs, joins, folded = [], [], "coalesce(l.altered, l.leaf)"
    levels = [("low", i, f"l.pos // {16**i}", "l.tree") for i in range(6)]
    levels += [("up", i, f"u.pos // {16**i}", "''") for i in range(4)]
    proof = []
    for name, i, at, tree in levels:
        run = f"r_{name}{i}"
        parts.append(
            f"{run} as (select a.tree, a.pos, a.size, "
            "coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as before, "
            "coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as after "
            f"from {name}{i} a join {name}{i} b on a.tree = b.tree and a.pos // 16 = b.pos // 16 group by a.tree, a.pos, a.size)"
        )
        joins.append(f"join {run} on {run}.tree = {tree} and {run}.pos = {at}")
        proof.append(f"{run}.before || {run}.after")
        runs.append(run)
    parts.append(
        f"paths as (select l.doc_id, l.leaf, u.digest as subroot, {' || '.join(proof)} as siblings, l.altered, "
        + ", ".join(f"{r}.size as s_{r}, {r}.before as b_{r}, {r}.after as a_{r}" for r in runs)
        + f" from low0 l join up0 u on u.name = l.tree {' '.join(joins)})"
    )
    last = "paths"
    for n, run in enumerate(runs):
        start = "coalesce(altered, leaf)" if n == 0 else "folded"
        parts.append(
            f"f{n} as (select *{'' if n == 0 else ' exclude (folded)'}, case when s_{run} = 1 then {start} "
            f"else sha256(concat(b_{run}, {start}, a_{run})) end as folded from {last})"
        )
        last = f"f{n}"
    return (
        "with " + ",\n".join(parts) + f"\nselect doc_id, leaf, subroot, (select digest from {up}) as root, "
        f"sha256(siblings) as proof_sha256, folded as folded_root, folded = (select digest from {up}) as verified from {last}"
    )


QUERIES = {
    "op11_collocations": op11_collocations,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE = {"op11_collocations": OP11, "op12_substring_dedup": OP12, "op13_merkle_manifest": op13_sql()}
