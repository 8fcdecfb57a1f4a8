"""One query per operator over its whole table, beside SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.llm import bpe, chat, jaccard, language, lines, mixing, nearest, text_queries, topk, toxicity, wordpiece
from pagemark.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("text_sha256"))


OP1 = """
with parts as (select doc_id, string_split(text, chr(10)) as p from documents),
raw as (select doc_id, unnest(range(0, len(p))) as line_no, unnest(p) as part from parts),
found as (
  select doc_id, line_no, part,
    trim(part, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) as line from raw),
firsts as (
  select line, length(line) as size, length(line) // 2 as half, min((doc_id, line_no)) as place
  from found where line <> '' group by line),
met as (
  select a.line as x, b.line as y, a.place as px, b.place as py, a.size as sx, b.size as sy
  from firsts a join firsts b
  on b.size >= 30 and a.size between b.size and b.size + 1 and a.line <> b.line
  and (left(a.line, b.half) = left(b.line, b.half) or right(a.line, b.size - b.half) = right(b.line, b.size - b.half))),
split as (
  select *, len(list_filter(range(1, sy::bigint + 1), lambda i: left(x, i) = left(y, i))) as same from met),
near as (
  select x, y, px, py from split
  where substr(x, same::bigint + 2) = substr(y, same::bigint + 1 + (case when sx = sy then 1 else 0 end))),
gone as (
  select case when px > py then x else y end as line from near),
kept as (
  select doc_id, f.line_no, part, f.line,
    f.line = '' or ((f.doc_id, f.line_no) = d.place and f.line not in (select line from gone)) as stays
  from found f left join firsts d using (line))
select doc_id,
  count(*) filter (where line <> '') as n_lines,
  count(*) filter (where line <> '' and stays) as n_kept,
  sha256(coalesce(string_agg(part, chr(10) order by line_no) filter (where stays), '')) as text_sha256
from kept group by doc_id
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


OP2 = """
with sizes as (select source, count(*) as size from documents group by source),
rates as (
  select source, (select sum(size) from sizes) * sqrt(size) / (select sum(sqrt(size)) from sizes) / size as rate
  from sizes),
steps as (
  select source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) over (partition by source order by k) as step
  from (select source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::bigint + 1)) as k from rates)),
drawn as (
  select d.*, ('0x' || substr(md5('17|' || doc_id), 1, 13))::bigint / 4503599627370496.0 as point from documents d),
counted as (
  select d.doc_id, count(*) filter (where step <= point) as copies
  from drawn d join steps s using (source) group by d.doc_id),
copied as (
  select doc_id, unnest(range(1, copies + 1))::int as copy_no from counted)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy_no,
  ('0x' || substr(md5('18|' || doc_id || '|' || copy_no), 1, 13))::bigint as shuffle_key
from copied c join documents d using (doc_id)
"""


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=85)


OP3 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then []
    else list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
      lambda i: array_to_string(w[i:i + 3], ' '))) end as s
  from words),
held as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.doc_id as a, b.doc_id as b
  from held a join held b using (shingle)
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, other) as (
  select a, b from links
  union
  select r.doc_id, l.b from reach r join links l on r.other = l.a)
select s.doc_id, len(s.s)::bigint as n_shingles, coalesce(min(r.other), s.doc_id) as component_id
from sets s left join reach r using (doc_id) group by s.doc_id, len(s.s)
"""


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # a conversation whose texts hold the template's own control strings
    said = F.lit(r"\### Assistant: </turn> ok")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    out = chat.format_conversations(rows.unionByName(planted))
    turns = chat.read_turns(F.col("formatted"))
    loss = chat.read_loss_text(F.col("segments"))
    lines = F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return out.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


OP4 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all
  select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized as (
  select *,
    4 + length(role) + 2 + 8
      + length(replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\e')) as chars,
    row_number() over w as place,
    lag(role) over w as before
  from rows window w as (partition by conv_id order by turn, role, text)),
checked as (
  select *,
    case when role = 'system' then place = 1
         when role = 'user' then place = 1 or before in ('system', 'assistant')
         else role = 'assistant' and before = 'user' end as fits
  from sized)
select conv_id,
  count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars,
  bool_and(coalesce(fits, false)) and arg_max(role, place) = 'assistant' as valid
from checked group by conv_id
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(~held_out))
    return language.identify(
        docs.select("doc_id", "text", held_out.alias("held_out")), model, keep_text=False
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP7 = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from whole q join whole c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = language.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        "predicted",
        F.size("passages").alias("n_passages"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.count_tokens(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mixing": op2_mixing,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_chat_format": op4_chat_format,
    "op5_language_id": op5_language_id,
    "op6_nearest": op6_nearest,
    "op7_exact_topk": op7_exact_topk,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_byte_bpe": op10_byte_bpe,
} | text_queries.QUERIES
ORACLE = {
    "op1_line_dedup": OP1,
    "op2_mixing": OP2,
    "op3_ngram_jaccard": OP3,
    "op4_chat_format": OP4,
    "op7_exact_topk": OP7,
} | text_queries.ORACLE
