"""Greedy piece counts beside a plain longest-match loop."""

import base64

import public_tokenizers
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemark.llm import wordpiece

SCHEMA = "doc_id long, text string, n_tokens string"


def greedy(word: bytes, vocabulary: set[bytes]) -> int:
    n = at = 0
    longest = max(map(len, vocabulary))
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in vocabulary), 0)
        if not size:
            return 1
        at += size
        n += 1
    return n


@settings(max_examples=300, deadline=None)
@given(
    st.sets(st.text("abc", min_size=1, max_size=5).map(str.encode), min_size=1, max_size=12),
    st.lists(st.text("abc", max_size=30).map(str.encode), max_size=8),
)
def test_any_vocabulary(vocabulary, words):
    counter = wordpiece.PieceCounter(vocabulary)
    assert [counter.count(w) for w in words] == [greedy(w, vocabulary) for w in words]


def test_documents(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        vocabulary = {base64.b64decode(x.split()[0]) for x in f}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    odd = [(-1, None, "x"), (-2, "", "x"), (-2, "", "x"), (None, "a  b", "x"), (-3, "z" * 5000 + " 東京🙂", "x")]
    docs = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(odd, SCHEMA).select("doc_id", "text")
    )
    find = regex.compile(public_tokenizers.PATTERN).findall
    want = []
    for r in docs.collect():
        words = find(r.text or "")
        want.append((r.doc_id or 0, len(words), sum(greedy(w.encode(), vocabulary) for w in words)))
    got = [(r.doc_id or 0, r.n_words, r.n_tokens) for r in wordpiece.count_tokens(docs).collect()]
    assert sorted(got) == sorted(want)


def test_long_word_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a" * 1_000_000, "x")], SCHEMA)
    assert wordpiece.count_tokens(docs).first().n_tokens > 0
    assert wordpiece.count_tokens(docs.limit(0)).count() == 0
