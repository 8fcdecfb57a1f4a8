"""Byte-level BPE beside the tiktoken library."""

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pagemark.llm import bpe

SCHEMA = "doc_id long, text string, ids int"


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


TEXTS = [
    None,
    "",
    " ",
    "Hello world, it's 2024!  \n\n x",
    "naïve café — 東京 🙂🙂 ‍ é",
    "a" * 3000,
    "ab" * 2000 + " end",
    " " * 2500 + "x" + " " * 900,
    ("word " * 150 + "don't stop\n") * 9,
    "x" * 511 + " " + "y" * 511 + "'s" + "z" * 1300 + " tail",
    ("é" * 700 + " ") * 4,
    "12345 " * 400,
]


@pytest.mark.parametrize("chunk", [512, 700, bpe.CHUNK])
def test_same_ids_as_the_library(spark, library, chunk):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS)]
    got = bpe.encode_documents(spark.createDataFrame(rows, SCHEMA), chunk=chunk).collect()
    assert len(got) == len(rows)
    for row in got:
        text = TEXTS[row.doc_id] or ""
        ids = np.frombuffer(bytes(row.ids), dtype="<u4").tolist()
        assert ids == library.encode_ordinary(text), row.doc_id
        assert row.n_tokens == len(ids)
        assert bytes(row.decoded) == text.encode()


def test_repeated_rows_null_ids_and_empty_tables(spark):
    long = "some words " * 200
    rows = [(1, long, 0), (1, long, 1), (1, "short", 0), (None, long, 0), (None, None, 0), (1, long + "!", 0)]
    got = bpe.encode_documents(spark.createDataFrame(rows, SCHEMA), chunk=512).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode()) for r in got) == sorted(
        (i or 0, t or "") for i, t, _ in rows
    )
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_real_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: library.encode_ordinary(r.text) for r in docs.collect()}
    for row in bpe.encode_documents(docs, chunk=600).collect():
        assert np.frombuffer(bytes(row.ids), dtype="<u4").tolist() == want[row.doc_id]
