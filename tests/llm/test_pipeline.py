"""Each pipeline stage beside plain Python on its own input, and the whole run."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import test_jaccard
import test_lines
import test_mixing

import __spark_entry__ as driver
import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage, each written and read again."""
    folder, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        result.write.parquet(str(folder / name))
        again = spark.read.parquet(str(folder / name))
        out[name] = docs.collect(), again.collect(), again.columns
        docs = again
    return out


def test_contract():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_jaccard", "mixing", "byte_bpe"]
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in driver.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


def test_stage_columns(stages):
    for name in list(stages)[:-1]:
        assert stages[name][2] == COLUMNS


def test_language_keeps_clean_documents(stages):
    before, after, _ = stages["language_id"]
    kept = {r.doc_id: r for r in after}
    assert all(kept[r.doc_id] == r for r in before if r.doc_id in kept)
    lost = [r for r in before if r.doc_id not in kept]
    assert len(lost) <= 0.02 * len(before)
    assert all(len(r.text) < 200 for r in lost)


def test_stage_lines(stages):
    before, after, _ = stages["line_dedup"]
    want = test_lines.brute([(r.doc_id, r.text) for r in before], 1, 30)
    assert {r.doc_id: r.text for r in after} == {d: t for d, t, _, k in want if k}
    assert all(r.n_chars == len(r.text) for r in after)


def test_stage_near_duplicates(stages):
    before, after, _ = stages["ngram_jaccard"]
    want = test_jaccard.brute([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {d for d, _, c in want if d == c}


def test_near_duplicates_that_share_an_id_with_another_text(spark):
    copied = "one line of many words that another document has too, and it goes on for a while"
    own = "some text of its own that no other document holds, whatever the id says about that"
    more = "zebras and yaks are in the third text, which nobody has ever copied from anyone"
    rows = [
        (1, copied), (5, copied + " "), (5, own), (5, more), (5, more), (7, own + " "),
        (8, ""), (8, "two words"), (None, copied), (None, copied),
    ]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert got.columns == COLUMNS
    want = [(1, copied), (5, own), (5, more), (8, ""), (8, "two words"), (None, copied), (None, copied)]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)


def test_stage_mixture(stages):
    before, after, _ = stages["mixing"]
    sizes = Counter(r.source for r in before)
    shares = sum(n**0.5 for n in sizes.values())
    want = Counter()
    for r in before:
        rate = len(before) * sizes[r.source] ** 0.5 / shares / sizes[r.source]
        want[r.doc_id] = test_mixing.inverse(rate, test_mixing.point(r.doc_id))
    assert Counter(r.doc_id for r in after) == +want


def test_stage_token_ids(stages):
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    before, after, _ = stages["byte_bpe"]

    def row(r):
        ids = np.array(library.encode_ordinary(r.text), dtype="<u4").tobytes()
        return r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()

    assert Counter(row(r) for r in before) == Counter(tuple(r) for r in after)


def test_run_equals_the_stages(spark, stages):
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == Counter(tuple(r) for r in stages["byte_bpe"][1])


def test_odd_rows_go_through_every_stage(spark, stages):
    rows = [
        (1, None, "en", "a", 0),
        (2, "", None, None, 0),
        (None, "the and of that is a sentence without an id\nthe and of that", "en", "a", 1),
        (3, "the and of that is a sentence with an id\nanother line of it", "en", None, 2),
        (3, "the and of that is a sentence with an id\nanother line of it", "en", None, 2),
        (4, "word " * 30_000, "en", "b", 3),
    ]
    for docs in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA)):
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SMALL)
            assert found.count() >= 0
            if found.columns == COLUMNS:
                docs = spark.createDataFrame(found.collect(), SCHEMA)
