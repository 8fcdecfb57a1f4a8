"""The manifest beside plain recursion in Python."""

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pagemark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, proof string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def grow(digests):
    """Root, and the siblings of every leaf, level by level."""
    paths, owners = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, held = [], []
        for i in range(0, len(digests), 16):
            run = digests[i : i + 16]
            for j in range(len(run)):
                for leaf in owners[i + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha("".join(run)))
            held.append([x for o in owners[i : i + 16] for x in o])
        digests, owners = above, held
    return digests[0], paths


def plain(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row["source"]].append(((row["doc_id"] is not None, row["doc_id"] or 0), leaf_of(row), row["doc_id"]))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    grown = {}
    for name in names:
        leaves = sorted(trees[name], key=lambda x: x[:2])
        grown[name] = (leaves, *grow([x[1] for x in leaves]))
    root, upper = grow([grown[n][1] for n in names])
    out = Counter()
    for name, more in zip(names, upper):
        leaves, subroot, paths = grown[name]
        for (_, leaf, doc_id), path in zip(leaves, paths):
            out[doc_id, leaf, subroot, root, tuple(path + more)] += 1
    return out


def held(spark, rows):
    docs = spark.createDataFrame([tuple(r.values()) + ("old",) for r in rows], SCHEMA)
    leaves = docs.withColumn("leaf", merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]))
    out = merkle.manifest(leaves)
    assert out.columns == [*SCHEMA.replace(" string", "").replace(" long", "").split(", ")[:-1], "leaf", "subroot", "root", "proof"]
    out = out.withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof")))
    got = out.collect()
    assert all(r.folded == r.root for r in got)
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in got)


def row(doc_id, source, text, lang="en"):
    return {"doc_id": doc_id, "source": source, "lang": lang, "n_chars": None if text is None else len(text), "text": text}


def test_odd_rows(spark):
    rows = [row(i, "a", f"text {i}") for i in range(40)]
    rows += [row(3, "a", "text 3"), row(3, "a", "other"), row(None, "a", "no id"), row(None, "a", "no id")]
    rows += [row(5, None, None, None), row(6, "", ""), row(7, "lone", "Größe\n" * 2000), row(8, "é", "x"), row(9, "z", "x")]
    assert held(spark, rows) == plain(rows)


def test_one_row_and_none(spark):
    rows = [row(1, "a", "only")]
    assert held(spark, rows) == plain(rows)
    docs = spark.createDataFrame([], "source string, doc_id long, leaf string")
    assert merkle.manifest(docs).columns == ["source", "doc_id", "leaf", "subroot", "root", "proof"]
    assert merkle.manifest(docs).count() == 0


def test_trees_of_several_rounds_and_many_trees(spark):
    rows = [row(i, "big", f"t{i}") for i in range(merkle.BLOCK + 17)]
    rows += [row(i, f"s{i}", f"t{i}") for i in range(300)]
    assert held(spark, rows) == plain(rows)


def test_a_changed_leaf_or_sibling_does_not_lead_to_the_root(spark):
    rows = [row(i, "a", f"text {i}") for i in range(20)]
    docs = spark.createDataFrame([tuple(r.values()) + ("old",) for r in rows], SCHEMA)
    leaves = docs.withColumn("leaf", merkle.leaf_digest(F.col("doc_id"), F.col("text")))
    out = merkle.manifest(leaves)
    wrong = merkle.leaf_digest(F.col("doc_id"), F.upper("text"))
    assert out.where(merkle.fold(wrong, F.col("proof")) == F.col("root")).count() == 0
    moved = F.transform("proof", lambda s: F.struct(s.after.alias("before"), s.before.alias("after")))
    assert out.where(merkle.fold(F.col("leaf"), moved) == F.col("root")).count() == 0
