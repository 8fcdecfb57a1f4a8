"""N-gram Jaccard join: size-aware, heavy sets scan inverted lists, light ones enumerate subsets.

Documents with equal shingle sets form a class, and only one set of each class goes on. Two sets that link
share nearly all shingles, so they also share some among the first few of any common order. The order is:
shingles with small hashes first, the rare before the frequent, then all others by hash. Rarity is
counted over all classes, for the shingles with small hashes only; a shingle of one class alone links
nothing and needs no list.

- A heavy set puts its first shingles into inverted lists and scans them.
- A light set enumerates the pairs of its first shingles (one more of them must then be taken): two light
  sets meet in a pair, whose list is never longer than the shorter of the two shingle lists.

The boundary between light and heavy is the size at which the counted list entries cost least. Short
lists give candidate pairs, long ones are cut into blocks whose sets are compared in place, so what a
hot list sends on is a forest of links and never all its pairs. All candidates are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.llm.common import components, stored

#: Shingles below this hash are counted: a quarter of all, the same for every document.
COUNTED = 1 << 62
#: Longest list that gives pairs, and sets in a block of a longer one.
SHORT_LIST, BLOCK = 64, 1_024
#: Largest size the light sets may reach.
LARGEST_LIGHT = 64
#: Classes whose ids may be broadcast, at some 40 bytes each.
BROADCAST_ROWS = 1_000_000
#: Words whose hashes a task remembers, at some 150 bytes each.
REMEMBERED = 1 << 18


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `width` words; of the whole text if it has fewer.

    Words are what ASCII white space separates, with A-Z in lower case.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    count = len(codes) - width + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(width):
        mixed = (mixed ^ codes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def needed_overlap(size, percent: int):
    """Shingles a set of this size must share with any set it links to, at least."""
    return (size * percent + 99) // 100


def first_shingles(
    batches: Iterator[pa.RecordBatch], width: int, percent: int
) -> Iterator[pa.RecordBatch]:
    """Per document: size and digest of its set, and the shingles that may come first in the order."""
    hashes = WordHashes()
    for batch in batches:
        sizes, digests, counted, heads = [], [], [], []
        for text in batch.column("text"):
            found = shingles(text.as_py(), width, hashes)
            n = len(found)
            small = int(np.searchsorted(found, np.uint64(COUNTED)))
            first = n - needed_overlap(n, percent) + 2
            sizes.append(n)
            digests.append(xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63))
            counted.append(small)
            heads.append(found[: max(small, min(first, n))].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.int64()),
                pa.array(counted, pa.int64()),
                pa.array(heads, pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_key", "n", "set_id", "counted", "head"],
        )


def whole_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        found = [shingles(t.as_py(), width, hashes) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([xxhash.xxh3_64_intdigest(f.tobytes()) - (1 << 63) for f in found], pa.int64()),
                pa.array([f.tobytes() for f in found], pa.binary()),
            ],
            names=["set_id", "shingles"],
        )


def linked(a: int, b: int, shared, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def verify_pairs(pairs: pd.DataFrame, one: pd.DataFrame, percent: int) -> pd.DataFrame:
    """All partners `b` of one set `a`, each beside its shingles -> those that link."""
    kept = []
    if len(pairs) and len(one):
        ours = np.frombuffer(one.own.iloc[0], np.uint64)
        for b, data in zip(pairs.b, pairs.shingles, strict=True):
            theirs = np.frombuffer(data, np.uint64)
            shared = len(np.intersect1d(ours, theirs, assume_unique=True))
            if linked(len(ours), len(theirs), shared, percent):
                kept.append(b)
        return pd.DataFrame({"a": np.full(len(kept), one.own_id.iloc[0]), "b": kept}).astype("int64")
    return pd.DataFrame({"a": [], "b": []}).astype("int64")


def link_block(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Sets of a block, or of two blocks, of one list -> a forest of their links, and links per set.

    Every set counts what it shares with all others through the inverted lists of the block.
    """
    group = group.drop_duplicates("set_id").sort_values(["n", "set_id"])
    ids, side = group.set_id.to_numpy(), group.side.to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group.shingles]
    sizes = group.n.to_numpy()
    flat = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    _, codes = np.unique(flat, return_inverse=True)
    order = np.argsort(codes, kind="stable")
    holders = owners[order]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(codes))])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    a, b = [], []
    two = side.min() != side.max()
    for i in range(len(sets)):
        mine = codes[begins[i] : begins[i + 1]]
        shared = np.bincount(
            np.concatenate([holders[bounds[c] : bounds[c + 1]] for c in mine]), minlength=len(sets)
        )
        partners = np.flatnonzero(linked(sizes[i], sizes, shared, percent))
        for j in partners.tolist():
            if j > i and (not two or side[i] != side[j]) and top(i) != top(j):
                root[top(j)] = top(i)
                a.append(ids[i])
                b.append(ids[j])
    return pd.DataFrame({"a": a, "b": b}).astype("int64")


def light_boundary(prefixes: DataFrame) -> int:
    """The size up to which sets enumerate pairs: where the counted entries and meetings cost least."""
    df = F.transform("firsts", lambda s: s.df)
    scan = F.aggregate(df, F.lit(0).cast("long"), lambda s, x: s + x + 1)
    # pairs are met in the list of their rarer shingle, which comes first
    pairs = F.aggregate(
        F.transform(df, lambda x, i: (x + 1) * (F.size("firsts") - i - 1)),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )
    sums = (
        prefixes.where(F.col("n") <= LARGEST_LIGHT)
        .groupBy("n")
        .agg(F.sum(scan).alias("scan"), F.sum(pairs).alias("pairs"))
        .collect()
    )
    cost = {r.n: (r.scan, r.pairs) for r in sums}  # one row per size, LARGEST_LIGHT at most

    def total(boundary: int) -> int:
        # the largest light sets stand in the lists as well, for the heavy ones to find
        return sum(
            (pairs if n <= boundary else 0) + (scan if 100 * n > 85 * boundary else 0)
            for n, (scan, pairs) in cost.items()
        )

    return min(range(LARGEST_LIGHT + 1), key=lambda x: (total(x), x))


def list_entries(prefixes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """key, df, set_id, n, scan: entries of the inverted lists and of the pairs of light sets."""
    light = F.col("n") <= boundary
    scans = F.when(~light | (100 * F.col("n") > percent * boundary), F.col("firsts"))
    single = F.transform(
        F.coalesce(scans, F.array().cast("array<struct<df:bigint,h:bigint>>")),
        lambda s: F.struct(s.h.alias("key"), s.df.alias("df"), F.lit(True).alias("scan")),
    )
    double = F.when(
        light,
        F.flatten(
            F.transform(
                "firsts",
                lambda s, i: F.transform(
                    F.slice("firsts", i + 2, F.size("firsts")),
                    lambda t: F.struct(
                        F.xxhash64(s.h, t.h).alias("key"), s.df.alias("df"), F.lit(False).alias("scan")
                    ),
                ),
            )
        ),
    ).otherwise(F.array().cast("array<struct<key:bigint,df:bigint,scan:boolean>>"))
    return prefixes.select("set_id", "n", F.explode(F.concat(single, double)).alias("e")).select(
        "set_id", "n", "e.*"
    )


def sets_of(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """set_id, shingles of the chosen classes, read again from one document of each."""
    keyed = docs.select("text", F.xxhash64("text").alias("text_key"), F.col("doc_id").alias("_id"))
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    mine = (keyed.text_key == chosen["rep.text_key"]) & keyed["_id"].eqNullSafe(chosen["rep.doc_id"])
    texts = keyed.join(chosen, mine, "left_semi").select("text")
    found = texts.mapInArrow(lambda b: whole_sets(b, width), "set_id long, shingles binary")
    return found.dropDuplicates(["set_id"])


def jaccard_links(docs: DataFrame, width: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(members, links): doc_id, n, set_id of every row of `docs`, and set ids a, b of linked classes.

    Links between classes are those of short lists, and for long lists a forest with the same reach.
    """
    docs = docs.select("doc_id", "text")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    members = stored(
        keyed.mapInArrow(
            lambda b: first_shingles(b, width, percent),
            f"doc_id {kind}, text_key long, n long, set_id long, counted long, head array<long>",
        ),
        "members",
    )
    # a set links to another only if it is large enough to miss one shingle
    least = next(n for n in range(1, 1_000) if 100 * n >= percent * (n + 1))
    able = members.where(F.col("n") >= least)
    heads = able.groupBy("set_id").agg(F.first("head").alias("head"))
    rows = heads.select("set_id", F.explode("head").alias("h"))
    shared = rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    firsts = (
        rows.join(shared, "h")
        .withColumn("late", ~F.col("h").between(0, COUNTED - 1))
        .groupBy("set_id")
        .agg(F.array_sort(F.collect_list(F.struct("late", "df", "h"))).alias("held"))
    )
    sizes = able.groupBy("set_id").agg(
        F.first("n").alias("n"),
        F.first("counted").alias("counted"),
        F.min(F.struct("doc_id", "text_key")).alias("rep"),
    )
    early = F.size(F.filter("held", lambda s: ~s.late))
    first = F.col("n") - needed_floor(F.col("n"), percent) + 2
    # shingles of this class alone come first; the rest of the first ones are taken from those shared
    rest = F.when(first > F.col("counted"), F.size("held")).otherwise(
        F.greatest(first - (F.col("counted") - early), F.lit(0))
    )
    taken = F.slice("held", F.lit(1), rest.cast("int"))
    prefixes = (
        firsts.join(sizes, "set_id")
        .select("set_id", "n", "rep", F.transform(taken, lambda s: F.struct(s.df, s.h)).alias("firsts"))
        .where("size(firsts) > 0")
    )
    prefixes = stored(prefixes, "prefixes")
    boundary = light_boundary(prefixes)
    entries = list_entries(prefixes, boundary, percent)
    short, long = entries.where(F.col("df") <= SHORT_LIST), entries.where(F.col("df") > SHORT_LIST)

    a, b = short.alias("a"), short.alias("b")
    meet = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.scan") == F.col("b.scan"))
        & (F.col("a.set_id") < F.col("b.set_id"))
        & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
        & (~F.col("a.scan") | (F.greatest("a.n", "b.n") > boundary))
    )
    pairs = stored(
        a.join(b, meet).select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b")).distinct(),
        "pairs",
    )
    # long lists: one entry a set, key and block; a pair of blocks sees the sets of both
    blocks = F.ceil(F.col("df") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("set_id"), blocks).cast("int")
    hot = (
        long.select("key", "scan", "set_id", "n", blocks.alias("blocks"), block.alias("side"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
    )
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).union(long.select("set_id"))
    chosen = ids.distinct().join(prefixes.select("set_id", "rep"), "set_id").select("rep")
    sets = stored(sets_of(docs, stored(chosen, "chosen"), width), "sets")
    forest = (
        hot.join(sets, "set_id")
        .groupBy("key", "scan", "low", "high")
        .applyInPandas(lambda g: link_block(g, percent), "a long, b long")
    )
    partners = pairs.join(sets.withColumnRenamed("set_id", "b"), "b")
    ours = sets.select(F.col("set_id").alias("own_id"), F.col("shingles").alias("own"))
    direct = (
        partners.groupBy("a")
        .cogroup(ours.groupBy("own_id"))
        .applyInPandas(lambda p, s: verify_pairs(p, s, percent), "a long, b long")
    )
    links = stored(direct.unionByName(forest).distinct(), "links")
    return members.select("doc_id", "n", "set_id"), links


def needed_floor(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs(doc_id, text)`.

    Two rows link when 100 * shared >= percent * united, over their sets of distinct runs of `width` words
    (a text with fewer words: all of them as one run). component_id is the smallest doc_id among the
    rows reachable by links, the row itself included. NULL, empty and blank texts have an empty set and
    are linked with nothing. Repeated rows stay and are linked; NULL doc_id is never the smallest, and a
    component of such rows alone has the id NULL. Other columns are ignored.
    """
    members, links = jaccard_links(docs, width, percent)
    roots = components(links)
    classes = members.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(roots, classes.set_id == roots.node, "left").select(
        "set_id", "least", F.coalesce("root", "set_id").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("set_id", "component_id")
    empty = members.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return (
        members.where("n > 0")
        .join(named, "set_id")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionByName(empty)
    )
