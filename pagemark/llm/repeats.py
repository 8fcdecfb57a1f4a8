"""Substring dedup: repeated windows of words as edges of a De Bruijn graph, compacted to paths.

An edge is a window of 13 words, its nodes are the 12 words it begins and ends with. Only edges that may occur in
several rows are taken into the graph: windows that are equal also have the same smallest run of five words
in them, and a filter of bits holds the runs that several rows have.

For each edge that is left, the counts of all tasks give its source (the first document and place), whether other
documents have it, and whether the edges before and after it are always the same. Where both sides of a
node agree on that, the node does not branch: a join brings such neighbours together at their source, and
edges that find no neighbour begin or end a path. Every document that holds the first edge of a path holds all
of it. So a document is searched for the ends of paths alone; a span is taken out if both ends lie as far
apart as they do in the source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pagemark.llm.common import free_name, stored
from pagemark.llm.filters import HashFilter
from pagemark.llm.jaccard import WordHashes

#: Words of a run that stands for the windows around it.
RUN = 5
#: Words, or windows, that a task handles together, and hashes that come together in one.
CHUNK, TOGETHER = 1 << 19, 1 << 21
#: Bits of the filters, as powers of two: 32 MB at most, and so many for each member while there is room.
MOST_BITS, SPARE_BITS = 28, 5
#: Ends of paths that may be broadcast, at some 40 bytes each.
BROADCAST_ROWS = 1_000_000
_LAST = (1 << 63) - 1
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of what `a` and `b` stand for, one behind the other."""
    out = a * _MIX[0] + (b ^ (b >> np.uint64(32))) * _MIX[1]
    out ^= out >> np.uint64(29)
    out *= _MIX[2]
    return out ^ (out >> np.uint64(32))


def grams(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` codes, put together from runs of 1, 2, 4, ..."""
    powers, size = {1: codes}, 1
    while 2 * size <= width:
        powers[2 * size] = joined(powers[size][:-size], powers[size][size:])
        size *= 2
    out, done = powers[size], size
    while done < width:
        size = 1 << (width - done).bit_length() - 1
        n = len(codes) - done - size + 1
        out = joined(out[:n], powers[size][done : done + n])
        done += size
    return out


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbours."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Chunk:
    """The words of many rows one behind the other: windows, and the run that stands for each."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.sizes = np.array([len(r) for r in rows])
        self.codes = np.concatenate(rows)
        owner = np.repeat(np.arange(len(rows)), self.sizes)
        self.begins = np.cumsum(self.sizes) - self.sizes
        n = max(0, len(self.codes) - width + 1)
        #: places of windows that lie in one row
        self.at = np.flatnonzero(owner[:n] == owner[len(owner) - n :])
        self.owner = owner[self.at]
        if n:
            runs = smallest(grams(self.codes, RUN), width - RUN + 1)[self.at]
            self.runs = joined(runs, runs)  # the smallest hashes lie close together
        else:
            self.runs = np.zeros(0, np.uint64)


def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Rows of all columns but the text, and their words as hashes."""
    hashes, rows, words, size = WordHashes(), [], [], 0
    for batch in batches:
        others = [batch.column(n).to_pylist() for n in batch.schema.names if n != "text"]
        keys = zip(*others, strict=True) if others else [()] * batch.num_rows
        for key, text in zip(keys, batch.column("text"), strict=True):
            found = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            rows.append(key)
            words.append(np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found)))
            size += len(found)
            if size >= CHUNK:
                yield rows, words
                rows, words, size = [], [], 0
    if rows:
        yield rows, words


def cuts(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of each run of equal numbers in a sorted array."""
    edges = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else []
    ends = np.append(edges[1:], len(parts)) if len(parts) else []
    for x, y in zip(edges, ends, strict=True):
        yield int(parts[x]), int(x), int(y)


def run_blocks(batches: Iterator[pa.RecordBatch], width: int, part_bits: int) -> Iterator[pa.RecordBatch]:
    """part, block: the different runs of a chunk, and whether several of its rows have them."""
    for _, words in chunked(batches):
        chunk = Chunk(words, width)
        if not len(chunk.at):
            continue
        new = np.concatenate([[True], (chunk.runs[1:] != chunk.runs[:-1]) | (chunk.owner[1:] != chunk.owner[:-1])])
        runs, owner = chunk.runs[new], chunk.owner[new]
        order = np.argsort(runs, kind="stable")
        runs, owner = runs[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        last = np.append(first[1:], len(runs)) - 1
        several, runs = owner[first] != owner[last], runs[first]
        parts, blocks = [], []
        for part, x, y in cuts(runs >> np.uint64(64 - part_bits)):
            parts.append(part)
            blocks.append((y - x).to_bytes(8, "little") + runs[x:y].tobytes() + several[x:y].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(blocks, pa.binary())], names=["part", "block"])


def repeated_runs(group: pd.DataFrame, part_bits: int, bits: int) -> pd.DataFrame:
    """The bits of one range of hashes: set for the runs that several rows have."""
    hashes, several = [], []
    for block in group.block:
        n = int.from_bytes(block[:8], "little")
        hashes.append(np.frombuffer(block, np.uint64, n, 8))
        several.append(np.frombuffer(block, bool, n, 8 + 8 * n))
    found, several = np.concatenate(hashes), np.concatenate(several)
    known = found[several]
    found = np.sort(found)
    known = np.concatenate([known, found[1:][found[1:] == found[:-1]]])
    held = np.zeros(1 << bits - part_bits, bool)
    held[((known >> np.uint64(64 - bits)) & np.uint64((1 << bits - part_bits) - 1)).astype(np.int64)] = True
    data = np.packbits(held, bitorder="little").tobytes()
    return pd.DataFrame({"part": [int(group.part.iloc[0])], "held": [pa.compress(data, codec="zstd", asbytes=True)]})


def run_filter(docs: DataFrame, width: int) -> HashFilter:
    """The filter of all runs of five words that stand for a window and that several rows have."""
    letters = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = letters // 20 + 1  # about; a third of the words stand for windows, at most
    bits = min(MOST_BITS, max(16, runs.bit_length() + SPARE_BITS))
    part_bits = min(bits - 3, max(1, (runs // TOGETHER).bit_length()))
    out = HashFilter(bits)
    blocks = docs.select("text").mapInArrow(lambda b: run_blocks(b, width, part_bits), "part long, block binary")
    parts = blocks.groupBy("part").applyInPandas(
        lambda g: repeated_runs(g, part_bits, bits), "part long, held binary"
    )
    size = len(out.data) >> part_bits
    for row in parts.toArrow().to_pylist():
        data = pa.decompress(row["held"], size, codec="zstd", asbytes=True)
        out.data[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(data, np.uint8)
    return out


_EDGES = (
    "row_key long, doc long, starts array<int>, sizes array<int>, "
    "before array<int>, after array<int>, edges array<long>"
)


def short(edges: np.ndarray) -> np.ndarray:
    """An edge as 32 bits that are never 0."""
    return np.maximum(edges & np.uint64(0xFFFFFFFF), np.uint64(1)).astype(np.uint32).view(np.int32)


def lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def edges_of(batches: Iterator[pa.RecordBatch], width: int, known: HashFilter) -> Iterator[pa.RecordBatch]:
    """Per row: stretches of windows that may be repeated, with the edges beside each stretch (0: none)."""
    for rows, words in chunked(batches):
        chunk = Chunk(words, width)
        on = known.passes(chunk.runs)
        at, owner = chunk.at[on], chunk.owner[on]
        if not len(at):
            continue
        edges = grams(chunk.codes, width)
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(at)))
        start, mine = at[first], owner[first]
        end = start + sizes - 1
        begin, stop = chunk.begins[mine], chunk.begins[mine] + chunk.sizes[mine] - width
        codes = short(edges)
        before = np.where(start > begin, codes[start - 1], 0).astype(np.int32)
        after = np.where(end < stop, codes[np.minimum(end + 1, len(edges) - 1)], 0).astype(np.int32)
        holders, stretches = np.unique(mine, return_counts=True)
        windows = np.bincount(mine, weights=sizes).astype(np.int64)[holders]
        keys = [rows[i] for i in holders.tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()),
                lists((start - begin).astype(np.int32), stretches),
                lists(sizes.astype(np.int32), stretches),
                lists(before, stretches),
                lists(after, stretches),
                lists(edges[at].view(np.int64), windows),
            ],
            names=["row_key", "doc", "starts", "sizes", "before", "after", "edges"],
        )


def windows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """edge, row of the batch, place, and the first and last window of each stretch of a batch of edges."""
    flat = {n: batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in ("starts", "sizes", "edges")}
    sizes = flat["sizes"].astype(np.int64)
    stretch_row = np.repeat(np.arange(batch.num_rows), batch.column("starts").value_lengths().to_numpy())
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(flat["edges"])) - np.repeat(first, sizes) + np.repeat(flat["starts"], sizes)
    return flat["edges"].view(np.uint64), np.repeat(stretch_row, sizes), place, first, first + sizes - 1


#: What is known of an edge: hash, document and place of its source, edges before and after, flags.
_FACT = np.dtype([("edge", "<u8"), ("doc", "<i8"), ("place", "<i4"), ("before", "<i4"), ("after", "<i4"), ("flags", "u1")])
#: Flags: several edges before, several after, in several documents.
_BEFORE, _AFTER, _REPEATED = 1, 2, 4


def summed(facts: np.ndarray) -> np.ndarray:
    """One fact per edge."""
    facts = facts[np.lexsort((facts["place"], facts["doc"], facts["edge"]))]
    first = np.flatnonzero(np.concatenate([[True], facts["edge"][1:] != facts["edge"][:-1]]))
    last = np.append(first[1:], len(facts)) - 1
    flags = np.bitwise_or.reduceat(facts["flags"], first)
    for name, flag in (("before", _BEFORE), ("after", _AFTER)):
        apart = np.minimum.reduceat(facts[name], first) != np.maximum.reduceat(facts[name], first)
        flags |= np.where(apart, flag, 0).astype(np.uint8)
    flags |= np.where(facts["doc"][first] != facts["doc"][last], _REPEATED, 0).astype(np.uint8)
    out = facts[first].copy()
    out["flags"] = flags
    return out


def fact_blocks(batches: Iterator[pa.RecordBatch], part_bits: int) -> Iterator[pa.RecordBatch]:
    """part, block: the facts on the edges of a chunk."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        facts = summed(np.concatenate(held))
        parts, blocks = [], []
        for part, x, y in cuts(facts["edge"] >> np.uint64(64 - part_bits)):
            columns = b"".join(np.ascontiguousarray(facts[n][x:y]).tobytes() for n in _FACT.names)
            parts.append(part)
            blocks.append((y - x).to_bytes(8, "little") + pa.compress(columns, codec="zstd", asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(blocks, pa.binary())], names=["part", "block"])

    for batch in batches:
        edges, row, place, first, last = windows_of(batch)
        if not len(edges):
            continue
        facts = np.zeros(len(edges), _FACT)
        codes = short(edges)
        facts["edge"], facts["place"] = edges, place
        facts["doc"] = batch.column("doc").to_numpy()[row]
        facts["before"][1:], facts["after"][:-1] = codes[:-1], codes[1:]
        facts["before"][first] = batch.column("before").flatten().to_numpy()
        facts["after"][last] = batch.column("after").flatten().to_numpy()
        held.append(facts)
        size += len(facts)
        if size >= CHUNK:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def repeated_edges(group: pd.DataFrame) -> pd.DataFrame:
    """All facts of a range of edges -> those that several documents have."""
    held = []
    for block in group.block:
        n = int.from_bytes(block[:8], "little")
        data = pa.decompress(block[8:], n * _FACT.itemsize, codec="zstd", asbytes=True)
        facts, at = np.zeros(n, _FACT), 0
        for name in _FACT.names:
            facts[name] = np.frombuffer(data, _FACT[name], n, at)
            at += n * _FACT[name].itemsize
        held.append(facts)
    facts = summed(np.concatenate(held))
    facts = facts[facts["flags"] & _REPEATED != 0]
    return pd.DataFrame(
        {
            "edge": np.ascontiguousarray(facts["edge"]).view(np.int64),
            "code": short(facts["edge"]),
            "doc": facts["doc"],
            "place": facts["place"],
            "follows": (facts["flags"] & _BEFORE == 0) & (facts["before"] != 0),
            "after": np.where(facts["flags"] & _AFTER == 0, facts["after"], 0).astype(np.int32),
        }
    )


def path_ends(edges: DataFrame) -> DataFrame:
    """edge, ends (1: first of a path, 2: last), doc, place: the ends of all nonbranching paths, at their sources."""
    one = edges.where("after <> 0").select(
        "doc", (F.col("place") + 1).alias("place"), F.col("after").alias("code"), F.col("edge").alias("left")
    )
    other = edges.where("follows").select("doc", "place", "code", F.col("edge").alias("right"))
    # the node between two edges does not branch if each is the only one beside the other
    met = one.join(other, ["doc", "place", "code"], "full_outer")
    alone = met.where("left is null or right is null").select(
        F.coalesce("left", "right").alias("edge"),
        F.when(F.col("left").isNull(), 1).otherwise(2).alias("ends"),
        "doc",
        (F.col("place") - F.when(F.col("left").isNull(), 0).otherwise(1)).alias("place"),
    )
    known = edges.where("not follows").select("edge", F.lit(1).alias("ends"), "doc", "place")
    known = known.unionByName(edges.where("after = 0").select("edge", F.lit(2).alias("ends"), "doc", "place"))
    ends = alone.unionByName(known).groupBy("edge", "doc", "place").agg(F.bit_or("ends").alias("ends"))
    return ends.select("edge", "ends", "doc", "place")


def found_ends(batches: Iterator[pa.RecordBatch], known: HashFilter) -> Iterator[pa.RecordBatch]:
    """row_key, own, at, edge: windows that may be the end of a path."""
    for batch in batches:
        edges, row, place, _, _ = windows_of(batch)
        on = np.flatnonzero(known.passes(edges))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(batch.column("row_key").to_numpy()[row[on]]),
                pa.array(batch.column("doc").to_numpy()[row[on]]),
                pa.array(place[on].astype(np.int32)),
                pa.array(edges[on].view(np.int64)),
            ],
            names=["row_key", "own", "at", "edge"],
        )


def row_key(docs: DataFrame) -> Column:
    return F.xxhash64("doc_id", "text")


def repeated_spans(docs: DataFrame, width: int = 13) -> DataFrame:
    """row_key, spans of every row of `docs` that repeats `width` words or more of an earlier document.

    A span has start and n_words (from 0, in words), and the source: source_id and source_start. Spans may
    overlap by up to `width` - 1 words, and each is the longest stretch of windows whose sources are one stretch
    that is not left or entered elsewhere. Rows are told by doc_id and text (`row_key`).
    """
    kept = docs.select(
        row_key(docs).alias("row_key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), "text"
    )
    spark = docs.sparkSession
    runs = spark.sparkContext.broadcast(run_filter(docs, width))
    edges = stored(kept.mapInArrow(lambda b: edges_of(b, width, runs.value), _EDGES), "edges")
    total = edges.agg(F.sum(F.size("edges"))).first()[0] or 0
    part_bits = max(1, (total // TOGETHER).bit_length())
    blocks = edges.mapInArrow(lambda b: fact_blocks(b, part_bits), "part long, block binary")
    facts = blocks.groupBy("part").applyInPandas(
        repeated_edges, "edge long, code int, doc long, place int, follows boolean, after int"
    )
    ends = stored(path_ends(stored(facts, "repeated_edges")), "path_ends")
    n = ends.count()
    filter_ = HashFilter(min(MOST_BITS, max(16, n.bit_length() + SPARE_BITS)))
    filter_.add(ends, "edge")
    ship = spark.sparkContext.broadcast(filter_)
    places = edges.mapInArrow(lambda b: found_ends(b, ship.value), "row_key long, own long, at int, edge long")
    met = places.join(F.broadcast(ends) if n <= BROADCAST_ROWS else ends, "edge").where("doc < own")
    # rows that are equal in all come down to one
    met = met.groupBy("row_key", "at", "ends", "doc", "place").agg(F.lit(1).alias("one"))
    held = met.groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("at", "ends", "doc", "place"))).alias("held"))

    def side(flag: int) -> Column:
        return F.filter("held", lambda e: e.ends.bitwiseAND(flag) != 0)

    pairs = F.arrays_zip(side(1).alias("first"), side(2).alias("last"))
    # both ends lie in the same source and as far apart as there
    same = F.filter(
        pairs,
        lambda p: (p["first"].doc == p["last"].doc)
        & (p["last"].at - p["first"].at == p["last"].place - p["first"].place),
    )
    spans = F.transform(
        same,
        lambda p: F.struct(
            p["first"].at.alias("start"),
            (p["last"].at - p["first"].at + width).alias("n_words"),
            p["first"].doc.alias("source_id"),
            p["first"].place.alias("source_start"),
        ),
    )
    return held.select("row_key", spans.alias("spans")).where("size(spans) > 0")


def cut_batches(batches: Iterator[pa.RecordBatch], held: str) -> Iterator[pa.RecordBatch]:
    """`text` without the words of the spans in column `held`, n_words and n_removed."""
    for batch in batches:
        texts, sizes, removed = [], [], []
        for text, spans in zip(batch.column("text"), batch.column(held).to_pylist(), strict=True):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            sizes.append(len(words))
            if spans:
                kept, at = [], 0
                for span in sorted(spans, key=lambda s: s["start"]):
                    kept += words[at : max(at, span["start"])]
                    at = max(at, span["start"] + span["n_words"])
                words = kept + words[at:]
            removed.append(sizes[-1] - len(words))
            texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        columns = {n: batch.column(n) for n in batch.schema.names if n != held}
        columns["text"] = pa.array(texts, pa.string())
        columns["n_words"], columns["n_removed"] = pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def dedup_passages(docs: DataFrame, width: int = 13) -> DataFrame:
    """`docs` with n_words, n_removed, and in `text` the words that are left, joined by one blank.

    Words are what ASCII white space separates, unchanged. A word goes if it lies in a window of `width` words that
    also begins in a document with a smaller doc_id; windows are judged on the texts as they come in. NULL,
    empty and short texts have no windows, and NULL text becomes empty. NULL doc_id comes after all others;
    rows that share a doc_id, or have none, take nothing from each other, and equal rows are treated alike. Columns
    named n_words or n_removed are replaced, others stay. An empty table stays empty. Windows are told
    apart by 64-bit hashes.
    """
    docs = docs.drop("n_words", "n_removed")
    key, held = free_name(docs, "key"), free_name(docs, "spans")
    short_spans = F.transform("spans", lambda s: F.struct(s.start, s.n_words))
    spans = stored(repeated_spans(docs, width).select(F.col("row_key").alias(key), short_spans.alias(held)), "spans")
    # spans are one row per key; hashed by task, so that the texts need not be sorted
    spans = spans.hint("shuffle_hash")
    found = docs.withColumn(key, row_key(docs)).join(spans, key, "left").drop(key)
    fields = [StructField("text", StringType()) if f.name == "text" else f for f in docs.schema.fields]
    schema = StructType(fields).add("n_words", LongType()).add("n_removed", LongType())
    return found.mapInArrow(lambda b: cut_batches(b, held), schema)
