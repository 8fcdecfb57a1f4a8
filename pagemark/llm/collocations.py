"""Phrase collocations: vertical partitioning by word prefixes, and suffix subtrees of bounded depth.

All frequent phrases are counted with suffixes cut after five words, which are never held in one place:

- Vertical partitioning. Prefixes are pairs of words at first, and those that are frequent are found by
  counts of their hashes' leading bits. A prefix that occurs more often than a task's budget allows is extended
  by one word, and so are those that are still too frequent. Prefixes are then put together, in the order of
  their hashes, into groups whose occurrences fit the budget.
- Subtrees. Each task sends the suffixes at the places of a group's prefixes, brought down to one entry for
  equal ones. A group sorts its suffixes; equal beginnings of neighbours are the inner nodes of its
  subtree, and the occurrences at the leaves below a node add up to the phrase's count.

Words and pairs below the least count can be in no phrase and end a suffix. A fixed number of bits, set by the
hashes of frequent words and prefixes, tells most others apart; those it lets pass are counted and dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemark.llm.common import stored
from pagemark.llm.filters import HashFilter

#: Words of the longest phrase.
DEPTH = 5
#: Suffixes of a group, and words of a task's chunk.
BUDGET, CHUNK = 1 << 21, 1 << 20
#: Pairs of words counted together, before equal ones are brought down.
PAIRS = 1 << 24
#: Bits that tell frequent words, and as many that tell frequent prefixes, as a power of two: 16 MB.
FILTER_BITS = 27
#: Words whose hashes a task remembers.
REMEMBERED = 1 << 19
UNKNOWN_LANGUAGE = "und"
#: A-Z to lower case, tab to blank, what ends a piece to a line feed.
_PLAIN = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_END, _NOTHING = 0, 1


def plain_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)


def word_code(lang: str, word: bytes) -> int:
    """A word of a language as 64 bits; 0 and 1 are not words."""
    return max(2, xxhash.xxh3_64_intdigest(word, seed=xxhash.xxh3_64_intdigest(lang.encode())))


def signed(code: int) -> int:
    return code - (1 << 64) if code >> 63 else code


def extended(prefix: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The hash of a prefix with one more word."""
    out = (prefix ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + code
    return out ^ (out >> np.uint64(29))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, code, n: counts of words, and of all words of a language under a NULL word."""
    held: dict[str, Counter] = {}

    def flush() -> pa.RecordBatch:
        rows = [(lang, None, 0, sum(c.values())) for lang, c in held.items()]
        rows += [
            (lang, w.decode("utf-8", "surrogatepass"), signed(word_code(lang, w)), n)
            for lang, c in held.items()
            for w, n in c.items()
        ]
        held.clear()
        columns = list(zip(*rows, strict=True))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "word", "code", "n"]
        )

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            held.setdefault(lang, Counter()).update(plain_bytes(text.as_py()).split())
        if sum(map(len, held.values())) > REMEMBERED:
            yield flush()
    if held:
        yield flush()


class Partition:
    """What tasks know of the vertical partition: frequent words and prefixes, those to extend, the groups' borders."""

    def __init__(self, total: int):
        self.words, self.prefixes = HashFilter(FILTER_BITS), HashFilter(FILTER_BITS)
        #: pairs are counted by so many leading bits of their hashes
        self.shift = np.uint64(64 - min(56, max(FILTER_BITS, total.bit_length() + 5)))
        #: by length: sorted leading bits of prefixes that must be extended
        self.hot: dict[int, np.ndarray] = {}
        self.borders = np.zeros(0, np.uint64)

    def is_hot(self, hashes: np.ndarray, length: int) -> np.ndarray:
        hot = self.hot.get(length)
        if hot is None:
            return np.zeros(len(hashes), bool)
        hashes = hashes >> self.shift
        return hot[np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)] == hashes


class Reader:
    """Texts as word codes: 0 where a piece ends or a word is not frequent."""

    def __init__(self, known: Partition):
        self.known = known
        self.codes: dict[str, dict[bytes, int]] = {}
        self.size = 0

    def read(self, lang: str, text: str | None) -> np.ndarray:
        codes = self.codes.get(lang)
        if codes is None:
            codes = self.codes[lang] = {b"": _NOTHING, b"\n": _END}
        words = plain_bytes(text).replace(b"\n", b" \n ").split(b" ")
        new = [w for w in set(words) if w not in codes]
        if new:
            found = np.array([word_code(lang, w) for w in new], np.uint64)
            kept = np.where(self.known.words.passes(found), found, np.uint64(_END))
            codes.update(zip(new, kept.tolist(), strict=True))
            self.size += len(new)
        out = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        if self.size > REMEMBERED:
            self.codes, self.size = {}, 0
        return out[out != _NOTHING]


def chunks(batches: Iterator[pa.RecordBatch], known: Partition) -> Iterator[np.ndarray]:
    """The codes of many texts one behind the other, with DEPTH zeros after each and at the end."""
    reader, held, size, gap = Reader(known), [], 0, np.zeros(DEPTH, np.uint64)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            codes = reader.read(lang, text.as_py())
            held += [codes, gap]
            size += len(codes)
            if size >= CHUNK:
                yield np.concatenate(held)
                held, size = [], 0
    if size:
        yield np.concatenate(held)


def pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where two frequent words follow each other, and the hashes of the pairs."""
    at = np.flatnonzero((codes[:-1] != _END) & (codes[1:] != _END))
    return at, extended(codes[at], codes[at + 1])


def prefixes(codes: np.ndarray, known: Partition, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, places and hashes of prefixes all of whose shorter ones are hot, and how many words go on from there.

    A suffix goes on as long as its neighbouring words are frequent pairs.
    """
    at, hashes = pairs(codes)
    on = known.prefixes.passes(hashes)
    at, hashes = at[on], hashes[on]
    follows = np.zeros(len(codes), np.uint8)
    follows[at] = 1
    reach = follows[at] + np.uint8(1)
    for i in range(1, DEPTH - 1):
        reach += (follows[at + i] == 1) & (reach == i + 1)
    for length in range(2, longest + 1):
        yield length, at, hashes, reach
        if length not in known.hot:
            return
        on = known.is_hot(hashes, length) & (reach > length)
        at, hashes, reach = at[on], hashes[on], reach[on]
        hashes = extended(hashes, codes[at + length])


def pair_blocks(batches: Iterator[pa.RecordBatch], known: Partition, part_bits: int) -> Iterator[pa.RecordBatch]:
    """part, block: how often the leading bits of a pair's hash occur in a chunk."""
    for codes in chunks(batches, known):
        found, n = np.unique(pairs(codes)[1] >> known.shift, return_counts=True)
        parts = found >> (np.uint64(64 - part_bits) - known.shift)
        edges = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else []
        out, blocks = [], []
        for x, y in zip(edges, np.append(edges[1:], len(parts)), strict=True):
            # neighbours lie close together
            data = np.diff(found[x:y], prepend=np.uint64(0)).tobytes() + n[x:y].astype(np.uint32).tobytes()
            out.append(int(parts[x]))
            blocks.append(int(y - x).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(blocks, pa.binary())], names=["part", "block"])


def frequent_pairs(group: pd.DataFrame, shift: int, least: int) -> pd.DataFrame:
    """code (leading bits in place), n of the pairs of one range with `least` occurrences or more."""
    found, counts = [], []
    for block in group.block:
        rows = int.from_bytes(block[:8], "little")
        data = pa.decompress(block[8:], 12 * rows, codec="zstd", asbytes=True)
        found.append(np.cumsum(np.frombuffer(data, np.uint64, rows), dtype=np.uint64))
        counts.append(np.frombuffer(data, np.uint32, rows, 8 * rows))
    found, place = np.unique(np.concatenate(found), return_inverse=True)
    n = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
    on = n >= least
    return pd.DataFrame({"code": (found[on] << np.uint64(shift)).view(np.int64), "n": n[on]})


def count_extensions(batches: Iterator[pa.RecordBatch], known: Partition, length: int) -> Iterator[pa.RecordBatch]:
    """code (the hash), phrase, n of the prefixes of this length that extend a hot one.

    Pairs, which are only known by the leading bits, are counted with those of three words.
    """
    for codes in chunks(batches, known):
        for size, at, hashes, _ in prefixes(codes, known, length):
            if size < length:
                if length > 3:
                    continue
                on = known.is_hot(hashes, 2)
                at, hashes = at[on], hashes[on]
            found, first, n = np.unique(hashes, return_index=True, return_counts=True)
            words = codes[at[first][:, None] + np.arange(size)]
            flat = pa.array(words.ravel().view(np.int64))
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.ListArray.from_arrays(offsets, flat), pa.array(n)],
                names=["code", "phrase", "n"],
            )


def packed(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Five columns of codes below 2 ** 21 as two numbers that sort alike."""
    w = words.astype(np.uint64)
    s = np.uint64(21)
    return ((w[:, 0] << s | w[:, 1]) << s) | w[:, 2], w[:, 3] << s | w[:, 4]


def suffix_blocks(batches: Iterator[pa.RecordBatch], known: Partition) -> Iterator[pa.RecordBatch]:
    """part, block: the different suffixes of a chunk that belong to a group, with their counts."""
    for codes in chunks(batches, known):
        if not len(codes):
            continue
        names, dense = np.unique(codes, return_inverse=True)
        dense = dense.astype(np.uint32)
        if names[0] != _END:
            names, dense = np.concatenate([[np.uint64(_END)], names]), dense + np.uint32(1)
        at, keys, lengths, reach = [], [], [], []
        for length, here, hashes, words in prefixes(codes, known, DEPTH):
            on = ~known.is_hot(hashes, length)
            if length > 2:
                # these are counted, and a suffix of no more words holds nothing new
                on &= (words > length) & known.prefixes.passes(hashes)
            at.append(here[on])
            keys.append(hashes[on])
            reach.append(words[on])
            lengths.append(np.full(int(on.sum()), 1 if length == 2 else length, np.uint8))
        at, keys, lengths, reach = (np.concatenate(x) for x in (at, keys, lengths, reach))
        if not len(at):
            continue
        words = dense[at[:, None] + np.arange(DEPTH)]
        words[np.arange(DEPTH) >= reach[:, None]] = 0
        part = np.searchsorted(known.borders, keys, "right").astype(np.int32)
        high, low = packed(words)
        order = np.lexsort((low, high, part))
        part, high, low = part[order], high[order], low[order]
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(order))).astype(np.uint32)
        part, words, lengths = part[first], words[order[first]], lengths[order[first]]
        edges = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
        parts, blocks = [], []
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            used, local = np.unique(words[x:y], return_inverse=True)
            head = np.array([len(used), y - x], np.int64).tobytes()
            columns = np.ascontiguousarray(local.reshape(-1, DEPTH).T.astype(np.uint32))
            data = head + names[used].tobytes() + columns.tobytes() + n[x:y].tobytes() + lengths[x:y].tobytes()
            parts.append(int(part[x]))
            blocks.append(len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.binary())], names=["part", "block"])


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names, words (a column per depth), counts and prefix lengths of a block."""
    data = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    used, rows = np.frombuffer(data, np.int64, 2).tolist()
    at = 16
    names = np.frombuffer(data, np.uint64, used, at)
    at += 8 * used
    words = np.frombuffer(data, np.uint32, DEPTH * rows, at).reshape(DEPTH, rows)
    at += 4 * DEPTH * rows
    return names, words, np.frombuffer(data, np.uint32, rows, at), np.frombuffer(data, np.uint8, rows, at + 4 * rows)


def subtree_counts(group: pd.DataFrame, least: int) -> pd.DataFrame:
    """All blocks of a group -> phrases longer than their prefix, with `least` occurrences or more."""
    parts = [unpacked(b) for b in group.block]
    names, places = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    begins = np.cumsum([0] + [len(p[0]) for p in parts])
    words = np.concatenate(
        [places[b : b + len(p[0])].astype(np.uint32)[p[1]] for b, p in zip(begins, parts)], axis=1
    )
    n = np.concatenate([p[2] for p in parts]).astype(np.int64)
    lengths = np.concatenate([p[3] for p in parts])
    order = np.lexsort(words[::-1])
    words, n, lengths = words[:, order], n[order], lengths[order]
    ending = names[0] == _END  # then word 0 is the end of a suffix
    phrases, counts = [], []
    # a node of depth d is a run of suffixes that begin with the same d words
    new = np.zeros(len(n), bool)
    new[0] = True
    for d in range(DEPTH):
        new[1:] |= words[d, 1:] != words[d, :-1]
        first = np.flatnonzero(new)
        total = np.add.reduceat(n, first)
        on = (total >= least) & (lengths[first] <= d)
        if ending:
            on &= words[d, first] != 0
        for i, count in zip(first[on].tolist(), total[on].tolist(), strict=True):
            phrases.append(names[words[: d + 1, i]].view(np.int64))
            counts.append(count)
    return pd.DataFrame({"phrase": pd.Series(phrases, dtype=object), "n": np.array(counts, np.int64)})


def partition(texts: DataFrame, words: DataFrame, total: int, least: int, budget: int) -> tuple[Partition, list[DataFrame]]:
    """The vertical partition, and the counted phrases that it needed."""
    known, counted, sums = Partition(total), [], Counter()
    known.words.add(words, "code")
    context = texts.sparkSession.sparkContext
    # so many ranges of hashes that a range holds a small part of the budget
    ranges = min(64 - int(known.shift), max(1, (16 * total // budget).bit_length()))
    part_bits = min(ranges, max(1, (total // PAIRS).bit_length()))
    ship = context.broadcast(known)
    blocks = texts.mapInArrow(lambda b: pair_blocks(b, ship.value, part_bits), "part long, block binary")
    shift = int(known.shift)
    level = blocks.groupBy("part").applyInPandas(lambda g: frequent_pairs(g, shift, least), "code long, n long")
    level = stored(level, "pairs")
    for length in range(2, DEPTH + 1):
        known.prefixes.add(level, "code")
        hot = level.where(F.col("n") > budget).select("code").toArrow().column("code").to_numpy()
        rows = (
            level.where(F.col("n") <= budget)
            .groupBy(F.shiftrightunsigned("code", 64 - ranges).alias("range"))
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
        for at, n in zip(rows.column("range").to_pylist(), rows.column("n").to_pylist(), strict=True):
            sums[at] += n
        if not len(hot) or length == DEPTH:
            break
        known.hot[length] = np.unique(hot.view(np.uint64) >> known.shift)
        now = context.broadcast(known)
        longer = texts.mapInArrow(
            lambda b, s=now, n=length + 1: count_extensions(b, s.value, n), "code long, phrase array<long>, n long"
        )
        longer = longer.groupBy("code", "phrase").agg(F.sum("n").alias("n"))
        longer = stored(longer.where(F.col("n") >= least), "extensions")
        counted.append(longer.select("phrase", "n"))
        level = longer.where(F.size("phrase") == length + 1).select("code", "n")
    borders, held = [], 0
    for at, n in sorted(sums.items()):
        if held and held + n > budget:
            borders.append(at << 64 - ranges)
            held = 0
        held += n
    known.borders = np.array(borders, np.uint64)
    return known, counted


def phrase_counts(
    docs: DataFrame, least: int = 100, budget: int = BUDGET
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases): lang, word, code, n of words with `least` occurrences; lang, n of all words;
    phrase (codes), n of all phrases of up to five words with `least` occurrences, single words included.
    """
    texts = docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), "text")
    counts = texts.mapInArrow(count_words, "lang string, word string, code long, n long")
    counts = counts.groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))
    counts = stored(counts.where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    words, totals = counts.where("word is not null"), counts.where("word is null").select("lang", "n")
    total = totals.agg(F.sum("n")).first()[0] or 0
    known, counted = partition(texts, words, total, least, budget)
    ship = texts.sparkSession.sparkContext.broadcast(known)
    blocks = texts.mapInArrow(lambda b: suffix_blocks(b, ship.value), "part int, block binary")
    found = blocks.groupBy("part").applyInPandas(lambda g: subtree_counts(g, least), "phrase array<long>, n long")
    for more in [words.select(F.array("code").alias("phrase"), "n"), *counted]:
        found = found.unionByName(more)
    return words, totals, stored(found, "phrases")


def cut_scores(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """`candidates(lang, phrase, a)` with the cut of the lowest score: l, r, n, score."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1))).select(
        "*",
        F.slice("phrase", F.lit(1), F.col("k")).alias("left"),
        F.slice("phrase", F.col("k") + 1, F.size("phrase")).alias("right"),
    )
    one = phrases.select(F.col("phrase").alias("left"), F.col("n").alias("l"))
    other = phrases.select(F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(one, "left").join(other, "right").join(totals, "lang")
    wide = "decimal(18,0)"
    score = F.expr(f"(cast(1000 * a as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide}))")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")


def contained(phrases: DataFrame) -> DataFrame:
    """phrase, within: the largest count of a longer phrase that holds it."""
    sizes = F.sequence(F.lit(2), F.size("phrase") - 1)
    parts = F.flatten(
        F.transform(
            sizes,
            lambda s: F.transform(
                F.sequence(F.lit(1), F.size("phrase") - s + 1), lambda i: F.slice("phrase", i, s)
            ),
        )
    )
    inner = phrases.where("size(phrase) > 2").select(F.explode(parts).alias("phrase"), "n")
    return inner.groupBy("phrase").agg(F.max("n").alias("within"))


def collocations(
    docs: DataFrame, least: int = 100, top: int | None = 2_000, budget: int = BUDGET
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of each language whose words belong together.

    Texts are lower-cased (A-Z) and cut at `. , ; : ! ?` and line breaks into pieces, and these at blanks and
    tabs into words. A candidate is a phrase of two to five words of one piece with a >= `least` occurrences,
    overlapping ones included. Cut in two after some word, its score is floor(1000 * a * n / (l * r)), l and
    r being the counts of both parts and n all words of the language; the cut with the lowest score counts,
    the first of equal ones. A candidate goes if a longer one that holds it occurs as often. `top` phrases of each
    language are reported (None: all), by score, then a, both descending, then the phrase in byte order.

    NULL lang is `und`; NULL and empty texts have no words; repeated rows count each; doc_id and other columns
    are not looked at. An empty table gives no rows. Words are told apart by 64-bit hashes. `budget` is the number of
    suffixes one task may hold.
    """
    words, totals, phrases = phrase_counts(docs, least, budget)
    longer = phrases.where("size(phrase) > 1")
    kept = (
        longer.join(contained(longer), "phrase", "left")
        .where(F.col("within").isNull() | (F.col("within") < F.col("n")))
        .select("phrase", F.col("n").alias("a"))
    )
    first = words.select(F.col("code").alias("_first"), "lang")
    kept = kept.join(first, F.get("phrase", F.lit(0)) == F.col("_first")).drop("_first")
    scored = stored(cut_scores(kept, phrases, totals), "scored")
    spelled = (
        scored.select("phrase", F.posexplode("phrase").alias("at", "code"))
        .join(words.select("code", "word"), "code")
        .groupBy("phrase")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("held"))
        .select("phrase", F.array_join("held.word", " ").alias("text"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    ranked = scored.join(spelled, "phrase").withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
