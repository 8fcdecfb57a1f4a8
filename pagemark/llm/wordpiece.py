"""Token counts: a linear longest-match automaton counts greedy word pieces without building them."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose counts a worker remembers; the memory is emptied when full.
REMEMBERED = 500_000


class PieceCounter:
    """Trie of the vocabulary; every node knows where to go on when no child fits.

    At a node the text read since the last counted piece is the node's string. If no child fits the next
    byte, greedy matching takes some pieces off the front of that string: `pops` is their number and
    `fail` the node of what remains, or -1 where nothing can be taken off. Every byte of a word is read
    once and every pop shortens the string, so a word takes linear time.
    """

    def __init__(self, vocabulary: Iterable[bytes]):
        self.step: dict[int, int] = {}  # node * 256 + byte -> node
        ends, parents = [False], [(0, 0)]
        for token in vocabulary:
            node = 0
            for byte in token:
                child = self.step.get(node << 8 | byte)
                if child is None:
                    child = self.step[node << 8 | byte] = len(ends)
                    ends.append(False)
                    parents.append((node, byte))
                node = child
            if node:
                ends[node] = True
        children: list[list[int]] = [[] for _ in ends]
        for node in range(1, len(ends)):
            children[parents[node][0]].append(node)
        self.fail, self.pops = [-1] * len(ends), [0] * len(ends)
        queue = deque(children[0])
        while queue:
            node = queue.popleft()
            queue.extend(children[node])
            if ends[node]:
                self.fail[node], self.pops[node] = 0, 1
                continue
            parent, byte = parents[node]
            at, taken = self.fail[parent], self.pops[parent]
            while at >= 0 and (to := self.step.get(at << 8 | byte)) is None:
                taken += self.pops[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.pops[node] = to, taken
        self.memory: dict[str, int] = {}

    def count(self, word: bytes) -> int:
        """Pieces of a word; a word the vocabulary cannot tile greedily is one unknown piece."""
        step, fail, pops = self.step, self.fail, self.pops
        node = pieces = 0
        for byte in word:
            while (to := step.get(node << 8 | byte)) is None:
                if fail[node] < 0:
                    return 1
                pieces += pops[node]
                node = fail[node]
            node = to
        while node:
            if fail[node] < 0:
                return 1
            pieces += pops[node]
            node = fail[node]
        return pieces

    def __getitem__(self, word: str) -> int:
        known = self.memory.get(word)
        if known is None:
            known = self.count(word.encode("utf-8"))
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            if len(word) <= 64:
                self.memory[word] = known
        return known


@lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    with open(path, "rb") as lines:
        return PieceCounter(base64.b64decode(line.split()[0]) for line in lines)


def count_batches(batches: Iterator[pd.DataFrame], path: str, pattern: str) -> Iterator[pd.DataFrame]:
    pieces, words = counter(path), regex.compile(pattern)
    for batch in batches:
        found = [words.findall(text) for text in batch.text]
        yield pd.DataFrame(
            {
                "doc_id": batch.doc_id,
                "n_words": [len(x) for x in found],
                "n_tokens": [sum(map(pieces.__getitem__, x)) for x in found],
            }
        )


def count_tokens(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """`docs(doc_id, text)` -> doc_id, n_words, n_tokens: greedy longest-match pieces of every word.

    Words are the matches of `pattern`; a word's leading space belongs to it, as the vocabulary tells
    word beginnings by it. The vocabulary is a file of base64 tokens, one a line, that every executor can
    read. One row per row of `docs`; NULL and empty texts have no words; repeated rows stay; other
    columns are ignored. Nothing is shuffled.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    counted = texts.mapInPandas(
        lambda batches: count_batches(batches, path, pattern),
        "doc_id string, n_words long, n_tokens long",
    )
    return counted.withColumn("doc_id", F.col("doc_id").cast("long"))
