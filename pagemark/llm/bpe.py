"""Byte-level BPE: overlapping chunks are pre-tokenised in parallel, stitched, encoded and decoded.

A pre-token starts where the one before ends, and what follows a boundary depends only on the text
behind it. So a long text is cut into chunks that overlap; each chunk is pre-tokenised from its own
start, and two neighbours agree from the first boundary on that both have. Where the overlap holds no
common boundary (one run of letters over all of it), the chunks are joined and read as one.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters a chunk owns, and characters it reads beyond them to meet its neighbour.
CHUNK = 16_384
OVERLAP = 512
#: Distinct pre-tokens whose ids a worker remembers; the memory is emptied when full.
REMEMBERED = 400_000


class Ranks:
    """Merge ranks of a byte-level vocabulary, read once per worker."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {
                base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)
            }
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self.memory: dict[str, list[int]] = {}

    def __getitem__(self, piece: str) -> list[int]:
        ids = self.memory.get(piece)
        if ids is None:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            ids = self.merge(piece.encode("utf-8"))
            if len(piece) <= 64:
                self.memory[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the neighbouring pair of lowest rank is joined until none is left.

        Candidate pairs wait in a heap, so a pre-token of n bytes takes n log n steps.
        """
        known = self.ids
        if piece in known:
            return [known[piece]]
        end = list(range(1, len(piece) + 1))  # end[i]: where the part that starts at i ends
        start_before = list(range(-1, len(piece)))  # by a part's start: start of the part before it
        heap = []
        for i in range(len(piece) - 1):
            rank = known.get(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        size = len(piece)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if middle < 0 or middle >= size or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[i] = stop
            end[middle] = -1
            if stop < size:
                start_before[stop] = i
                rank = known.get(piece[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            before = start_before[i]
            if before >= 0:
                rank = known.get(piece[before:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, before, stop))
        ids, i = [], 0
        while i < size:
            ids.append(known[piece[i : end[i]]])
            i = end[i]
        return ids

    def encode(self, pieces: Iterable[str]) -> np.ndarray:
        out: list[int] = []
        for piece in pieces:
            out += self[piece]
        return np.array(out, dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def ranks(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=4)
def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def encode_texts(
    batches: Iterator[pd.DataFrame], path: str, pattern: str, decode: bool
) -> Iterator[pd.DataFrame]:
    """Texts of one chunk each."""
    table, pieces = ranks(path), splitter(pattern)
    for batch in batches:
        ids = [table.encode(pieces.findall(text)) for text in batch.text]
        yield _result(batch.doc_id, ids, table, decode)


def _result(doc_ids, ids: list[np.ndarray], table: Ranks, decode: bool) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "doc_id": pd.array(doc_ids, dtype="Int64"),
            "n_tokens": [len(x) for x in ids],
            "ids": [x.tobytes() for x in ids],
            "decoded": [table.decode(x) if decode else None for x in ids],
        }
    )


def read_chunk(text: str, table: Ranks, pieces: regex.Pattern, own: int, last: bool):
    """Ids of a stretch of text; the boundaries in its first stretch, and the sure ones from `own` on.

    Both are maps from place to the number of ids before it. A boundary is sure when the pre-token
    behind it ends before the text does: what comes after the text cannot move it any more.
    """
    out: list[int] = []
    head, tail = {}, {}
    for match in pieces.finditer(text):
        at, stop = match.span()
        if at < OVERLAP:
            head[at] = len(out)
        if at >= own and not last and stop < len(text) - 1:
            tail[at] = len(out)
        out += table[match.group()]
    return np.array(out, dtype="<u4"), head, tail


def encode_chunks(
    batches: Iterator[pd.DataFrame], path: str, pattern: str, chunk: int
) -> Iterator[pd.DataFrame]:
    table, pieces = ranks(path), splitter(pattern)
    for batch in batches:
        read = [
            read_chunk(text, table, pieces, chunk, last)
            for text, last in zip(batch.text, batch.is_last, strict=True)
        ]
        yield batch.assign(
            ids=[ids.tobytes() for ids, _, _ in read],
            head=[list(h) for _, h, _ in read],
            heads=[list(h.values()) for _, h, _ in read],
            tail=[list(t) for _, _, t in read],
            tails=[list(t.values()) for _, _, t in read],
        )


def stitch(group: pd.DataFrame, path: str, pattern: str, chunk: int, decode: bool) -> pd.DataFrame:
    """All chunks of one text -> its ids. Neighbours are cut at the first boundary both have.

    Where they have none, the text is read on from the last cut over one, two, four, ... more chunks
    until it meets a boundary of the chunk that follows.
    """
    table, pieces = ranks(path), splitter(pattern)
    copies = int((group.chunk_no == 0).sum())
    parts = list(group.drop_duplicates("chunk_no").sort_values("chunk_no").itertuples(index=False))
    out, place, i = [], 0, 0
    while i < len(parts):
        j, base = i, parts[i].start
        ids = np.frombuffer(parts[i].ids, dtype="<u4")
        tail = dict(zip(parts[i].tail, parts[i].tails, strict=True))
        skip = 0 if place == base else dict(zip(parts[i].head, parts[i].heads, strict=True))[place - base]
        while j + 1 < len(parts):
            after = parts[j + 1]
            shift = after.start - base
            cut = next((h for h in after.head if h + shift in tail), None)
            if cut is not None:
                break
            j = min(len(parts) - 1, j + max(1, j - i))
            text = "".join([p.text[:chunk] for p in parts[i:j]] + [parts[j].text])
            text, base, skip = text[place - parts[i].start :], place, 0
            ids, _, tail = read_chunk(
                text, table, pieces, parts[j].start + chunk - base, j + 1 == len(parts)
            )
        if j + 1 < len(parts):
            out.append(ids[skip : tail[cut + shift]])
            place = after.start + cut
        else:
            out.append(ids[skip:])
        i = j + 1
    ids = np.concatenate(out)
    return _result([parts[0].doc_id] * copies, [ids] * copies, table, decode)


def encode_documents(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    decode: bool = True,
    chunk: int = CHUNK,
) -> DataFrame:
    """`docs(doc_id, text)` -> doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (bytes).

    One row per row of `docs`: repeated rows and equal ids stay apart, NULL doc_id stays NULL, NULL text
    counts as empty and has no ids. Texts longer than a chunk are cut into overlapping chunks, which
    are dealt to all tasks; a text's ids meet in one row again, as the text itself did. Other columns
    are ignored. `path` is a file of merge ranks that every executor can read; `pattern` must not look
    behind.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if chunk < OVERLAP:
        raise ValueError("a chunk must be at least as long as the overlap")
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    size = F.char_length("text")
    schema = "doc_id long, n_tokens long, ids binary, decoded binary"
    whole = docs.where(size <= chunk).mapInPandas(
        lambda batches: encode_texts(batches, path, pattern, decode), schema
    )
    chunks = (
        docs.where(size > chunk)
        # a text is told by its id and its digest, so equal ids with other texts stay apart
        .withColumn("text_key", F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text")))
        .select(
            "doc_id",
            "text_key",
            "text",
            F.posexplode(F.sequence(F.lit(0), size - 1, F.lit(chunk))).alias("chunk_no", "start"),
        )
        .select(
            "doc_id",
            "text_key",
            "chunk_no",
            "start",
            (F.col("start") + chunk >= F.char_length("text")).alias("is_last"),
            F.expr(f"substring(text, start + 1, {chunk + OVERLAP})").alias("text"),
        )
        .repartition("text_key", "chunk_no")
    )
    stitched = (
        chunks.mapInPandas(
            lambda batches: encode_chunks(batches, path, pattern, chunk),
            "doc_id long, text_key string, chunk_no int, start int, is_last boolean, text string, "
            "ids binary, head array<int>, heads array<int>, tail array<int>, tails array<int>",
        )
        .groupBy("text_key")
        .applyInPandas(lambda group: stitch(group, path, pattern, chunk, decode), schema)
    )
    return whole.unionByName(stitched)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded bytes."""
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
