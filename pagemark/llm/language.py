"""Language ID: a linear-chain conditional random field labels the words of code-switched text.

Features of a word are its character n-grams with marked ends (those at the ends are its affixes) and the
word itself as a lexicon entry, all hashed to a fixed number of weights. Transitions between the labels
of neighbouring words are learned. Forward-backward gives every word's label probabilities; a
document's language is the label with the largest share of its words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

WORD = regex.compile(r"\p{L}+")
UNDETERMINED = "und"
BUCKETS = 1 << 17
LONGEST_GRAM = 4
#: Words whose emissions a worker remembers, and words labelled at once.
REMEMBERED = 200_000
AT_ONCE = 150_000
#: New words whose features are laid out together.
FEATURED = 10_000
#: The classifier is fitted on a bounded sample: so many documents of each language, one stretch of
#: so many characters from each, at a hashed place.
SAMPLE_PER_LANGUAGE = 800
STRETCH = 600


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words in a row, and where each word's features begin."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), dtype="<u4")
    codes = codes.astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    ends = np.repeat(starts + sizes, sizes)
    place = np.arange(len(codes))
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    gram = np.zeros(len(codes), dtype=np.uint64)
    padded = np.concatenate([codes, np.zeros(LONGEST_GRAM, dtype=np.uint64)])
    for n in range(1, LONGEST_GRAM + 1):
        gram = gram * np.uint64(1_000_003) + padded[n - 1 : n - 1 + len(codes)] + np.uint64(n)
        inside = place + n <= ends
        if n == 1:
            inside &= (codes != 2) & (codes != 3)
        mixed = (gram[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 17)
        found.append(mixed.astype(np.int64))
        owners.append(owner[inside])
    whole = [zlib.crc32(w.encode()) % BUCKETS for w in words]
    found.append(np.array(whole, dtype=np.int64))
    owners.append(np.arange(len(words)))
    found, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    begin = np.searchsorted(owners[order], np.arange(len(words)))
    return found[order], begin


@dataclass
class Field:
    """A fitted field: labels, emission weights (features x labels) and transition scores."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        found, begin = features(words)
        sums = np.add.reduceat(self.weights[found], begin, axis=0)
        counts = np.diff(np.append(begin, len(found)))
        return sums / np.sqrt(counts)[:, None].astype(np.float32)


def forward_backward(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Label probabilities of every word. `scores` holds the sequences one after the other.

    All sequences advance together, longest first, so a step is one small matrix product over those
    that are still running. Values are scaled at every step.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[order]
    lengths = sizes[order]
    longest = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(longest), side="left")
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    go = np.exp(moves - moves.max()).astype(emit.dtype)
    gamma = np.empty_like(emit)
    state = None
    for t in range(longest):
        at = starts[: running[t]] + t
        state = emit[at] if t == 0 else (state[: running[t]] @ go) * emit[at]
        state = state / state.sum(axis=1, keepdims=True)
        gamma[at] = state
    back = np.ones((len(lengths), emit.shape[1]), dtype=emit.dtype)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        both = gamma[at] * back[:n]
        gamma[at] = both / both.sum(axis=1, keepdims=True)
        ahead = (emit[at] * back[:n]) @ go.T
        back[:n] = ahead / ahead.sum(axis=1, keepdims=True)
    return gamma


def training_sequences(
    texts: list[tuple[str, str]], labels: list[str], width: int, seed: int
) -> list[tuple[list[str], list[int]]]:
    """Windows of words; every third one goes on with a window of another document.

    Documents carry one label each. The joined windows show the field where a language may change.
    """
    number = {x: i for i, x in enumerate(labels)}
    windows = []
    for text, lang in texts:
        words = WORD.findall(text.lower())
        for i in range(0, len(words), width):
            part = words[i : i + width]
            windows.append((part, [number[lang]] * len(part)))
    rng = np.random.default_rng(seed)
    rng.shuffle(windows)
    out, i = [], 0
    while i < len(windows):
        if i % 3 == 0 and i + 1 < len(windows):
            (a, la), (b, lb) = windows[i], windows[i + 1]
            out.append((a[: width // 2] + b[: width // 2], la[: width // 2] + lb[: width // 2]))
            out.append((a[width // 2 :] + b[width // 2 :], la[width // 2 :] + lb[width // 2 :]))
            i += 2
        else:
            out.append(windows[i])
            i += 1
    return [x for x in out if x[0]]


def fit(
    texts: list[tuple[str, str]], width: int = 24, rounds: int = 2, batch: int = 192, seed: int = 5
) -> Field:
    """Maximum likelihood by stochastic gradient with per-weight step sizes; `texts`: (text, label)."""
    labels = sorted({lang for _, lang in texts})
    n = len(labels)
    weights = np.zeros((BUCKETS, n), dtype=np.float32)
    seen = np.full((BUCKETS, n), 1e-4, dtype=np.float32)
    moves, moved = np.zeros((n, n), dtype=np.float32), np.full((n, n), 1e-2, dtype=np.float32)
    sequences = training_sequences(texts, labels, width, seed)
    rng = np.random.default_rng(seed + 1)
    for _ in range(rounds if n > 1 else 0):
        for first in range(0, len(sequences), batch):
            part = sequences[first : first + batch]
            words = [w for ws, _ in part for w in ws]
            truth = np.array([y for _, ys in part for y in ys])
            sizes = np.array([len(ws) for ws, _ in part])
            kinds, which = np.unique(np.array(words, dtype=object), return_inverse=True)
            found, begin = features(list(kinds))
            counts = np.diff(np.append(begin, len(found)))
            scale = (1 / np.sqrt(counts)).astype(np.float32)
            emit = np.add.reduceat(weights[found], begin, axis=0) * scale[:, None]
            scores = emit[which]
            gamma = forward_backward(scores, sizes, moves)
            # pairs of neighbours inside a sequence
            last = np.cumsum(sizes) - 1
            left = np.setdiff1d(np.arange(len(words)), last, assume_unique=True)
            error = -gamma
            error[np.arange(len(words)), truth] += 1
            by_kind = np.zeros((len(kinds), n), dtype=np.float32)
            np.add.at(by_kind, which, error)
            spread = np.repeat(by_kind * scale[:, None], counts, axis=0)
            touched, inverse = np.unique(found, return_inverse=True)
            step = np.stack(
                [np.bincount(inverse, weights=spread[:, k], minlength=len(touched)) for k in range(n)],
                axis=1,
            ).astype(np.float32)
            seen[touched] += step**2
            weights[touched] += 0.25 * step / np.sqrt(seen[touched])
            want = np.zeros((n, n), dtype=np.float32)
            np.add.at(want, (truth[left], truth[left + 1]), 1)
            # expected moves, with the neighbours' marginals re-joined through the move scores
            joint = gamma[left][:, :, None] * np.exp(moves)[None] * gamma[left + 1][:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            slope = (want - joint.sum(axis=0)) / max(1, len(left))
            moved += slope**2
            moves += 0.1 * slope / np.sqrt(moved)
        rng.shuffle(sequences)
    return Field(labels, weights, moves)


class Labeller:
    """Language shares of texts, with the emissions of recent words at hand."""

    def __init__(self, model: Field):
        self.model = model
        self.ids: dict[str, int] = {}
        self.known = np.zeros((0, len(model.labels)), dtype=np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        if len(self.ids) > REMEMBERED:
            self.ids, self.known = {}, self.known[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.ids]
        if new:
            count = len(self.ids)
            self.ids.update(zip(new, range(count, count + len(new)), strict=True))
            parts = [self.model.emissions(new[i : i + FEATURED]) for i in range(0, len(new), FEATURED)]
            self.known = np.concatenate([self.known, *parts])
        return self.known[np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))]

    def shares(self, texts: Iterator[str]) -> Iterator[tuple[str, float]]:
        """The language and its share for each text; about AT_ONCE words are labelled together."""
        words: list[str] = []
        sizes: list[int] = []
        for text in texts:
            found = WORD.findall(text.lower()) if text else []
            words += found
            sizes.append(len(found))
            if len(words) >= AT_ONCE:
                yield from self._label(words, np.array(sizes))
                words, sizes = [], []
        yield from self._label(words, np.array(sizes, dtype=np.int64))

    def _label(self, words: list[str], sizes: np.ndarray) -> Iterator[tuple[str, float]]:
        shares = np.zeros((len(sizes), len(self.model.labels)))
        full = np.flatnonzero(sizes)
        if len(full):
            gamma = forward_backward(self.scores(words), sizes[full], self.model.moves)
            begin = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            shares[full] = np.add.reduceat(gamma, begin, axis=0, dtype=np.float64)
            shares[full] /= sizes[full][:, None]
        for size, share in zip(sizes.tolist(), shares, strict=True):
            best = int(share.argmax())
            yield (self.model.labels[best], min(1.0, float(share[best]))) if size else (UNDETERMINED, 0.0)


def label_batches(
    batches: Iterator[pa.RecordBatch], model: Field, keep_text: bool
) -> Iterator[pa.RecordBatch]:
    labeller = Labeller(model)
    for batch in batches:
        texts = batch.column("text")
        # texts of like length are labelled together, so few steps run for one long text alone
        lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
        order = np.argsort(lengths, kind="stable")
        found = labeller.shares(texts[i].as_py() for i in order.tolist())
        named = [("", 0.0)] * len(order)
        for i, pair in zip(order.tolist(), found, strict=True):
            named[i] = pair
        columns = {
            name: batch.column(name) for name in batch.schema.names if keep_text or name != "text"
        }
        columns["lang_pred"] = pa.array([lang for lang, _ in named], pa.string())
        columns["score"] = pa.array([score for _, score in named], pa.float64())
        yield pa.RecordBatch.from_pydict(columns)


def sample_texts(docs: DataFrame, per_language: int, seed: int) -> list[tuple[str, str]]:
    """At most about `per_language` stretches of text for each language, chosen by hash."""
    usable = docs.where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    keep = F.create_map(
        *[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, per_language / n))]
    )
    hashed = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.length("text")), F.lit(1 << 20)) / F.lit(1 << 20)
    begin = F.pmod(
        F.xxhash64(F.lit(seed + 1), "doc_id"), F.greatest(F.length("text") - STRETCH, F.lit(1))
    )
    rows = (
        usable.where(hashed < F.element_at(keep, F.col("lang")))
        .select(F.substr("text", begin.cast("int") + 1, F.lit(STRETCH)).alias("text"), "lang")
        .limit(2 * per_language * len(sizes))
        .collect()
    )
    return sorted((r.text, r.lang) for r in rows)


def identify(docs: DataFrame, model: Field | None, keep_text: bool = True) -> DataFrame:
    """`docs` with `text` and any other columns -> the same rows with lang_pred and score.

    Only the text is read for a prediction. NULL text, or one without a letter, is `und` with score 0,
    and so is everything if there was nothing to learn from. One row per row of `docs`, also for repeated
    rows and NULL doc_id; columns named lang_pred or score are replaced. Nothing is shuffled.
    """
    docs = docs.drop("lang_pred", "score")
    if model is None:
        model = Field([UNDETERMINED], np.zeros((BUCKETS, 1), np.float32), np.zeros((1, 1), np.float32))
    kept = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(lambda batches: label_batches(batches, model, keep_text), schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text falls into the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 5) -> Field | None:
    """A field fitted on a bounded sample of `docs(doc_id, text, lang)`; None without labelled rows."""
    texts = sample_texts(docs, per_language, seed)
    return fit(texts, seed=seed) if texts else None
