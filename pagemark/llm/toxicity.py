"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

1. Log-odds with a Dirichlet prior say how much more often a word occurs in toxic documents, and how much
   more often a run of characters does in words that are no evidence as a whole. A known token scores
   the lower confidence bound of its own log-odds, a rare one the best bound of its parts; a drift is
   taken off, so that tokens without evidence score below zero.
2. A linear scan finds all maximal scoring segments of a text.
3. In clean text, segments above a level come at a rate that falls exponentially with their score. The
   rate is fitted on documents the log-odds have not seen, which gives every segment the number of such
   segments expected by chance in a text of that length. The logarithms of those below one add up
   to a document's evidence, and a logistic curve turns evidence into a probability.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemark.llm.common import stored

WORD = re.compile(r"[^\W_]+")
#: The classifier is fitted on a bounded sample of labelled rows, chosen by hash.
SAMPLE_ROWS = 18_000
#: Share of the sample that calibrates; the rest gives the log-odds.
CALIBRATION = 1 / 3
#: Features the model keeps, best first, and words whose scores a worker remembers.
MAX_FEATURES = 50_000
REMEMBERED = 500_000
GRAMS = (3, 4, 5)
SKETCHES = 4
DRIFT = 0.25
#: Pseudo-documents of the prior, spread like the features of all documents; the toxic rows if fewer.
PRIOR = 100.0
#: A feature is evidence if its log-odds exceed the least bound by CONFIDENCE standard errors.
CONFIDENCE = 2.58
LEAST_WORD, LEAST_PART = 0.7, 1.6
#: Clean documents that make a word known, so that its own log-odds count and not those of its parts.
KNOWN = 3
LEVEL = 0.5
MOST_EVIDENCE = 40.0


def word_parts(word: str) -> set[str]:
    """The character runs of a word; blanks mark where it begins and ends."""
    marked = f" {word.lower()} "
    return {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)  # 0 for known words without evidence
    parts: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0  # of the rate of chance segments, per unit of score
    rate: float = 0.0  # chance segments per token, carried back to score 0
    base: float = -20.0  # logit without evidence
    slope: float = 1.0


class TokenScores(dict):
    """Token -> score, worked out once per token."""

    def __init__(self, model: Model):
        super().__init__()
        self.words, self.parts = model.words, model.parts

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        best = self.words.get(word.lower())
        if best is None:  # parts speak for words that are rare or new
            parts = self.parts
            best = max((parts[f] for f in word_parts(word) if f in parts), default=0.0)
        self[word] = score = best - DRIFT
        return score


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, end, score), in linear time.

    Candidates are kept on a stack with the running sums at their left and right ends. A new positive
    score becomes a candidate; as long as there is an earlier candidate that begins lower, and ended no
    higher than the new one does, they become one. `below` links a candidate to the nearest earlier one
    that begins lower, so no candidate is looked at twice. Only positive scores are visited.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    first, end, left, right, below = [], [], [], [], []
    for at in np.flatnonzero(scores > 0).tolist():
        start, low, high = at, float(total[at]), float(total[at + 1])
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= low:
                j = below[j]
            if j < 0 or right[j] >= high:
                break
            start, low = first[j], left[j]
            for stack in (first, end, left, right, below):
                del stack[j:]
        first.append(start)
        end.append(at + 1)
        left.append(low)
        right.append(high)
        below.append(j)
    return [(a, b, h - x) for a, b, x, h in zip(first, end, left, right, strict=True)]


def evidence(segments: list[float], tokens: int, model: Model) -> float:
    """Sum of -ln(expected chance segments) over the significant segments."""
    if not segments or model.rate <= 0:
        return 0.0
    chance = math.log(model.rate * max(tokens, 1))
    return min(MOST_EVIDENCE, sum(max(0.0, model.decay * s - chance) for s in segments))


def probability(x: float, model: Model) -> float:
    return 1 / (1 + math.exp(-(model.base + model.slope * x)))


def segment_batches(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    """(key, text) -> number of tokens and the scores of the maximal segments."""
    scores = TokenScores(model)
    for batch in batches:
        rows = []
        for text in batch.text:
            words = WORD.findall(text)
            found = np.fromiter(map(scores.__getitem__, words), float, len(words))
            rows.append((len(words), [s for _, _, s in maximal_segments(found)]))
        yield pd.DataFrame(
            {
                "toxic": batch.toxic,
                "tokens": [n for n, _ in rows],
                "segments": [s for _, s in rows],
            }
        )


def score_batches(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    scores = TokenScores(model)
    for batch in batches:
        values, passages = [], []
        for text in batch.text:
            words = WORD.findall(text)
            found = np.fromiter(map(scores.__getitem__, words), float, len(words))
            segments = maximal_segments(found)
            values.append(probability(evidence([s for _, _, s in segments], len(words), model), model))
            chance = math.log(model.rate * max(len(words), 1)) if model.rate > 0 else math.inf
            significant = [x for x in segments if model.decay * x[2] > chance]
            places = [m.span() for m in WORD.finditer(text)] if significant else []
            passages.append(
                [
                    (places[a][0], places[b - 1][1], s, math.exp(chance - model.decay * s))
                    for a, b, s in significant
                ]
            )
        yield batch.drop(columns="text").assign(score=values, passages=passages)


def feature_counts(
    batches: Iterator[pa.RecordBatch], parts_of_other_than: set[str] | None
) -> Iterator[pa.RecordBatch]:
    """(text, toxic) -> documents holding each feature, summed per task before they are shuffled.

    Features are words or, given words that are evidence themselves, the parts of all other words.
    """
    memory: dict[str, set[str]] = {}
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        clean, toxic = counts
        names = list(clean.keys() | toxic.keys())
        frame = pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(names, pa.string()),
                "clean": pa.array([clean[f] for f in names], pa.int64()),
                "toxic": pa.array([toxic[f] for f in names], pa.int64()),
            }
        )
        clean.clear()
        toxic.clear()
        return frame

    for batch in batches:
        columns = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
        for text, toxic in zip(*columns, strict=True):
            held = {word.lower() for word in WORD.findall(text)}
            if parts_of_other_than is not None:
                words, held = held - parts_of_other_than, set()
                for word in words:
                    found = memory.get(word)
                    if found is None:
                        if len(memory) > 50_000:
                            memory.clear()
                        found = memory[word] = word_parts(word)
                    held |= found
            counts[int(toxic)].update(held)
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield flush()
    yield flush()


def log_odds(sample: DataFrame, docs: dict[int, int], words: set[str] | None) -> DataFrame:
    """feature, clean, toxic (documents holding it) and bound, the lower bound of its log-odds."""
    counts = (
        sample.select("text", "toxic")
        .mapInArrow(
            lambda batches: feature_counts(batches, words), "feature string, clean long, toxic long"
        )
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counts = stored(counts, "features")
    # shares are of all features held, so longer documents on one side do not count as evidence
    all_clean, all_toxic = (float(x or 0) for x in counts.agg(F.sum("clean"), F.sum("toxic")).first())
    weight = min(PRIOR, docs[1]) / (docs[0] + docs[1])
    prior = weight * (F.col("clean") + F.col("toxic"))
    all_prior = weight * (all_clean + all_toxic)

    def odds(held: str, size: float):
        return F.log((F.col(held) + prior) / (size + all_prior - F.col(held) - prior))

    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    bound = odds("toxic", all_toxic) - odds("clean", all_clean) - CONFIDENCE * spread
    return counts.select("feature", "clean", "toxic", bound.alias("bound"))


def strongest(bounds: DataFrame, least: float) -> dict[str, float]:
    rows = bounds.where(f"bound > {least}").orderBy(F.desc("bound"), "feature").limit(MAX_FEATURES)
    return {r.feature: r.bound for r in rows.collect()}


def learn(sample: DataFrame) -> Model:
    """Evidence of words, and of parts in the words that are no evidence as a whole."""
    docs = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not docs.get(0) or not docs.get(1):
        return Model()
    bounds = log_odds(sample, docs, None)
    words = strongest(bounds, LEAST_WORD)
    parts = strongest(log_odds(sample, docs, set(words)), LEAST_PART)
    known = bounds.where(f"bound <= {LEAST_WORD} and clean >= {KNOWN}")
    plain = known.orderBy(F.desc("clean"), "feature").limit(MAX_FEATURES).collect()
    return Model({r.feature: 0.0 for r in plain} | words, parts)


def calibrate(model: Model, rows: list[tuple[int, int, list[float]]]) -> Model:
    """Fit the chance rate on clean rows and the logistic curve on all; rows: (toxic, tokens, segments)."""
    above = [s - LEVEL for toxic, _, segments in rows if not toxic for s in segments if s > LEVEL]
    tokens = sum(n for toxic, n, _ in rows if not toxic)
    # the median, as one text that repeats a word for pages would rule a mean
    model.decay = math.log(2) / float(np.median([*above, math.log(2)]))
    model.rate = (len(above) + 0.5) / max(tokens, 1) * math.exp(model.decay * LEVEL)
    x = np.array([evidence(segments, n, model) for _, n, segments in rows])
    y = np.array([float(toxic) for toxic, _, _ in rows])
    # logistic regression by Newton steps; a weak pull towards a slope of one keeps separable data finite
    design = np.stack([np.ones_like(x), x], axis=1)
    at = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 1.0])
    pull, centre = np.diag([0.02, 2.0]), np.array([-2.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (y - p) - pull @ (at - centre)
        curve = (design * (p * (1 - p))[:, None]).T @ design + pull
        move = np.linalg.solve(curve, slope)
        at = at + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    model.base, model.slope = float(at[0]), float(max(at[1], 0.0))
    return model


def sketch_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, text) -> doc_id and the least of SKETCHES hashes over the text's runs of three words."""
    factors = np.array([2 * i + 1 for i in range(SKETCHES)], dtype=np.uint64) * np.uint64(
        0x9E3779B97F4A7C15
    )
    for batch in batches:
        least = []
        for text in batch.text:
            codes = np.array([zlib.crc32(w.encode()) for w in WORD.findall(text)] or [0], dtype=np.uint64)
            wide = np.concatenate([codes, np.zeros(2, np.uint64)])
            runs = codes * np.uint64(31) + wide[1:-1] * np.uint64(1_000_003) + wide[2:] * np.uint64(7_368_787)
            runs ^= runs >> np.uint64(29)
            mixed = (runs[:, None] * factors[None, :]) ^ (factors[None, :] >> np.uint64(7))
            least.append(((mixed * factors[::-1][None, :]) >> np.uint64(1)).min(axis=0))
        found = np.array(least, dtype=np.int64).reshape(-1, SKETCHES)
        yield pd.DataFrame({"doc_id": batch.doc_id, **{f"s{i}": found[:, i] for i in range(SKETCHES)}})


def without_copies(sample: DataFrame) -> DataFrame:
    """The sample with few of each group of near copies, which would count one text's words many times."""
    sketches = stored(
        sample.select("doc_id", "text").mapInPandas(
            sketch_batches, "doc_id long, " + ", ".join(f"s{i} long" for i in range(SKETCHES))
        ),
        "sketches",
    )
    kept = sketches
    for i in range(SKETCHES):
        firsts = kept.groupBy(f"s{i}").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
        kept = kept.join(firsts, "doc_id", "left_semi")
    return sample.join(kept.select("doc_id"), "doc_id", "left_semi")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> Model:
    """Fit on about `sample_rows` labelled documents: `docs(doc_id, text)`, `labels(doc_id, toxic)`.

    Rows are chosen by a hash of doc_id; all labelled rows if there are fewer. Rows with NULL doc_id,
    text or label are left out, a doc_id with several labels is toxic if one says so, and of near copies
    few stay.
    """
    marked = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = min(1.0, sample_rows / max(1, marked.count()))

    def point(salt: int):
        return F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 24)) / F.lit(float(1 << 24))

    chosen = marked.where(point(seed) < share).withColumn("calibrates", point(seed + 1) < CALIBRATION)
    # bounded by sample_rows: a few bytes for each row of the sample
    sample = stored(
        docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id"),
        "labelled",
    )
    sample = stored(without_copies(sample), "labelled")
    model = learn(sample.where("not calibrates"))
    if not model.words and not model.parts:
        return model
    rows = (
        sample.where("calibrates")
        .select("text", "toxic")
        .mapInPandas(
            lambda batches: segment_batches(batches, model),
            "toxic int, tokens long, segments array<double>",
        )
        .collect()
    )
    return calibrate(model, sorted((r.toxic, r.tokens, list(r.segments)) for r in rows))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """`docs(doc_id, text)` -> doc_id, score, predicted, passages (start, end, score, expected).

    Only the text counts. `start` and `end` are character places of a significant passage, `expected` is
    how many as high come by chance in a text as long. One row per row of `docs`; NULL and empty texts
    have no evidence; NULL doc_id stays NULL; other columns are ignored. Nothing is shuffled.
    """
    texts = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    out = texts.mapInPandas(
        lambda batches: score_batches(batches, model),
        "doc_id string, score double, "
        "passages array<struct<start: int, end: int, score: double, expected: double>>",
    )
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )
