"""Toxicity of whole texts by maximum-scoring segments.

Every word scores its log-odds between toxic and other labelled documents, under
a Dirichlet prior, less a drift that keeps the mean score of ordinary text
negative. The prior's strength grows with the word's frequency in the whole
corpus; it is split between the classes as the labelled words of the same stem
are, so that rare forms of a telling stem tell too. One linear scan finds
all maximal segments of positive score (the disjoint passages that no extension
improves). For ordinary text the best score of n words follows an extreme-value
law: ``K n exp(-lambda S)`` segments of score S are expected. ``lambda`` comes
from the word frequencies, ``K`` from ordinary labelled documents. A passage is
significant below ``PASSAGE_E`` expected ones; the evidence of a document is the
least probable sum of its best passages, as -log p, and a logistic curve fitted
on labelled documents turns it into a score from 0 to 1.

Words are counted in 2^21 hashed buckets, grouped by stem, so the model has a fixed size. Counts
cover the whole corpus; labels come from at most about ``LABELLED_ROWS`` rows,
drawn by a hash of the identifier. Three quarters of them teach the words, the
rest the two curves, so that no document calibrates words it has taught.

Cases: a null or empty text, or one without words, has no passages and gets the
score of no evidence; rows without identifier are never used for learning; a document with
several labels is toxic if one says so; null labels do not count; without
labels of both kinds every text gets one constant score; columns of the input named like
the added ones are replaced; an empty table stays empty.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ..sources.storage import stored
from .common import body, holding, kept, lean, packed, tidy, uniform, unpacked

LABELLED_ROWS = 200_000
FOLDS = 5
"""Rows with crc32(identifier) mod 5 = 0 are held out; remainder 4 calibrates."""
STEM_LETTERS = 4
STEMS, FORMS = 1 << 14, 1 << 7
BUCKETS = STEMS * FORMS
"""The bucket of a word: one of FORMS beside the other words of its stem."""
PRIOR_WORDS = 100.0
PRIOR_FLOOR = 5.0
"""Pseudo-counts of a word: its share of ``PRIOR_WORDS``, and ``PRIOR_FLOOR``."""
DRIFT = 2.0
PASSAGE_E = 0.05
REMEMBERED = 100_000
RIDGE = 1e-3

TOKEN = re.compile(r"\w+")
ADDED = ["score", "evidence", "passages"]
PASSAGES = "array<struct<start: int, stop: int, score: double, expected: double>>"
PASSAGE_TYPE = pa.list_(
    pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])
)
FINDING = pa.struct(
    [("words", pa.int64()), ("best", pa.float64()), ("evidence", pa.float64()), ("passages", PASSAGE_TYPE)]
)


class _Buckets(dict):
    """The bucket of a word, for the words met so far."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        code = lambda part: zlib.crc32(part.encode("utf-8", "surrogatepass"))
        bucket = self[word] = code(word[:STEM_LETTERS]) % STEMS * FORMS + code(word) % FORMS
        return bucket


BUCKET = _Buckets()


def buckets(text: str) -> np.ndarray:
    holding("toxicity", BUCKET.clear)
    words = TOKEN.findall(text.lower())
    return np.fromiter(map(BUCKET.__getitem__, words), np.int32, len(words))


@dataclass(frozen=True)
class Model:
    """What is learnt: a score per bucket and four numbers."""

    weights: np.ndarray
    scale: float
    """lambda"""
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = 0.0


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def sampled_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """(identifier, toxic, fold) of at most about ``LABELLED_ROWS`` rows that are not held out."""
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(F.col(key)) != 0))
    rows = rows.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    count = rows.count()
    chosen = rows.where(uniform(F.col("_key")) < F.lit(min(1.0, LABELLED_ROWS / max(count, 1))))
    return stored(chosen.withColumn("_fold", fold(F.col("_key"))), "labelled")


def counted(texts: DataFrame) -> DataFrame:
    """(bucket, seen, toxic, other): one line per bucket, summed over ``texts`` (text, group)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, BUCKETS), np.int64)
        for batch in batches:
            groups: dict[int, list[np.ndarray]] = {0: [], 1: [], 2: []}
            for text, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = buckets(text)
                groups[0].append(words)
                if group:
                    groups[group].append(words)
            for group, found in groups.items():
                if found:
                    places, times = np.unique(np.concatenate(found), return_counts=True)
                    sums[group][places] += times
        places = np.flatnonzero(sums[0])
        for start in range(0, len(places), 1 << 16):
            part = places[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), *[pa.array(sums[g][part]) for g in range(3)]],
                names=["bucket", "seen", "toxic", "other"],
            )

    rows = texts.mapInArrow(tidy(count), "bucket int, seen long, toxic long, other long")
    return rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("seen", "toxic", "other")])


def log_odds(seen: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log-odds of each bucket between the classes, shrunk to 0 by the corpus-wide prior."""
    totals = toxic.sum(), other.sum()
    if not all(totals):
        return np.zeros(len(seen))
    share = totals[0] / sum(totals)
    stem = lambda counts: counts.reshape(STEMS, FORMS).sum(axis=1).repeat(FORMS)
    toxic_part = (stem(toxic) + PRIOR_FLOOR * share) / (stem(toxic + other) + PRIOR_FLOOR)
    prior = PRIOR_WORDS * seen / max(seen.sum(), 1) + PRIOR_FLOOR
    rates = [
        (count + prior * part) / total
        for count, total, part in ((toxic, totals[0], toxic_part), (other, totals[1], 1 - toxic_part))
    ]
    return np.log(rates[0]) - np.log(rates[1])


def decay(weights: np.ndarray, frequency: np.ndarray) -> float:
    """lambda > 0 with sum(frequency * exp(lambda * weight)) = 1."""
    used = frequency > 0
    weights, frequency = weights[used], frequency[used] / max(frequency.sum(), 1)
    if not len(weights) or weights.max() <= 0 or (weights * frequency).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    excess = lambda x: (frequency * np.exp(x * weights)).sum() - 1
    while excess(high) < 0:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, stop, score), in linear time.

    Each candidate remembers its cumulative score before and after it, and the
    nearest candidate to its left that started lower.
    """
    done: list[tuple[int, int, float]] = []
    stack: list[list] = []
    before = np.concatenate([[0.0], np.cumsum(scores)])
    for at in np.flatnonzero(scores > 0).tolist():
        new = [at, at + 1, before[at], before[at + 1], -1]
        while True:
            left = len(stack) - 1
            while left >= 0 and stack[left][2] >= new[2]:
                left = stack[left][4]
            if left < 0:
                # Nothing before it can ever be joined to it.
                done += [(s, e, high - low) for s, e, low, high, _ in stack]
                stack = [new]
                new[4] = -1
                break
            if stack[left][3] >= new[3]:
                new[4] = left
                stack.append(new)
                break
            new = [stack[left][0], new[1], stack[left][2], new[3], -1]
            del stack[left:]
    return done + [(s, e, high - low) for s, e, low, high, _ in stack]


def evidence(scores: list[float], words: int, model: Model) -> float:
    """-log of the least p-value of the sum of the r best segments, over all r."""
    shift = model.log_k + math.log(max(words, 1))
    best, total = 0.0, 0.0
    for r, score in enumerate(sorted(scores, reverse=True), 1):
        excess = model.scale * score - shift
        if r > 1 and excess <= 0:
            break
        total += excess
        if r == 1:
            value = -math.log(max(-math.expm1(-math.exp(-max(excess, -30.0))), 1e-300)) if excess < 700 else excess
        else:
            value = total + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(max(total, 1e-9)) - math.log(2) * r
        best = max(best, value)
    return best


def finding(text: str, model: Model, with_passages: bool) -> dict:
    words = buckets(text)
    found = segments(model.weights[words]) if len(words) else []
    scores = [s for *_, s in found]
    limit = len(words) * math.exp(min(model.log_k, 50.0))
    significant = [
        (a, b, s, e) for a, b, s in found if (e := limit * math.exp(-model.scale * s)) < PASSAGE_E
    ]
    passages = []
    if significant and with_passages:
        places = [m.span() for m in TOKEN.finditer(text.lower())]
        passages = [
            {"start": places[a][0], "stop": places[b - 1][1], "score": s, "expected": e} for a, b, s, e in significant
        ]
    return {
        "words": len(words),
        "best": max(scores, default=0.0),
        "evidence": evidence(scores, len(words), model),
        "passages": passages,
    }


def findings(text: Column, model: Model, with_passages: bool = False) -> Column:
    spark_type = f"struct<words: long, best: double, evidence: double, passages: {PASSAGES}>"
    weights = model.weights

    @arrow_udf(spark_type)
    def find(texts: pa.Array) -> pa.Array:
        lean()
        used = Model(weights, model.scale, model.log_k, model.slope, model.offset)
        return pa.array([finding(t or "", used, with_passages) for t in texts.to_pylist()], FINDING)

    return find(text)


def logistic(evidence_: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score, by Newton steps; the slope is never negative."""
    if not len(toxic) or toxic.min() == toxic.max():
        rate = (toxic.sum() + 1.0) / (len(toxic) + 2.0)
        return 0.0, math.log(rate / (1 - rate))
    design = np.stack([evidence_, np.ones_like(evidence_)], axis=1)
    beta = np.array([0.0, math.log(toxic.mean() / (1 - toxic.mean()))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        gradient = design.T @ (toxic - p) - RIDGE * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(beta[0])), float(beta[1])


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Learns from all of ``docs`` (word frequencies) and the sampled labels."""
    chosen = F.broadcast(sampled_labels(labels, key, label))
    texts = docs.select(F.col(key).alias("_key"), body(text).alias("_text"))
    group = F.when(F.col("_fold") == FOLDS - 1, 0).otherwise(2 - F.col("_toxic"))
    all_texts = texts.join(chosen, "_key", "left").select("_text", F.coalesce(group, F.lit(0)).alias("_group"))
    lines = counted(all_texts).toArrow()
    table = np.zeros((3, BUCKETS))
    for row, name in enumerate(("seen", "toxic", "other")):
        table[row][np.asarray(lines["bucket"])] = np.asarray(lines[name])
    odds = log_odds(*table)
    weights = (odds - DRIFT).astype(np.float32) if odds.any() else np.full(BUCKETS, -DRIFT, np.float32)
    model = Model(weights, decay(weights.astype(np.float64), table[2]))

    # The calibrating rows are at most about a fourth of LABELLED_ROWS.
    calibrating = texts.join(chosen.where(F.col("_fold") == FOLDS - 1), "_key")
    measured = lambda m: calibrating.select("_toxic", findings(F.col("_text"), m).alias("f")).select(
        "_toxic", "f.words", "f.best", "f.evidence"
    ).toArrow()
    first = measured(model)
    toxic = np.asarray(first["_toxic"]).astype(float)
    words, best = np.asarray(first["words"]).astype(float), np.asarray(first["best"])
    ordinary = (toxic == 0) & (words > 0)
    log_k = 0.0
    if ordinary.any():
        excess = model.scale * best[ordinary] - np.log(words[ordinary])
        log_k = float(np.clip(-np.logaddexp.reduce(-excess) + math.log(len(excess)), -50, 50))
    model = Model(weights, model.scale, log_k)
    second = measured(model)
    slope, offset = logistic(np.asarray(second["evidence"]), np.asarray(second["_toxic"]).astype(float))
    return Model(weights, model.scale, log_k, slope, offset)


def scored(docs: DataFrame, model: Model, text: str = "text", with_passages: bool = True) -> DataFrame:
    """``docs`` with ``score``, ``evidence`` and the significant ``passages`` (character offsets of the text)."""
    columns = kept(docs, ADDED)
    found = packed(docs, columns).withColumn("found", findings(F.col("row").getField(text), model, with_passages))
    value = F.col("found.evidence") * F.lit(model.slope) + F.lit(model.offset)
    return found.select(
        *unpacked(columns),
        (1 / (1 + F.exp(-value))).alias("score"),
        F.col("found.evidence").alias("evidence"),
        F.col("found.passages").alias("passages"),
    )
