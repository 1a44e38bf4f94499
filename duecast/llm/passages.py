"""Removal of passages that stand elsewhere already.

Every run of ``RUN`` consecutive sentences is hashed, and shorter runs that have
``LONG_WORDS`` words already. So are stretches of ``LONG_WORDS`` words wherever
sentences end: of any ``WINDOW`` that start at words in a row the one of least
hash. What is chosen depends on those words alone, so every repeat of
``SURE_WORDS`` words holds a stretch that is chosen at both places. A run is
repeated if another place in the corpus has the same run; its first place, by
identifier and offset, stays, and what any other place covers is removed.

Runs are counted by a 64-bit hash, a shuffle of hashes alone. Only runs that a filter
of the repeated hashes lets through then travel with their places, are told apart by a second hash and meet
their first place in a join. A passage that a third of all documents share is
counted by partial sums, and its join, with first places stored before, is split by adaptive execution.

Sentences end after ``.``, ``!``, ``?`` or a line end; they are equal if their
words are, in any letter case. Runs of fewer than ``LEAST_WORDS`` words are too
common to mean anything; they are extended, once forwards and once backwards,
until they have as many. So every sentence of a repeated passage of three
sentences and ``LEAST_WORDS`` words lies in a run within the passage.

Cases: null and empty texts and rows without identifier keep all they have and
are never a first place; rows that share an identifier and text are one place,
those that share an identifier alone are places of their own;
a passage that repeats within a document is removed from its second place on;
other columns pass through; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from ..sources.storage import stored
from .common import packed, unpacked
from .membership import membership

RUN = 3
LONG_WORDS = 40
LEAST_WORDS = 12
SURE_WORDS = 50
WINDOW = SURE_WORDS - LONG_WORDS + 1
WORDS_HELD = 1 << 18
SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")
MIX = (np.random.default_rng(1).integers(0, 1 << 63, 5, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
BASE = [int(m) for m in MIX[1:]]


def sentences(text: str) -> list[str]:
    """The sentences of a text, whose concatenation is the text."""
    return SENTENCE.findall(text)


class Digests(dict):
    """The two hashes of words, in any letter case; forgotten when they are many."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = pair = xxhash.xxh3_128_digest(word.lower().encode("utf-8", "surrogatepass"))
        return pair


_DIGESTS = Digests()


def spans(digests: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """A hash of the digests from each start up to its stop."""
    powers = np.full(len(digests) + 1, base, np.uint64)
    inverse = np.full(len(digests) + 1, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digests * powers[:-1], dtype=np.uint64)])
    out = (sums[stops] - sums[starts]) * inverse[starts]
    out = (out ^ (out >> np.uint64(32)) ^ (stops - starts).astype(np.uint64)) * MIX[0]
    return out ^ (out >> np.uint64(31))


def stretches(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, second hash, first character, end) of the chosen stretches of words of a text.

    White space after a stretch goes with it.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = SPACE[np.minimum(points, len(SPACE) - 1)]
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(points) else np.zeros(0, np.int64)
    places = len(begins) - LONG_WORDS + 1
    if places < WINDOW:
        none = np.zeros(0, np.uint64)
        return none, none, begins[:0], begins[:0]
    pairs = np.frombuffer(b"".join(map(_DIGESTS.__getitem__, text.split())), np.uint64).reshape(-1, 2)
    starts = np.arange(places)
    one = spans(pairs[:, 0], starts, starts + LONG_WORDS, BASE[0])
    least = np.lib.stride_tricks.sliding_window_view(one, WINDOW).argmin(axis=1)
    chosen = np.unique(least + np.arange(len(least)))
    two = spans(pairs[:, 1], chosen, chosen + LONG_WORDS, BASE[1])
    bounds = np.append(begins, len(points))
    return one[chosen], two, begins[chosen], bounds[chosen + LONG_WORDS]


def runs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, second hash, first character, end) of every run and chosen stretch of a text."""
    parts = sentences(text)
    lengths = [0]
    lengths += [len(p) for p in parts]
    ends = np.cumsum(lengths)
    words = [p.lower().split() for p in parts]
    # White space between sentences belongs to no run of its own.
    real = [i for i, w in enumerate(words) if w]
    count = np.array([len(words[i]) for i in real], dtype=np.int64)
    digests = [xxhash.xxh3_128_digest(" ".join(words[i]).encode("utf-8", "surrogatepass")) for i in real]
    pairs = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    begins, stops = ends[:-1][real], ends[1:][real]
    first, last = sentence_runs(count)
    one, two = spans(pairs[:, 0], first, last, BASE[2]), spans(pairs[:, 1], first, last, BASE[3])
    return tuple(np.concatenate(c) for c in zip((one, two, begins[first], stops[last - 1]), stretches(text)))


def sentence_runs(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and the one after the last of every run, from the words of the sentences."""
    n = len(count)
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    at = np.arange(n + 1)
    found = [(at[:-size], at[size:]) for size in range(1, min(RUN, n + 1))]
    found = [(a[sums[b] - sums[a] >= LONG_WORDS], b[sums[b] - sums[a] >= LONG_WORDS]) for a, b in found]
    ahead = np.maximum(at + RUN, np.searchsorted(sums, sums + LEAST_WORDS, "left"))
    found.append((at[ahead <= n], ahead[ahead <= n]))
    back = np.minimum(at - RUN, np.searchsorted(sums, sums - LEAST_WORDS, "right") - 1)
    # A run that needed no more words was found from its first sentence.
    new = (back >= 0) & (ahead[np.maximum(back, 0)] != at)
    found.append((back[new], at[new]))
    first, last = (np.concatenate(c) for c in zip(*found))
    return first, last


DOCUMENT = ["doc_id", "text_digest"]


def identity(key: Column, text: Column) -> tuple[Column, Column]:
    """What tells documents apart: the identifier, and the text where rows share one."""
    return key.cast("long"), F.xxhash64(text)


def hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(run, check, doc_id, text_digest, begin, stop) of all runs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [runs(body) for body in batch.column(2).to_pylist()]
            if columns:
                sizes = [len(c[0]) for c in columns]
                run, check, begin, stop = (np.concatenate(c) for c in zip(*columns))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run.view(np.int64)),
                        pa.array(check.view(np.int64)),
                        pa.array(np.repeat(np.asarray(batch.column(0)), sizes)),
                        pa.array(np.repeat(np.asarray(batch.column(1)), sizes)),
                        pa.array(begin.astype(np.int32)),
                        pa.array(stop.astype(np.int32)),
                    ],
                    names=["run", "check", "doc_id", "text_digest", "begin", "stop"],
                )

    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    own = [c.alias(name) for c, name in zip(identity(F.col(key), F.col(text)), DOCUMENT)]
    rows = rows.select(*own, F.col(text).alias("text")).where("doc_id IS NOT NULL")
    return rows.mapInArrow(cut, "run long, check long, doc_id long, text_digest long, begin int, stop int")


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_digest, begin, stop, first_doc_id, first_begin): the passages that stand elsewhere already.

    Overlapping runs are one passage; its first place is that of its first run.
    """
    places = stored(hashed(docs, key, text), "runs")
    twice = places.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run")
    twice = stored(twice, "repeated_hashes")
    suspects = places.where(membership(twice)(F.col("run")))
    again = stored(suspects.join(twice, "run", "left_semi"), "repeated_runs")
    # Stored, so that both sides of the join are plain shuffles, which adaptive execution splits.
    first = stored(again.groupBy("run", "check").agg(F.min(F.struct(*DOCUMENT, "begin")).alias("first")), "first_places")
    later = again.join(first, ["run", "check"]).where(F.struct(*DOCUMENT, "begin") > F.col("first"))
    later = later.select(*DOCUMENT, "begin", "stop", "first")
    before = Window.partitionBy(*DOCUMENT).orderBy("begin", "stop").rowsBetween(Window.unboundedPreceding, -1)
    apart = later.withColumn("reach", F.max("stop").over(before)).withColumn(
        "new", (F.col("reach").isNull() | (F.col("begin") > F.col("reach"))).cast("int")
    )
    upto = Window.partitionBy(*DOCUMENT).orderBy("begin", "stop").rowsBetween(Window.unboundedPreceding, 0)
    return (
        apart.withColumn("passage", F.sum("new").over(upto))
        .groupBy(*DOCUMENT, "passage")
        .agg(
            F.min("begin").alias("begin"),
            F.max("stop").alias("stop"),
            F.min(F.struct("begin", "first"))["first"].alias("first"),
        )
        .select(
            *DOCUMENT,
            "begin",
            "stop",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.begin").alias("first_begin"),
        )
    )


def without(text: Column, passages: Column) -> Column:
    """The text without the characters of ``passages`` (begin, stop), null or a list."""

    @arrow_udf("string")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for body, found in zip(texts.to_pylist(), lists.to_pylist()):
            if body is not None and found:
                at, kept = 0, []
                for p in sorted(found, key=lambda p: p["begin"]):
                    kept.append(body[at : p["begin"]])
                    at = p["stop"]
                body = "".join([*kept, body[at:]])
            out.append(body)
        return pa.array(out, pa.string())

    return cut(text, passages)


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, passages, kept) of every document: its columns, what is removed (null if nothing), the text that stays.

    Only documents that may lose something are shuffled.
    """
    found = repeated(docs, key, text).groupBy(*DOCUMENT).agg(
        F.sort_array(F.collect_list(F.struct("begin", "stop"))).alias("passages")
    )
    found = stored(found, "passages")
    rows = packed(docs, docs.columns)
    own = identity(F.col("row").getField(key), F.col("row").getField(text))
    maybe = membership(found.select("doc_id").distinct())(own[0])
    same = (own[0] == F.col("doc_id")) & (own[1] == F.col("text_digest"))
    touched = rows.where(maybe).join(found, same, "left").select("row", "passages")
    touched = touched.withColumn("kept", without(F.col("row").getField(text), F.col("passages")))
    nothing = F.lit(None).cast(found.schema["passages"].dataType)
    rest = rows.where(~maybe).select("row", nothing.alias("passages"), F.col("row").getField(text).alias("kept"))
    return rest.unionByName(touched)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the repeated passages."""
    after = cleaned(docs, key, text)
    return after.select(
        *[F.col("kept").alias(c) if c == text else column for c, column in zip(docs.columns, unpacked(docs.columns))]
    )
