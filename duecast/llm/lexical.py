"""Ranked lexical search with hashed max-sketches.

A document's impact of a term is what the term adds to its score. The impacts of a
document fold into a sketch: terms are hashed to ``WIDTH`` coordinates, and each
coordinate keeps the largest impact of its terms. Looking up a query's terms in the sketch and adding
gives an upper bound of the score; a batch of documents is looked up for all queries of a block
as one matrix product. Each query then goes through the documents of the batch by
descending bound and scores them exactly until no bound reaches its worst k-th score. A
bound that equals it is still scored, as ties go to the smaller identifier.

Documents are read once: terms of the queries are counted and stored (the others only
add to a document's length), corpus statistics are sums over that table, and the search reads
it again. Queries are dealt over blocks of bounded vocabulary, which is all that tasks
are sent. Each task leaves its best k of every query; the best of those are
the result.

Score: with N documents of at least one term, L terms in all, n in the document, df documents
with the term and tf of it in the document, w = floor(1000 ln((2 N + 2) / (2 df + 1))),
m = 10 + 90 n N div L, and a term adds w (1000000000 tf div (1000 tf + 8 m)), in 64 bits.

Cases: terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z
in lower case; a null text has no terms; items that share an identifier are one item of
all their terms; rows without identifier are no items, and documents without one count in the
statistics but are not ranked; documents that repeat an identifier are documents of their own, in
any order among equal scores; an item without terms, an empty table and a score of 0 give no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.storage import stored
from .common import body

WIDTH = 1024
"""Coordinates of a sketch."""

BLOCK_TERMS, BLOCK_ITEMS = 500_000, 2048
"""Most distinct terms and items of a block, on average of a dealing by hash."""

WINDOW = 1 << 20
"""Bytes of a text that are split into terms at once."""

TERM = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
"""Every byte of a term, A-Z lower-cased; all others become spaces."""


def terms(text: bytes, window: int = WINDOW) -> Iterator[list[bytes]]:
    """The terms of a text, window by window."""
    start, size = 0, len(text)
    while start < size:
        stop = min(size, start + window)
        part = text[start:stop].translate(TERM)
        if stop < size:
            # A term that the window cuts belongs to the next one, if it does not fill this one.
            last = part.rfind(b" ")
            while last < 0 and stop < size:
                stop = min(size, stop + window)
                part = text[start:stop].translate(TERM)
                last = part.rfind(b" ") if stop < size else len(part)
            if stop < size:
                stop = start + last + 1
                part = part[: last + 1]
        yield part.split()
        start = stop


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, terms) of every item with terms: the distinct ones, sorted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted({t for part in terms(x) for t in part}) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(own, pa.list_(pa.binary()))], ["item", "terms"])

    rows = items.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("item"), body(text).cast("binary").alias("text")
    )
    one = rows.mapInArrow(cut, "item long, terms array<binary>").select("item", F.explode("terms").alias("term"))
    return one.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def counted(docs: DataFrame, vocabulary: list[bytes], key: str, text: str) -> DataFrame:
    """(doc, n, terms, times): the length of every document and its terms of the vocabulary, as int32 arrays."""
    # Tasks get the vocabulary as one string: the smallest form of it.
    packed, window = b" ".join(vocabulary), WINDOW

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(packed.split(b" "))} if packed else {}
        for batch in batches:
            sizes, found, times = [], [], []
            for data in batch.column("text").to_pylist():
                seen: Counter = Counter()
                n = 0
                for part in terms(data, window):
                    n += len(part)
                    seen.update(part)
                own = seen.keys() & number.keys() if len(seen) < len(number) else [t for t in number if t in seen]
                sizes.append(n)
                found.append(np.fromiter((number[t] for t in own), np.int32, len(own)).tobytes())
                times.append(np.fromiter((seen[t] for t in own), np.int32, len(own)).tobytes())
            columns = [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(found, pa.binary()), pa.array(times, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "terms", "times"])

    rows = docs.select(F.col(key).cast("long").alias("doc"), body(text).cast("binary").alias("text"))
    return rows.mapInArrow(count, "doc long, n long, terms binary, times binary")


def holders(counts: DataFrame, size: int) -> np.ndarray:
    """The number of documents with each term of the vocabulary: one partial count a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "docs"])

    sums = counts.select("terms").mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs"))
    df = np.zeros(size, np.int64)
    for term, docs in sums.collect():  # at most one row a term of the block
        df[term] = docs
    return df


class Best:
    """The best k of a query so far: highest score, then smallest identifier."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a score must reach to matter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        good = scores >= self.least
        if good.any():
            scores, docs = np.concatenate([self.scores, scores[good]]), np.concatenate([self.docs, docs[good]])
            first = np.lexsort((docs, -scores))[: self.k]
            self.scores, self.docs = scores[first], docs[first]


def sketches(rows: np.ndarray, coordinates: np.ndarray, impacts: np.ndarray, count: int, width: int) -> np.ndarray:
    """The coordinatewise maxima of ``count`` documents. Sketches of parts of a document merge by maximum."""
    folded = np.zeros(count * width)
    np.maximum.at(folded, rows * width + coordinates, impacts.astype(np.float64))
    return folded.reshape(count, width)


def slices(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The places from every start to its stop."""
    sizes = stops - starts
    return np.repeat(stops - np.cumsum(sizes), sizes) + np.arange(sizes.sum())


def searched(counts: DataFrame, items: list[tuple[int, np.ndarray]], vocabulary: list[bytes], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best k documents of every item, task by task."""
    width = WIDTH
    hashed = np.array([xxhash.xxh3_64_intdigest(t) % width for t in vocabulary], np.int64)
    # The lookups of all items: how many of an item's terms share a coordinate.
    lookups = np.zeros((width, len(items)), np.float32)
    for at, (_, own) in enumerate(items):
        np.add.at(lookups[:, at], hashed[own], 1)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        wanted = np.zeros(len(weights), bool)
        query = lookups.astype(np.float64)
        for batch in batches:
            held = [batch.column(c).to_pylist() for c in ("terms", "times")]
            docs, n = np.asarray(batch.column("doc")), np.asarray(batch.column("n"))
            stops = np.cumsum([len(t) // 4 for t in held[0]])
            starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
            term, tf = (np.frombuffer(b"".join(h), np.int32).astype(np.int64) for h in held)
            rows = np.repeat(np.arange(len(docs)), stops - starts)
            m = 10 + (90 * n * n_docs) // n_terms
            impacts = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[rows]))
            # Sums of doubles may round down; the factor keeps bounds upper bounds.
            bounds = (sketches(rows, hashed[term], impacts, len(docs), width) @ query) * (1 + 1e-12)
            for at, (_, own) in enumerate(items):
                found, bound = best[at], bounds[:, at]
                near = np.flatnonzero(bound >= found.least)
                near = near[np.argsort(-bound[near], kind="stable")]
                wanted[own] = True
                start, step = 0, 32
                while start < len(near) and bound[near[start]] >= found.least:
                    some = near[start : start + step]
                    places = slices(starts[some], stops[some])
                    adds = np.where(wanted[term[places]], impacts[places], 0)
                    sizes = stops[some] - starts[some]
                    found.add(np.add.reduceat(adds, np.cumsum(sizes) - sizes), docs[some])
                    start, step = start + step, 2 * step
                wanted[own] = False
        ids = np.repeat([i for i, _ in items], [len(b.docs) for b in best]).astype(np.int64)
        join = lambda parts: np.concatenate([*parts, np.zeros(0, np.int64)])
        found = [ids, join([b.docs for b in best]), join([b.scores for b in best])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["item_id", "doc_id", "score"])

    return counts.where("doc IS NOT NULL AND length(terms) > 0").mapInArrow(search, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = docs.sparkSession
    queries = stored(item_terms(items, item, text), "item_terms")
    total, size = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(1, -(-total // BLOCK_ITEMS), -(-size // BLOCK_TERMS))
    found = []
    for block in range(blocks):
        # The block's items: their number and vocabulary are bounded.
        own = queries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item").collect()
        vocabulary = sorted({bytes(t) for row in own for t in row["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        listed = [(row["item"], np.array([number[bytes(t)] for t in row["terms"]], np.int64)) for row in own]
        counts = stored(counted(docs, vocabulary, doc, text), "term_counts")
        n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if n_docs and listed:
            df = holders(counts, len(vocabulary))
            weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
            found.append(stored(searched(counts, listed, vocabulary, weights, n_docs, n_terms, k), "best_of_tasks"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score"
    )
