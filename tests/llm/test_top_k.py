"""Nearest vectors by blocks: what is sent, what is multiplied, and ties."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from duecast.llm import top_k


def test_leaves_meet_as_a_few_large_products(monkeypatch):
    rng = np.random.default_rng(11)
    queries, data = (np.floor(1024 * rng.normal(size=(n, 16)) / 4).astype(np.int16) for n in (400, 6000))
    met, reach = [], top_k.reach
    monkeypatch.setattr(top_k, "reach", lambda *pair: met.append(pair) or reach(*pair))
    scores, found = top_k.best_in_block(queries, np.full(400, -np.inf), data, np.arange(6000)[::-1].copy(), 5)
    assert len(met) < 100
    every = queries.astype(np.int64) @ data.astype(np.int64).T
    for got, places, own in zip(scores, found, every):
        want = sorted(range(6000), key=lambda i, own=own: (-own[i], -i))[:5]
        assert list(places) == want and list(got) == [own[i] for i in want]


def test_vectors_travel_as_bytes_of_the_least_width(spark, monkeypatch):
    wide = np.array([[1, -2], [-32768, 32767], [32768, 0], [2**31, 0], [top_k.LONG, -top_k.LONG - 1]])
    held = sorted((int(i), v) for index, vec in top_k.as_bytes(wide) for i, v in zip(index, vec))
    assert [len(v.as_py()) for _, v in held] == [5, 5, 9, 17, 17]
    assert (top_k.numbers(pa.array([v.as_py() for _, v in held])[1:]) == wide[1:]).all()
    assert top_k.numbers(pa.array([v.as_py() for _, v in held])[:2]).dtype == np.int16
    kinds, stored = {}, top_k.stored
    monkeypatch.setattr(top_k, "stored", lambda df, name: kinds.update({name: dict(df.dtypes)}) or stored(df, name))
    rows = spark.range(40).selectExpr("id AS vec_id", "array(id / 8, 1.5D) AS embedding")
    assert top_k.search(rows, F.col("vec_id") % 4 == 0, 3).count() == 30
    assert kinds["entries"]["vec"] == kinds["queries"]["vec"] == "binary"


def test_a_crowd_of_ties_is_cut_before_it_is_sorted():
    queries, data = np.ones((50, 2), np.int16), np.stack([np.ones(5000), np.arange(5000) % 3], axis=1).astype(np.int16)
    firsts = np.random.default_rng(5).permutation(5000)
    scores, found = top_k.best_in_block(queries, np.full(50, -np.inf), data, firsts, 4)
    want = sorted(np.flatnonzero(data[:, 1] == 2), key=lambda i: firsts[i])[:4]
    assert (found == want).all() and (scores == 3).all()
