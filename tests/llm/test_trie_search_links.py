"""The prefix trie, ranked lexical search and near-duplicate vectors on awkward rows, against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from duecast.llm import lexical, prefix_trie, subspace

# ---- prefix trie -------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth string, hi string, conv string, n_convs string"


def trie_of(rows, family=100, most=6):
    """(conv_id, depth) of every node with its values, by a dictionary of prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    turns = {c: [t for *_, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    rebuilt = {}
    for conv, mine in turns.items():
        cut = zlib.crc32(str(conv).encode()) % most
        rebuilt[conv] = turns.get(conv - int(math.fmod(conv, family)), [])[:cut] + mine[cut:]
    members = defaultdict(list)
    for conv, mine in rebuilt.items():
        for depth in range(len(mine) + 1):
            members[tuple(mine[:depth])].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for prefix, convs in members.items():
        own_saved = (len(convs) - 1) * len(prefix[-1][1]) if prefix else 0
        for depth in range(len(prefix) + 1):
            leaves[prefix[:depth]] += not children[prefix]
            saved[prefix[:depth]] += own_saved
    out = {}
    for prefix, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(prefix))))
        parent = min(members[prefix[:-1]]) if prefix else None
        out[min(convs), len(prefix)] = (
            parent, len(convs), children[prefix], leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()
        )
    return out


def conversation_rows():
    rng = random.Random(3)
    rows = []
    for conv in range(-3, 240):
        for turn in range(rng.randint(1, 8)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["hello", "Hello", "", None, "été 🙂", "x" * rng.randint(1, 3)])))
    for turn in range(90):  # a long one, and one that shares most of it
        rows.append((400, turn, "user", f"t{turn}"))
        rows.append((401, turn, "user", f"t{turn}" if turn < 70 else "other"))
    rows += [(500, None, "user", "first"), (500, 3, "user", "b"), (500, 3, "user", "a"), (500, 3, "user", "a")]
    rows += [(601, 0, "user", "its family has no first conversation"), (None, 0, "user", "nobody's")]
    rows += [(c, t, "user", "the same") for c in range(700, 760) for t in range(3)]
    return rows


@pytest.mark.parametrize("band, hot, piece", [(16, 1_000_000, 1 << 14), (3, 40, 7)])
def test_trie_of_awkward_conversations(spark, monkeypatch, band, hot, piece):
    for name, value in (("BAND", band), ("HOT_ROWS", hot), ("PIECE", piece)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, *[None] * 4) for r in rows], TURNS).repartition(3)
    got = prefix_trie.trie(*prefix_trie.borrowed(prefix_trie.numbered(df))).collect()
    columns = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {(r["conv_id"], r["depth"]): tuple(r[c] for c in columns) for r in got} == trie_of(rows)
    assert len(got) == len(trie_of(rows))


def test_trie_of_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(*prefix_trie.borrowed(prefix_trie.numbered(empty))).count() == 0


def test_every_level_of_bands_is_used(spark):
    # 90 turns under bands of 3: 3, 9, 27 and 81 levels a band.
    assert 3**4 < 90 < 3**5


# ---- ranked lexical search -----------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def search(docs, items, k=10):
    lists = [(doc, terms_of(text)) for doc, text in docs]
    n_docs, n_terms = sum(bool(t) for _, t in lists), sum(len(t) for _, t in lists)
    df = Counter(term for _, t in lists for term in set(t))
    asked = defaultdict(set)
    for item, text in items:
        if item is not None:
            asked[item] |= set(terms_of(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for doc, t in lists:
            tf, score = Counter(t), 0
            for term in wanted & tf.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += weight * (1_000_000_000 * tf[term] // (1000 * tf[term] + 8 * (10 + 90 * len(t) * n_docs // n_terms)))
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


def lexical_rows():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma7", "été", "ÉTÉ", "日本", "x", "the", "the", "the", "end"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    docs += [(900 + i, docs[7][1]) for i in range(20)]
    docs += [(7, docs[7][1]), (None, "alpha alpha"), (950, None), (951, ""), (952, "!!! --"), (953, "alpha" * 3000), (954, "zig-zag " * 40_000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(4))) for i in range(12)]
    items += [(3, "zag"), (20, None), (21, ""), (22, "nowhere to be found"), (None, "alpha"), (23, "Alpha, ALPHA; (zig)"), (24, "alpha" * 3000)]
    return docs, items


@pytest.mark.parametrize("width, window, block", [(1024, 1 << 20, 2048), (2, 64, 5)])
def test_search_ranks_as_brute_force(spark, monkeypatch, width, window, block):
    for name, value in (("WIDTH", width), ("WINDOW", window), ("BLOCK_ITEMS", block)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = lexical_rows()
    extra = ", score string, rank string, doc string, n string, item string"
    df = spark.createDataFrame([(*d, *[None] * 5) for d in docs], "doc_id long, text string" + extra).repartition(4)
    asked = spark.createDataFrame([(*i, *[None] * 5) for i in items], "item_id long, text string" + extra)
    got = lexical.ranked(df, asked).collect()
    assert Counter(tuple(r) for r in got) == search(docs, items)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert lexical.ranked(docs, items).count() == 0
    some = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.ranked(some, none).count() == 0


@pytest.mark.parametrize("window", [1, 2, 5, 64])
def test_windows_cut_no_term(window):
    for text in ("alpha beta,gamma", "", "  ", "x" * 300, "été 日本 " * 20, "a b" * 50, "end "):
        assert [t.decode() for part in lexical.terms(text.encode(), window) for t in part] == terms_of(text)


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(2)
    rows, coordinates = np.repeat(np.arange(50), 40), rng.integers(0, lexical.WIDTH, 2000)
    impacts = rng.integers(1, 10**10, 2000)
    folded = lexical.sketches(rows, coordinates, impacts, 50, lexical.WIDTH)
    assert (folded[rows, coordinates] >= impacts).all()


# ---- near-duplicate vectors ------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, node string, n string, h1 string, component_id string"


def links_of(rows, least=0.95):
    good = []
    for at, (vec, x) in enumerate(rows):
        if vec is not None and x and all(v is not None and math.isfinite(v) for v in x) and any(x):
            v = np.array(np.array(x, np.float32), np.float64)
            good.append((at, v / np.linalg.norm(v)))
    degree, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(good):
        for b, y in good[:i]:
            if len(x) == len(y) and x @ y >= least:
                degree[a], degree[b] = degree[a] + 1, degree[b] + 1
                root[max(top(a), top(b))] = min(top(a), top(b))
    lowest = {}
    for at, (vec, _) in enumerate(rows):
        if vec is not None:
            lowest[top(at)] = min(vec, lowest.get(top(at), vec))
    return Counter((v, degree[at], lowest.get(top(at)), v is None or lowest[top(at)] == v) for at, (v, _) in enumerate(rows))


def vector_rows(width):
    rng = np.random.default_rng(11)
    rows = []
    for centre in rng.normal(size=(25, width)):
        centre /= np.linalg.norm(centre)
        for spread in rng.choice([0.0, 0.02, 0.1, 0.2, 0.3], rng.integers(1, 12)):
            rows.append((len(rows), [float(v) for v in centre * rng.uniform(0.5, 9) + spread * rng.normal(size=width) / width**0.5]))
    path = np.zeros(width)
    for angle in np.arange(0, 3, 0.25):  # a chain whose ends are far apart
        path[:2] = (math.cos(angle), math.sin(angle))[:width]
        rows.append((len(rows) + 1000, [float(v) for v in path]))
    rows += [(2000 + i, rows[3][1]) for i in range(40)]
    rows += [(3, rows[3][1]), (4, rows[9][1]), (None, rows[3][1]), (3000, None), (3001, []), (3002, [0.0] * width)]
    rows += [(3003, [math.nan] * width), (3004, [math.inf] + [0.0] * (width - 1)), (3005, [None] * width), (3006, rows[3][1] + [0.0]), (3007, rows[3][1] + [0.0])]
    rows += [(3008, [v * 1e30 for v in rows[3][1]]), (None, None)]
    return rows


@pytest.mark.parametrize("width, part, chunk", [(16, 16_384, 512), (16, 20, 3), (3, 16_384, 512), (1, 8, 2)])
def test_links_of_awkward_vectors(spark, monkeypatch, width, part, chunk):
    monkeypatch.setattr(subspace, "PART_ROWS", part)
    monkeypatch.setattr(subspace, "CHUNK", chunk)
    rows = vector_rows(width)
    df = spark.createDataFrame([(*r, *[None] * 5) for r in rows], VECTORS).repartition(3)
    got = subspace.link(df).select("vec_id", "n_links", F.col("component_id"), "kept").collect()
    assert Counter(tuple(r) for r in got) == links_of(rows)


def test_links_of_nothing(spark):
    assert subspace.link(spark.createDataFrame([], VECTORS)).count() == 0
    got = subspace.link(spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1, True), (2, 0, 2, True)]
