"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import awkward
import numpy as np
import pytest
from pyspark.sql import functions as F

from duecast.llm import (
    components,
    fingerprints,
    line_dedup,
    mixing,
    near_dedup,
    passages,
    pieces,
    sharding,
    top_k,
    toxicity,
    warc,
)


@pytest.fixture(scope="module")
def docs(spark):
    return awkward.docs(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return awkward.none(spark)


def lines_of(text):
    return (text or "").split("\n")


def test_passages(spark, docs, none):
    after = passages.remove(docs)
    assert after.columns == docs.columns and after.count() == docs.count()
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    places = defaultdict(set)
    for doc, text in before.items():
        if doc is not None and text is not None:
            for run, check, begin, stop in zip(*passages.runs(text)):
                places[run, check].add((doc, int(begin), int(stop)))
    covered = defaultdict(set)
    for found in places.values():
        for doc, begin, stop in found:
            if (doc, begin) > min((d, b) for d, b, _ in found):
                covered[doc] |= set(range(begin, stop))
    for r in after.collect():
        if r["doc_id"] is None:
            continue
        text = before[r["doc_id"]]
        want = text and "".join(c for i, c in enumerate(text) if i not in covered[r["doc_id"]])
        assert r["text"] == want
    nameless = lambda df: Counter(r["text"] for r in df.where("doc_id is null").collect())
    assert nameless(after) == nameless(docs)
    assert passages.remove(none).count() == 0 and passages.repeated(none).count() == 0


def test_passage_of_one_long_sentence(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice(awkward.VOCABULARY) for _ in range(60)) + "."
    rows = [(i, awkward.prose(rng, 5) + "\n" + long + "\n" + awkward.prose(rng, 5)) for i in range(3)]
    found = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in found} == {(1, 0), (2, 0)}
    assert all(long in rows[r["doc_id"]][1][r["begin"] : r["stop"]] for r in found)


def windows_met_before(texts, size=50, distinct=20):
    """For each text the word ranges of its windows that an earlier text has, by brute force."""
    seen, found = set(), []
    for text in texts:
        words = text.lower().split()
        own = [(i, tuple(words[i : i + size])) for i in range(len(words) - size + 1)]
        found.append([i for i, w in own if w in seen and len(set(w)) >= distinct])
        seen.update(w for _, w in own)
    return found


def word_starts(text):
    return [m.start() for m in re.finditer(r"\S+", text)]


def test_passages_inside_long_sentences(spark):
    rng = random.Random(5)
    some = lambda n: [rng.choice(awkward.VOCABULARY) for _ in range(n)]
    shared = some(50)
    cut = some(19) + ["end."] + some(9) + ["end."] + some(20)
    texts = [" ".join(some(30 + i) + shared + some(40 - i)) + "." for i in range(4)]
    texts += [" ".join(some(5 + i) + cut + some(9 - i)) + ".\n" + awkward.prose(rng, 4) for i in range(4)]
    texts += [" ".join(some(30) + [" ".join(shared).upper()] + some(3))]
    rows = list(enumerate(texts))
    got = defaultdict(set)
    for r in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r["doc_id"]] |= set(range(r["begin"], r["stop"]))
    met = windows_met_before(texts)
    assert [len(m) for m in met] == [0, 1, 1, 1, 0, 1, 1, 1, 1]
    for doc, at in enumerate(met):
        starts = word_starts(texts[doc])
        inside = {i for i in at for i in range(i, i + 50)}
        gone = {i for i, c in enumerate(starts) if c in got[doc]}
        assert gone <= inside and len(gone) >= 40 * bool(at)


def test_passages_of_short_sentences(spark):
    rng = random.Random(6)
    some = lambda n: [rng.choice(awkward.VOCABULARY) for _ in range(n)]
    menu = "".join(" ".join(some(rng.choice([1, 1, 2, 3]))) + rng.choice([".", "!", "\n"]) + " " for _ in range(30))
    short = "Yes. No. Yes. "
    ends = "".join(" ".join(some(n)) + ". " for n in (5, 4, 4, 1))
    texts = [awkward.prose(rng, 4) + "\n" + part + awkward.prose(rng, 4) for part in (menu, short, ends) for _ in "ab"]
    rows = list(enumerate(texts))
    got = defaultdict(set)
    for r in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r["doc_id"]] |= set(range(r["begin"], r["stop"]))
    assert set(got) == {1, 5}
    for doc, part in ((1, menu), (5, ends)):
        at = texts[doc].index(part)
        assert got[doc] == set(range(at, at + len(part)))


def test_passages_of_documents_that_share_an_identifier(spark):
    rng = random.Random(8)
    shared, own, other = (awkward.prose(rng, 5) + "\n" for _ in range(3))
    texts = [(1, shared + own), (2, other + shared), (2, awkward.prose(rng, 20)), (2, None), (None, shared)]
    twin = awkward.prose(rng, 5)
    texts += [(5, twin + " First."), (5, twin + " Second."), (5, twin + " Second.")]
    after = passages.remove(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    left = Counter((r["doc_id"], r["text"]) for r in after)
    assert left[2, other] == 1
    assert all(left[t] == 1 for t in texts[:1] + texts[2:5])
    fives = sorted(t for i, t in left.elements() if i == 5)
    assert fives in (sorted([texts[5][1], "Second.", "Second."]), sorted(["First.", texts[6][1], texts[7][1]]))


def brute_segments(scores):
    """Maximal segments by their definition: the best one, then left and right of it."""
    if not len(scores):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(((sums[j] - sums[i], -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    if best[0] <= 0:
        return []
    value, _, i, j = best
    right = [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]
    return [*brute_segments(scores[:i]), (i, j, value), *right]


def test_segments():
    rng = random.Random(2)
    for _ in range(200):
        scores = np.array([rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() * 0.01 for _ in range(rng.randint(0, 14))])
        got = sorted(toxicity.segments(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(scores)]


def test_toxicity(spark, docs, none):
    rng = random.Random(4)
    words = ["vile", "rotten"]
    rows, labels = [], []
    for i in range(400):
        text = awkward.prose(rng, 8)
        toxic = i % 5 == 0
        rows.append((i, text.replace(" ", f" {rng.choice(words)} ", 12) if toxic else text))
        labels.append((i, None if i % 17 == 0 else int(toxic)))
    corpus = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, labels[1], (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(corpus, marks)
    scored = {r["doc_id"]: r for r in toxicity.scored(corpus, model).collect()}
    assert all((scored[i]["score"] >= 0.5) == (i % 5 == 0) for i in range(400))
    for i in range(0, 400, 5):
        assert any("vile" in rows[i][1][p["start"] : p["stop"]] or "rotten" in rows[i][1][p["start"] : p["stop"]] for p in scored[i]["passages"])
    kept = toxicity.scored(docs, model)
    assert kept.count() == docs.count() and [c for c in kept.columns if c.lower() == "score"] == ["score"]
    assert all(0 <= r["score"] < 0.5 for r in kept.collect())
    unlabelled = toxicity.fit(corpus, marks.limit(0))
    assert {r["score"] for r in toxicity.scored(corpus, unlabelled).collect()} == {0.5}
    assert toxicity.scored(none, toxicity.fit(none, marks)).count() == 0


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = [(i, f"word{i % 7} other") for i in range(60)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string")
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    marks = lambda flip: spark.createDataFrame(
        [(i, (i % 7 == 0) ^ (flip and fold(i) == 0)) for i, _ in rows], "doc_id long, toxic boolean"
    ).withColumn("toxic", F.col("toxic").cast("int"))
    one, two = toxicity.fit(corpus, marks(False)), toxicity.fit(corpus, marks(True))
    assert (one.weights == two.weights).all() and (one.slope, one.offset) == (two.slope, two.offset)


def check_shards(rows, shards):
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return sizes


def test_sharding(spark, docs, none, tmp_path):
    got = sharding.assign(docs, 4)
    rows = got.collect()
    assert len(rows) == docs.count()
    check_shards(rows, 4)
    for r in rows:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
    assert sharding.assign(none).count() == 0
    sharding.write(docs, str(tmp_path / "shards"), 4)
    assert spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().count() == len({r["shard"] for r in rows})


def test_shards_with_a_third_of_equal_texts(spark):
    rng = random.Random(5)
    hot = awkward.prose(rng, 20)
    rows = [(i, hot if i % 3 == 0 else awkward.prose(rng, rng.randint(1, 40))) for i in range(3000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    sizes = check_shards(got, 8)
    share = sum(sizes.values()) / 8
    assert all(abs(s - share) < 0.03 * share + 4000 for s in sizes.values()) and len(sizes) == 8
    assert len({r["shard"] for r in got if r["doc_id"] % 3 == 0}) <= 4


def test_overfull_ranges_are_divided():
    cuts = sharding.splitters([(5, i, 1.0) for i in range(10)] + [(7, 1, 1.0), (9, 3, 1.0)], 6)
    assert sum(h == 5 for h, _ in cuts) >= 3 and all(i == sharding.FIRST for h, i in cuts if h != 5)


def test_line_dedup(spark, docs, none):
    got = line_dedup.drop_lines(docs)
    assert [c for c in got.columns if c.lower() not in line_dedup.ADDED] == [c for c in docs.columns if c.lower() not in line_dedup.ADDED]
    before = defaultdict(list)
    holders = defaultdict(set)
    for r in docs.collect():
        before[r["doc_id"]].append(r["text"])
        if r["doc_id"] is not None:
            for line in lines_of(r["text"]):
                holders[line.encode().strip().lower().decode()].add(r["doc_id"])
    keeper = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    assert keeper
    after = defaultdict(list)
    for r in got.collect():
        after[r["doc_id"]].append((r["text"], r["n_lines"], r["n_dropped"]))
    for doc, found in before.items():
        want = []
        for text in found:
            lines = lines_of(text)
            left = [x for x in lines if doc is None or keeper.get(x.encode().strip().lower().decode(), doc) == doc]
            want.append((text if len(left) == len(lines) else "\n".join(left), len(lines), len(lines) - len(left)))
        assert Counter(after[doc]) == Counter(want)
    assert line_dedup.drop_lines(none).count() == 0


def test_bloom_filter_holds_all_lines_seen_twice(spark):
    rows = [(i, f"the line number {i // 2} of all these lines") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", F.col("text").cast("binary"))
    for bits in (line_dedup.BLOCK_BITS, 4 * line_dedup.BLOCK_BITS):
        found = line_dedup.suspects(df, bits, 20).select("line").distinct().count()
        assert found == 200
    assert line_dedup.suspects(df.where("doc_id % 2 = 0"), line_dedup.BLOCK_BITS, 20).count() <= 2


def near_by_brute_force(rows, size):
    sets = []
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = None not in (rows[i][0], rows[j][0]) and sets[i] and sets[j]
            if both and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[top(i)].append(doc)
    return Counter(
        (doc, len(sets[i]), doc if doc is None or not sets[i] else min(least[top(i)])) for i, (doc, _) in enumerate(rows)
    )


def check_near(spark, rows, size=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dedup.link(df, size=size).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == near_by_brute_force(rows, size)


def variants(rng, count, words=120):
    base = [rng.choice(awkward.VOCABULARY) for _ in range(words)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randint(0, 14)):
            copy[rng.randrange(words)] = "x" + str(rng.randint(0, 999))
        out.append(" ".join(copy))
    return out


def test_near_dedup(spark, docs, none):
    check_near(spark, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert near_dedup.link(none).count() == 0


def test_near_dedup_of_loose_groups(spark, monkeypatch):
    rng = random.Random(8)
    texts = [t for _ in range(4) for t in variants(rng, 60)] + [awkward.prose(rng, 6) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    check_near(spark, rows)
    # The same with neighbourhoods dealt over many parts.
    monkeypatch.setattr(near_dedup, "PART_ROWS", 16)
    check_near(spark, rows)
    check_near(spark, rows, 5)


def test_sketches_estimate_similarity_and_merge():
    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.8, 0.95):
        errors = []
        for _ in range(20):
            pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            common = int(1000 * share)
            half = common + (1000 - common) // 2
            one, two = pool[:half], np.concatenate([pool[:common], pool[half:]])
            a, b = near_dedup.registers(one), near_dedup.registers(two)
            assert (near_dedup.registers(pool) == np.maximum(a, b)).all()
            sizes = np.array([len(one)]).astype(float), np.array([len(two)]).astype(float)
            errors.append(near_dedup.estimated(*sizes, a[None], b[None])[0] - share)
        assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.08


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_fingerprints(spark, docs, none):
    got = fingerprints.with_neighbour(docs).collect()
    assert len(got) == docs.count()
    by_text = defaultdict(set)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        if r["doc_id"] is not None:
            by_text[texts[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by_text.values())
    order = sorted({d for d in texts if d is not None}, reverse=True)
    for doc, following in zip(order, order[1:]):
        changed = fingerprints.edited(texts[doc] or "", texts[following] or "")
        assert hashlib.sha256(changed.encode()).hexdigest() in {r["edited_sha256"] for r in got if r["doc_id"] == doc}
    assert fingerprints.with_neighbour(none).count() == 0
    alone = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert fingerprints.with_neighbour(alone).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_chunks_resist_shifts():
    rng = random.Random(9)
    text = awkward.prose(rng, 300)
    one, two = fingerprints.chunks(text.encode()), fingerprints.chunks(("inserted " + text).encode())
    assert fingerprints.contained(one, two) > 0.95
    ends = fingerprints.boundaries(text.encode())
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes[:-1].min() >= fingerprints.LEAST and sizes.max() <= fingerprints.MOST
    assert fingerprints.read(fingerprints.written(one)) == one
    slow = [0]
    data = text.encode()
    for b in data:
        slow.append((slow[-1] * 2 + int(fingerprints.GEAR[b])) & 0xFFFFFFFF)
    assert fingerprints.gear_hashes(np.frombuffer(data, np.uint8)).tolist() == slow[1:]


def test_warc(spark, none):
    big = "x" * 1200
    rows = [(i, f"http://e/{i}\r\n", t) for i, t in enumerate([None, "", "small", "small", big, big, "ä" * 700, big, "ä" * 700, "<p>" + "z" * 500_000])]
    rows += [(7, "http://again", big), (None, None, big), (20, None, big)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload string, digest string")
    archive = warc.write_archives(pages).cache()
    records = warc.read_archives(archive, with_payload=True).collect()
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        holders = [p for p, _, h in rows if h == html and p is not None]
        first = max(holders, default=None)
        revisit = len(raw) >= 1000 and page is not None and page < first
        want.append((warc.record_id(page), "revisit" if revisit else "response", warc.record_id(first) if revisit else None, hashlib.sha1(raw).hexdigest(), len(raw), b"" if revisit else raw))
    assert Counter(map(lambda r: tuple(bytes(x) if isinstance(x, bytearray) else x for x in r), records)) == Counter(want)
    wanted = spark.createDataFrame([("urn:page:9",), ("urn:page:4",)], "record_id string")
    found = {r["record_id"]: r for r in warc.fetch(archive, wanted).collect()}
    assert bytes(found["urn:page:9"]["payload"]) == rows[9][2].encode() and found["urn:page:4"]["refers_to"] == "urn:page:20"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(empty)).count() == 0


def test_bundle_frames_are_independent(spark, tmp_path):
    import zstandard

    rng = random.Random(1)
    pages = spark.createDataFrame([(i, "u", awkward.prose(rng, 200)) for i in range(100)], "page_id long, url string, html string").coalesce(1)
    archive = warc.write_archives(pages)
    data = bytes(archive.first()["data"])
    frames = warc.seek_table(data)
    assert len(frames) > 3
    assert sum(len(warc.frame_bytes(data, f)) for f in frames) == archive.first()["raw_bytes"]
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(whole) == archive.first()["raw_bytes"] and whole.startswith(b"WARC/1.1\r\n")
    paths = [r["path"] for r in warc.export(archive, str(tmp_path)).collect()]
    assert open(paths[0], "rb").read() == data


def top_by_brute_force(rows, k):
    clean = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            clean[vec_id, tuple(vector)] = [int(np.floor(1024 * float(np.float32(x)))) for x in vector]
    out = []
    for (query, _), q in clean.items():
        if query % 4 == 0:
            scores = [(-sum(a * b for a, b in zip(q, v)), other) for (other, _), v in clean.items() if other != query and len(v) == len(q)]
            out += [(query, rank, other, -low) for rank, (low, other) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=8) * 0.05]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    rows += [(2000, None), (2004, [float("nan")] * 8), (2008, [None] * 8), (2012, [float("inf")] * 8), (None, rows[1][1])]
    rows += [(3000 + i, [0.5, float(i)]) for i in range(12)] + [(4000, []), (4001, []), (4004, [1e5, 2e5, 3.0]), (4005, [1e5, 2e5, 3.0])]
    rows += [rows[0], rows[5]]
    schema = "vec_id long, embedding array<float>, vec string, ids string"
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], schema).repartition(4)
    query = F.col("vec_id") % 4 == 0
    ours = lambda: sorted(tuple(r) for r in top_k.search(df, query).collect())
    want = top_by_brute_force(rows, 10)
    assert ours() == want
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 64)
    monkeypatch.setattr(top_k, "SAMPLE_ROWS", 50)
    monkeypatch.setattr(top_k, "LEAF_ROWS", 8)
    assert ours() == want
    assert top_k.search(df.limit(0), query).count() == 0


def test_cover_trees_prune():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16)) * 1000
    data = np.concatenate([c + rng.normal(size=(200, 16)) * 5 for c in centres]).astype(np.int64)
    tree = top_k.CoverTree(data)
    seen = []

    def walk(node):
        rows = data[tree.order[node.start : node.stop]]
        assert np.sqrt(((rows - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-6
        if node.children:
            assert [c.start for c in node.children[1:]] == [c.stop for c in node.children[:-1]]
            assert (node.children[0].start, node.children[-1].stop) == (node.start, node.stop)
        else:
            seen.append(len(rows))
        for child in node.children:
            walk(child)

    walk(tree.root)
    assert sum(seen) == len(data)


def test_mixing(spark, docs, none):
    got = mixing.mix(docs)
    rows = got.collect()
    assert len(rows) == docs.count() and Counter(rows) == Counter(mixing.mix(docs.repartition(5)).select(*got.columns).collect())
    words = lambda t: len((t or "").encode().split())
    assert all(r["size"] == words(r["text"]) and 0 <= r["copies"] <= 2 for r in rows)
    out = mixing.copied(got, docs.columns)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["target"], r["copies"]) for r in mixing.mix(blank).collect()} <= {(0.0, 0)}


def test_mix_draws_larger_documents_more_often(spark):
    rows = [(i, "w " * (10 if i % 2 else 40), "s" if i < 3000 else "t") for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 1), share=0.5)
    taken = {(r["source"], r["size"]): r["n"] for r in got.groupBy("source", "size").agg(F.avg("copies").alias("n")).collect()}
    assert taken["s", 40] > taken["s", 10]
    near = got.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("w"), F.first("target").alias("t")).collect()
    assert all(abs(r["w"] - r["t"]) <= 20 for r in near)


@pytest.fixture(scope="module")
def model():
    return pieces.model_bytes()


def awkward_strings():
    rng = random.Random(11)
    signs = "abcdefghij teh nrs  \n日é🙂<>/0123_ABC.²ª,"
    out = [t for t in awkward.texts() if t] + ["a" * 3000, "=" * 500 + "-" * 300, "a_b x² _. a.b_c Foo.Bar 3.14,15 ._ __., é.è", "\t\0\r", "<s></s><0x0A>", " x", "x "]
    out += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 200))) for _ in range(150)]
    return out + ["".join(rng.choice("the ain") for _ in range(rng.randint(1, 300))) for _ in range(80)]


def test_pieces_equal_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    vocabulary = pieces.vocabulary(model)
    for text in awkward_strings():
        assert vocabulary.encode(text).tolist() == library.encode(text)
        assert vocabulary.decode(vocabulary.encode(text)) == text


def best_sum(vocabulary, text):
    """The best sum of scores over the whole lattice, without a window."""
    best = [0.0]
    for stop in range(1, len(text) + 1):
        ends = [(i, text[i:stop]) for i in range(max(0, stop - 20), stop)]
        best.append(max(best[i] + vocabulary.scores.get(p, vocabulary.least if len(p) == 1 else -np.inf) for i, p in ends))
    return best[-1]


def test_unigram_pieces_have_the_best_sum(model):
    """The same pieces as a unigram model."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    message = proto.ModelProto()
    message.ParseFromString(model)
    message.trainer_spec.model_type = pieces.UNIGRAM
    vocabulary = pieces.Vocabulary(message.SerializeToString())
    score = lambda ids: sum(vocabulary.scores[vocabulary.text[i]] for i in ids)
    for text in awkward_strings():
        marked = (" " + text[:1000]).replace(pieces.MARK, " ")
        known = "".join(c for c in marked if c in vocabulary.ids)
        ours = [i for stretch in vocabulary.stretches.findall(known) for i in vocabulary.search(stretch)]
        assert score(ours) == best_sum(vocabulary, known)
        assert vocabulary.decode(vocabulary.encode(text)) == text


def test_window_commits_before_the_end(model):
    vocabulary = pieces.Vocabulary(model)
    windows = []
    path = vocabulary._path
    vocabulary._path = lambda last, text, base: windows.append(len(last)) or path(last, text, base)
    text = "thereinonthisand" * 400
    assert vocabulary.search(text) == pieces.vocabulary(model).search(text)
    assert len(windows) > 20 and max(windows) < 10 * vocabulary.longest


def test_pieces_columns(spark, docs, none, model):
    coded = docs.select("doc_id", "text", pieces.encoded(F.col("text"), model).alias("ids"))
    rows = coded.select("*", pieces.decoded(F.col("ids"), model).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") and (r["ids"] == []) == (not r["text"]) for r in rows)
    lists = spark.createDataFrame([(None,), ([],), ([None, 1, 2, 99999, 450],)], "ids array<int>")
    assert [r[0] for r in lists.select(pieces.decoded(F.col("ids"), model)).collect()] == [None, "", pieces.vocabulary(model).decode([450])]
    assert none.select(pieces.encoded(F.col("text"), model)).count() == 0


def test_pipeline_stages(spark, small, docs, none):
    import corpus_pipeline

    own = {r["doc_id"]: r for r in docs.collect()}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, small).cache()
        if name != "tokens":
            assert rows.columns == docs.columns and rows.count() > 20
            fixed = [c for c in docs.columns if c not in ("text", "n_chars")]
            for r in rows.where("doc_id is not null").collect():
                assert all(r[c] == own[r["doc_id"]][c] for c in fixed)
                assert (r["n_chars"] or 0) == len(r["text"] or "")
    assert rows.where("not round_trip").isEmpty()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, small).count() == 0


def test_near_copies_that_share_an_identifier(spark, docs, none):
    import corpus_pipeline

    rng = random.Random(9)
    copied, alone, twice, more = (awkward.prose(rng, 20) for _ in range(4))
    near = lambda text: text.replace(" ", " changed ", 1)
    rows = [(3, copied), (7, alone), (7, near(copied)), (8, twice), (8, twice), (9, more), (9, near(more)), (9, None), (9, None)]
    rows += [(None, copied), (None, copied), (10, near(twice))]
    after = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    left = Counter((r["doc_id"], r["text"]) for r in after.collect())
    assert left[9, more] + left[9, near(more)] == 1
    left = Counter({k: n for k, n in left.items() if k[0] != 9 or k[1] is None})
    assert left == Counter([(3, copied), (7, alone), (8, twice), (9, None), (9, None), (None, copied), (None, copied)])


def test_part_of_the_same_rows_is_taken(spark):
    rows = [(1, "a b c d e f g h i j", "s")] * 600 + [(i, f"{i} " + "w " * (i % 17), "s") for i in range(10, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for weights, share in (((1,), 1.2), ((1,), 0.4), ((1,), 1.77)):
        got = mixing.mix(df, weights=weights, share=share).collect()
        assert len(got) == len(rows)
        taken = sum(r["size"] * r["copies"] for r in got)
        assert abs(taken - got[0]["target"]) <= 10
        again = mixing.mix(df.repartition(3), weights=weights, share=share).collect()
        assert Counter((r["doc_id"], r["copies"]) for r in again) == Counter((r["doc_id"], r["copies"]) for r in got)


def test_thousands_of_shared_lines_in_one_text(spark):
    lines = [f"shared line number {i} of a long list" for i in range(12_000)]
    rows = [(i, "\n".join(lines + [f"own line of {i}"])) for i in range(3)]
    got = line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in got} == {0: (12_001, 12_000), 1: (12_001, 12_000), 2: (12_001, 0)}
    assert {r["doc_id"]: r["text"] for r in got}[1] == "own line of 1"


def test_a_batch_is_coded_in_little_memory():
    """What coding a batch takes beside its results does not grow with the batch."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from duecast.llm import pieces

    words = pieces.vocabulary(pieces.model_bytes())
    draw = np.random.default_rng(1)
    texts = [" ".join("".join(map(chr, draw.integers(97, 123, 7))) for _ in range(150)) for _ in range(900)]
    words.encode(texts[0])
    tracemalloc.start()
    coded = words.encode_all(texts)
    encoding = tracemalloc.get_traced_memory()
    tracemalloc.reset_peak()
    lists = pa.array([np.frombuffer(c, words.kept_as).astype(np.int32) for c in coded] + [None, []], pa.list_(pa.int32()))
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    decoded = words.decode_lists(lists)
    decoding = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert decoded.to_pylist() == [*texts, None, ""]
    assert encoding[1] - encoding[0] < 45e6 and decoding < 15e6, (encoding, decoding)
