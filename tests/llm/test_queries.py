"""Registered queries: those with SQL against it, the others against brute force on whole tables."""

import hashlib
import zlib
from collections import defaultdict

import comparing
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from duecast.llm import fingerprints, passages, pieces
from duecast.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, small, name):
    assert comparing.differences(QUERIES[name](spark, small), comparing.duck(small), ORACLE[name]) is None


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()


def test_every_operator_has_a_query():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_passages_by_brute_force(spark, small, documents):
    places = defaultdict(list)
    for row in documents:
        for run, check, begin, stop in zip(*passages.runs(row["text"])):
            places[run, check].append((row["doc_id"], int(begin), int(stop)))
    covered = defaultdict(set)
    for found in places.values():
        for doc, begin, stop in found:
            if (doc, begin) > min((d, b) for d, b, _ in found):
                covered[doc] |= set(range(begin, stop))
    got = defaultdict(set)
    for row in QUERIES["op1_passages"](spark, small).collect():
        assert (row["first_doc_id"], row["first_begin"]) < (row["doc_id"], row["begin"])
        got[row["doc_id"]] |= set(range(row["begin"], row["stop"]))
    assert got == covered and covered


def test_every_document_without_its_passages(spark, small, documents):
    gone = defaultdict(list)
    for row in QUERIES["op1_passages"](spark, small).collect():
        gone[row["doc_id"]].append((row["begin"], row["stop"]))
    rows = {r["doc_id"]: r for r in QUERIES["op1_removal"](spark, small).collect()}
    assert sorted(rows) == [d["doc_id"] for d in documents] and gone
    for d in documents:
        text, found = d["text"] or "", sorted(gone[d["doc_id"]])
        for begin, stop in reversed(found):
            text = text[:begin] + text[stop:]
        row = rows[d["doc_id"]]
        assert [tuple(p) for p in row["passages"] or []] == found
        assert row["kept_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_toxicity_on_held_out_documents(spark, small):
    rows = QUERIES["op2_toxicity"](spark, small.replace("sf0.001", "sf0.1"))
    labels = spark.read.parquet(small.replace("sf0.001", "sf0.1") + "/labels.parquet").where("toxic is not null")
    held = rows.join(labels, "doc_id").where("held_out").select("doc_id", "score", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in held)
    toxic = [r["score"] for r in held if r["toxic"]]
    clean = [r["score"] for r in held if not r["toxic"]]
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert wins > 0.95
    assert sum(s >= 0.5 for s in clean) <= 0.01 * len(clean) and sum(s >= 0.5 for s in toxic) >= 0.85 * len(toxic)


def test_shards(spark, small, documents):
    rows = QUERIES["op3_sharding"](spark, small).collect()
    assert sorted(r["doc_id"] for r in rows) == [d["doc_id"] for d in documents]
    text = {d["doc_id"]: (d["text"] or "").encode() for d in documents}
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 8, zlib.crc32(text[r["doc_id"]]))
        assert (r["law"], r["grown_shard"]) == ("bytes", None) and 0 <= r["shard"] < 24
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share, largest = sum(sizes.values()) / 24, max(r["size"] for r in rows)
    assert all(abs(s - share) <= largest + 0.04 * share for s in sizes.values())


def test_fingerprints_by_brute_force(spark, small, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op6_fingerprints"](spark, small).collect()}
    down = documents[::-1]
    assert len(rows) == len(down)
    for at, doc in enumerate(down):
        text, following = doc["text"] or "", down[(at + 1) % len(down)]["text"] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        row, own = rows[doc["doc_id"]], fingerprints.chunks(text.encode())
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["fingerprint"] == fingerprints.written(own)
        assert row["near_edited"] == fingerprints.contained(own, fingerprints.chunks(changed.encode()))
        assert row["near_next"] == fingerprints.contained(own, fingerprints.chunks(following.encode()))


def test_mix_near_targets(spark, small, documents):
    rows = QUERIES["op9_mixing"](spark, small).collect()
    assert sorted(rows) == sorted(QUERIES["op9_mixing"](spark, small).collect())
    source = {d["doc_id"]: d["source"] for d in documents}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] <= 2 * r["size"]
    order = sorted(sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, free, rest = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            rest -= want[s]
        free -= over
    want |= {s: weight[s] * level for s in free}
    for s in order:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= largest[s] / 2


def test_pieces_like_the_library(spark, small, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = {r["doc_id"]: r for r in QUERIES["op10_pieces"](spark, small).collect()}
    for doc in documents:
        row = rows[doc["doc_id"]]
        assert row["ids"] == library.encode(doc["text"] or "") and row["n_tokens"] == len(row["ids"])
        assert row["round_trip"]


def test_texts_are_encoded_once(spark, small):
    """A function that decodes another one's ids would have Spark call that one again."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for rows in (QUERIES["op10_pieces"](spark, small), corpus_pipeline.tokens(spark, docs, small)):
        plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
        calls = [line for line in plan if "ArrowEvalPython" in line]
        assert len(calls) == 1 and calls[0].count("(text#") == 1


def test_pipeline_by_brute_force(spark, small):
    """Each stage against the plain meaning of its decision, on its own input."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, small).cache()
    assert clean.columns == columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert all(d in kept for d, toxic in labels.items() if toxic == 0)
    assert sum(d not in kept for d, toxic in labels.items() if toxic) >= 0.5 * sum(t or 0 for t in labels.values())

    lines = stages["line dedup"](spark, clean, small).cache()
    holders = defaultdict(set)
    for r in clean.collect():
        for line in (r["text"] or "").split("\n"):
            holders[line.encode().strip().lower()].add(r["doc_id"])
    drop = {k: max(v) for k, v in holders.items() if len(v) >= 3 and len(k.decode()) >= 20}
    before = {r["doc_id"]: r for r in clean.collect()}
    for r in lines.collect():
        want = [x for x in before[r["doc_id"]]["text"].split("\n") if drop.get(x.encode().strip().lower(), r["doc_id"]) == r["doc_id"]]
        assert r["text"] == "\n".join(want)

    single = stages["near dedup"](spark, lines, small).cache()
    sets = {}
    for r in lines.collect():
        w = r["text"].encode().lower().split()
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}
    order = sorted(sets)
    top = lambda d: d if root[d] == d else top(root[d])
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    assert sorted(r["doc_id"] for r in single.collect()) == [d for d in order if top(d) == d]

    mixed = stages["mixing"](spark, single, small).cache()
    assert mixed.columns == columns
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert max(times.values()) <= 2
    size = lambda df: {r["source"]: r["w"] for r in df.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("w")).collect()}
    assert abs(sum(size(mixed).values()) / sum(size(single).values()) - 1.5) < 0.1

    coded = stages["tokens"](spark, mixed, small)
    assert coded.count() == mixed.count() and coded.where("not round_trip").isEmpty()


def test_pipeline_runs_as_registered(spark, small):
    assert corpus_pipeline.run(spark, small).where("not round_trip").isEmpty()
