"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    fingerprints,
    lexical,
    line_dedup,
    mixing,
    near_dedup,
    passages,
    pieces,
    prefix_trie,
    sharding,
    subspace,
    top_k,
    toxicity,
    warc,
)
from .common import body, table


def op1_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: the passages it loses and the digest of the text that stays."""
    return passages.cleaned(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "passages", F.sha2(body("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False))
    return toxicity.scored(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
        "passages",
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(body("text").cast("binary"), 256).alias("kept_sha256")
    )


OP4_SQL = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (k.doc_id < s.keeper) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY pos) FILTER (NOT coalesce(k.doc_id < s.keeper, FALSE)), ''))
         AS kept_sha256
FROM keyed k LEFT JOIN shared s ON k.key = s.key GROUP BY k.doc_id
"""


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words
),
items AS (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS h FROM sets),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS nu, b.n AS nv, count(*) AS c
  FROM items a JOIN items b ON a.h = b.h AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
),
links AS (SELECT u, v FROM shared WHERE 100 * c >= 80 * (nu + nv - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u
),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.doc_id
"""


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_neighbour(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archives(table(spark, sf_dir, "pages"))
    number = lambda c: F.regexp_extract(c, r"(-?\d+)$", 1).try_cast("long")
    return warc.read_archives(archive).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


OP7_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM p),
g AS (SELECT digest, n, max(page_id) AS response FROM d WHERE n >= 1000 GROUP BY digest, n)
SELECT d.page_id, d.n::BIGINT AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.page_id < g.response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id < g.response THEN g.response END AS refers_to
FROM d LEFT JOIN g ON d.digest = g.digest AND d.n = g.n
"""


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH raw AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
  FROM raw q JOIN raw c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score FROM ranked WHERE rank <= 10
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.model_bytes()
    coded = table(spark, sf_dir, "documents").select("doc_id", pieces.checked(F.col("text"), model).alias("coded"))
    return coded.select("doc_id", F.size("coded.ids").alias("n_tokens"), "coded.ids", "coded.round_trip")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin with turns of their family's first one."""
    return prefix_trie.trie(*prefix_trie.borrowed(prefix_trie.numbered(table(spark, sf_dir, "conversations"))))


OP11_SQL = """
WITH turns AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
         turn FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos FROM turns
),
crc AS (
  SELECT conv_id, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce(range(8), lambda s, k: xor(s >> 1, 3988292384 * (s & 1)), xor(c, b)), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)
),
own AS (SELECT conv_id, count(*) AS n FROM placed GROUP BY conv_id),
plan AS (
  SELECT c.conv_id, c.h, c.conv_id - c.conv_id % 100 AS base, least(c.h, coalesce(b.n, 0)) AS taken
  FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
),
rebuilt AS (
  SELECT p.conv_id, t.pos AS depth, t.d, t.chars FROM plan p JOIN placed t ON t.conv_id = p.base AND t.pos <= p.h
  UNION ALL
  SELECT p.conv_id, t.pos - p.h + p.taken, t.d, t.chars FROM plan p JOIN placed t ON t.conv_id = p.conv_id AND t.pos > p.h
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM plan
),
paths AS (
  SELECT conv_id, depth, chars, md5(string_agg(d, ' ') OVER (PARTITION BY conv_id ORDER BY depth)) AS key,
         max(depth) OVER (PARTITION BY conv_id) AS length
  FROM rebuilt
),
over_paths AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths),
nodes AS (
  SELECT key, depth, parent, chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '') AS ends
  FROM over_paths GROUP BY key, depth, parent, chars
),
kids AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
valued AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN k.key IS NULL THEN 1 ELSE 0 END AS leaf,
         (n.n_convs - 1) * n.chars AS saved
  FROM nodes n LEFT JOIN kids k ON n.key = k.key
),
totals AS (
  SELECT p.key, sum(v.leaf)::BIGINT AS n_leaves, sum(v.saved)::BIGINT AS saved_tokens
  FROM valued v JOIN paths p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.key
)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves,
       t.saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN totals t ON v.key = t.key LEFT JOIN nodes u ON v.parent = u.key
"""


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
),
sizes AS (SELECT doc_id, len(t)::BIGINT AS n FROM words WHERE len(t) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
),
tf AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(t) AS term FROM words)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus GROUP BY term
),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS impact
  FROM tf JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
),
scores AS (
  SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op13_subspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace.link(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH RECURSIVE raw AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM raw a JOIN raw b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.v FROM reach r JOIN links l ON r.other = l.u
),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degrees AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l USING (vec_id) LEFT JOIN degrees d USING (vec_id)
"""


QUERIES = {
    "op1_removal": op1_removal,
    "op1_passages": op1_passages,
    "op2_toxicity": op2_toxicity,
    "op3_sharding": op3_sharding,
    "op4_line_dedup": op4_line_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_warc": op7_warc,
    "op8_top_k": op8_top_k,
    "op9_mixing": op9_mixing,
    "op10_pieces": op10_pieces,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical": op12_lexical,
    "op13_subspace": op13_subspace,
}

ORACLE = {
    "op4_line_dedup": OP4_SQL,
    "op5_near_dedup": OP5_SQL,
    "op7_warc": OP7_SQL,
    "op8_top_k": OP8_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_lexical": OP12_SQL,
    "op13_subspace": OP13_SQL,
}
