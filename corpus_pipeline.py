"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every result as Parquet to the shared folder and reads it again as the next
stage's documents. All but the last return the columns of ``documents``.

Cases: every stage keeps the rule of its operator for nulls, empty texts, ties
and repeated rows; an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from duecast.llm import line_dedup, mixing, near_dedup, pieces, toxicity
from duecast.llm.common import table
from duecast.llm.membership import membership
from duecast.sources.storage import stored


def carried(docs: DataFrame) -> DataFrame:
    """Documents as one column, beside those that operators read: no name of theirs is lost."""
    return docs.select(F.struct("*").alias("document"), "doc_id", "text", "source")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(carried(docs), model, with_passages=False)
    return scored.where("score < 0.5").select("document.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; ``n_chars`` follows the text."""
    kept = line_dedup.drop_lines(carried(docs))
    own = lambda name: F.col("document").getField(name)
    changed = {
        "text": F.col("text"),
        "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(own("n_chars")),
    }
    return kept.select(*[changed.get(c, own(c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the least identifier stays.

    Rows that repeat an identifier are told apart by their words; one of those equal in both stays.
    Here words are shingled by five, as in all stages on shingles.
    """
    found = near_dedup.linked(docs, size=5).where("same IS NOT NULL")
    found = found.groupBy(F.col("doc_id").alias("_id"), F.col("same").alias("_same")).agg(
        F.min("chosen").alias("chosen"), F.count("*").alias("n")
    )
    found = stored(found.where("NOT chosen OR n > 1"), "near_copies")
    maybe = membership(found.select("_id").distinct())(F.col("doc_id"))
    checked = docs.where(maybe).select(
        F.struct("*").alias("document"),
        F.col("doc_id").cast("long").alias("_id"),
        near_dedup.word_digest(F.col("text")).alias("_same"),
    )
    others = checked.join(found, ["_id", "_same"], "left_anti").select("document.*")
    repeated = checked.join(found.where("chosen"), ["_id", "_same"])
    one = repeated.groupBy("_id", "_same").agg(F.min("document").alias("document")).select("document.*")
    return docs.where(~maybe).unionByName(others).unionByName(one)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixing.copied(mixing.mix(carried(docs)), ["document"]).select("document.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, after a check that they decode to its text."""
    model = pieces.model_bytes()
    coded = docs.select("doc_id", "source", "lang", pieces.checked(F.col("text"), model).alias("coded"))
    return coded.select("doc_id", "source", "lang", F.size("coded.ids").alias("n_tokens"), "coded.ids", "coded.round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
