"""A corpus pipeline: five stages, each one operator of ``tessera.llm``.

Every stage takes (spark, docs, sf_dir), works on all documents that the stage
before kept, and returns them with the columns of ``documents``; the last one
returns token ids. ``run`` writes each stage's result as Parquet in the shared
folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, langid, pii, simhash
from tessera.llm.common import col, fresh, stored
from tessera.llm.queries import PII_KEY, RANK_FILE, SPLIT_PATTERN
from tessera.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no learned language: those without a letter, and those
    whose score is below the least one that the training fold has for its language."""
    training = docs.where(~langid.held_out(F.col("doc_id")))
    profiles = spark.sparkContext.broadcast(langid.learn_profiles(training, "doc_id", "text", "lang"))
    least = langid.learn_least_scores(training, "doc_id", "text", "lang", profiles)
    found = fresh(docs, "found")
    predicted = docs.withColumn(found, langid.predict_column(F.col("text"), profiles))
    return predicted.where(langid.accepted(col(found), least)).drop(found)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate component."""
    return simhash.keep_one(docs, "doc_id", "text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which benchmark passages reach the coverage limit; the
    others stay whole."""
    return decontaminate.drop_contaminated(docs, "text", read_table(spark, sf_dir, "benchmark"), "item_id", "text")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets by surrogates, and counts the characters anew."""
    replaced = pii.replace_pii(docs, "text", PII_KEY)
    if "n_chars" in replaced.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return replaced


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes
    decoded from them."""
    digests = bpe.round_trip_column(F.col("text"), bpe.rank_file(spark, RANK_FILE), SPLIT_PATTERN, with_ids=True)
    return docs.select("doc_id", digests.alias("encoded")).select("doc_id", "encoded.*")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", private_data),
    ("byte-level BPE", token_ids),
]

# SQL has neither the fingerprints nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
