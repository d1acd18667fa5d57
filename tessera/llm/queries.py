"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, html_extract, langid, minhash, periodic, pii, simhash, token_count, topk, url_filter, vector_codes, warc
from tessera.llm.common import broadcast_file
from tessera.sources.tables import read_table

# Fixed values of the queries' contracts.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
TOP_K = 10
QUERY_STEP = 100
TOKEN_LIMIT = 1024
# Vocabulary files are parameters; nothing of them is kept here.
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPLIT_PATTERN = public_tokenizers.PATTERN
TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
# Stands for the secret of a real run, which would come from a key store.
PII_KEY = "example key"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and longest fitting rule of every page's URL."""
    pages = read_table(spark, sf_dir, "pages", columns=["page_id", "url"])
    judged = url_filter.judge_urls(pages, "url", url_filter.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows by integer inner product for every hundredth vector."""
    vectors = read_table(spark, sf_dir, "embeddings", columns=["vec_id", "embedding"])
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), "vec_id", "embedding", TOP_K)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes decoded from them, as digests."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text"])
    digests = bpe.round_trip_column(F.col("text"), bpe.rank_file(spark, RANK_FILE), SPLIT_PATTERN)
    return docs.select("doc_id", digests.alias("d")).select("doc_id", "d.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items found."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text"])
    items = read_table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, "text", items, "item_id", "text", "match")
    return found.select(
        "doc_id", "match.n_words", "match.n_hit", F.size("match.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("match.items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("match")).alias("contaminated"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every text; profiles from the other folds."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text", "lang"])
    profiles = langid.learn_profiles(docs.where(~langid.held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    predicted = langid.predict_column(F.col("text"), spark.sparkContext.broadcast(profiles))
    return docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), predicted.alias("p")).select("doc_id", "held_out", "p.*")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive, and read back from it."""
    pages = read_table(spark, sf_dir, "pages", columns=["page_id", "url", "html"])
    archive = warc.write_archive(pages, "page_id", "url", "html")
    return warc.read_records(spark, archive, with_bytes=False).select(
        F.col("id").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("label").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with surrogates for personal data, and how many."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text"])
    return pii.replace_pii(docs, "text", PII_KEY, "n_entities")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages", columns=["page_id", "url", "html"])
    text = html_extract.main_text_column(F.col("html"))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text"])
    counts = token_count.count_column(F.col("text"), broadcast_file(spark, TOKENIZER_FILE), TOKEN_LIMIT)
    return docs.select("doc_id", counts.alias("c")).select("doc_id", "c.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text"])
    found = simhash.near_duplicates(docs, "doc_id", "text")
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every text, after a tenth of the texts were made to
    repeat a passage (chosen by the checksum of the id)."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text"])
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    choice = F.floor(checksum / 10).cast("int")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    first = choice % F.size(words)
    period = 1 + F.floor((F.size(words) - first) / (3 + choice % 8)).cast("int")
    repeated = F.array_join(periodic.repeat_from(words, first, period), " ")
    text = F.when((checksum % 10 == 0) & (F.size(words) > 0), repeated).otherwise(F.col("text"))
    found = docs.select("doc_id", periodic.runs_column(text).alias("r")).select("doc_id", "r.runs", "r.collapsed")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = found.withColumn("best", periodic.longest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, the errors of its label, and the codebooks."""
    vectors = read_table(spark, sf_dir, "embeddings", columns=["vec_id", "embedding", "label"])
    rows, codebooks = vector_codes.compress(vectors, "vec_id", "embedding")
    numbers = ",".join(str(x) for entries in codebooks for entry in entries for x in entry)
    code = F.array_join(F.transform("code", lambda entry: F.lower(F.lpad(F.hex(entry), 2, "0"))), "")
    labels = rows.groupBy(F.col("label").alias("its_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("its_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document, and whether it is kept."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "text"])
    found = minhash.near_duplicates(docs, "doc_id", "text")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_exact_topk, op3_byte_bpe, op4_decontamination, op5_language_id, op6_warc, op7_pii,
        op8_html_extraction, op9_token_counts, op10_simhash, op11_periodic_runs, op12_vector_codes,
        op13_minhash,
    )
}
