"""URL filter: blocked Bloom filter, then an exact hash join.

Rules are canonical URLs (a host and the start of a path) with a verdict. A
rule fits its host and all subdomains when the URL's path starts with the
rule's path; of the rules that fit, the longest wins (host and path together;
at equal length the longer host).

1. The shapes of the rules, (labels in the host, characters in the path), give
   the few canonical keys that a URL can match: ``www.a.com/x/y`` is looked up
   as ``com`` + ``/``, ``a.com`` + ``/x``, ... only where a rule has that shape.
2. A blocked Bloom filter holds all rule keys. Each key sets a few bits in one
   64-bit block, so a lookup reads one word. Its size is bounded by
   ``max_filter_bytes``; a fuller filter only passes more false positives.
3. Possible hits go to a hash join with the rules on the key itself, which
   removes the false positives, and one aggregate per URL keeps the longest.

Only DataFrame functions are used. The join has no hint: Spark broadcasts the
rules while they are below its size limit, else it shuffles both sides, and a
key that a third of all URLs share (``com/``) is split by AQE's skew join. The
last aggregate is by row, never by key.

Defined results: a null URL, or one without ``://``, has an empty host and
path and gets the default verdict. Repeated rows are judged one by one. Columns
of the input that are named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, col, fresh, without

RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"
BITS_PER_RULE = 16
PROBES = 5


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    after = _after_scheme(url)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    return F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), r"^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules from (host, path, verdict) tuples."""
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _bits(key: Column) -> Column:
    """The bits a key sets in its block: PROBES positions of six hash bits each."""
    h = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        position = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), position))
    return mask


def bloom_words(rules: DataFrame, n_blocks: int) -> Column:
    """The filter as an array of ``n_blocks`` 64-bit words (scalar subquery)."""
    words = rules.groupBy(_block(F.col("rule"), n_blocks).alias("block")).agg(F.bit_or(_bits(F.col("rule"))).alias("word"))
    by_block = F.map_from_entries(F.collect_list(F.struct("block", "word")))
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(n_blocks - 1)), lambda b: F.coalesce(F.try_element_at(by_block, b), F.lit(0).cast("long"))
    )
    return words.agg(dense.alias("words")).scalar()


def judge_urls(
    df: DataFrame, url: str, rules: DataFrame, default: str = "allow", max_filter_bytes: int = 1 << 20, max_shapes: int = 4096
) -> DataFrame:
    """``df`` with host, path, rule (null: none fits) and verdict.

    ``rules`` has the columns of ``RULE_SCHEMA``. A rule listed twice with
    different verdicts blocks. ``max_shapes`` bounds the distinct (labels, path
    length) shapes of the rules, which the plan holds as constants; more raise."""
    rules = (
        rules.where(F.col("rule_host").isNotNull())
        .select(
            ascii_lower(F.col("rule_host")).alias("rule_host"),
            F.coalesce("rule_path", F.lit("")).alias("rule_path"),
            "rule_verdict",
        )
        .groupBy("rule_host", "rule_path")
        .agg(F.max("rule_verdict").alias("rule_verdict"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )
    shapes = (
        rules.select(_labels(F.col("rule_host")).alias("n"), F.length("rule_path").alias("l"))
        .groupBy("n", "l")
        .count()
        .orderBy("n", "l")
        .limit(max_shapes + 1)
        .collect()
    )
    if len(shapes) > max_shapes:
        raise ValueError(f"the rules have more than {max_shapes} shapes")
    n_rules = sum(s["count"] for s in shapes)
    n_blocks = 1
    while n_blocks * 64 < n_rules * BITS_PER_RULE and n_blocks * 16 <= max_filter_bytes:
        n_blocks *= 2

    keep = without(df, "host", "path", "rule", "verdict")
    row, inner = fresh(df, "row"), fresh(df, "input")
    # The id only has to tell the rows of one map task apart until the aggregate.
    rows = df.select(
        F.struct(*keep, url_host(col(url)).alias("host"), url_path(col(url)).alias("path")).alias(inner),
        F.monotonically_increasing_id().alias(row),
    )
    host, path = F.col(inner)["host"], F.col(inner)["path"]
    if shapes:
        shape_array = F.array(*[F.struct(F.lit(s["n"]).alias("n"), F.lit(s["l"]).alias("l")) for s in shapes])
        fitting = F.filter(shape_array, lambda s: (s["n"] <= _labels(host)) & (s["l"] <= F.length(path)))
        keys = F.transform(
            fitting,
            lambda s: F.concat(F.call_function("substring_index", host, F.lit("."), -s["n"]), F.substring(path, F.lit(1), s["l"])),
        )
    else:
        keys = F.array().cast("array<string>")
    candidates = rows.select(row, inner, F.posexplode_outer(keys).alias("place", "key"))
    words = bloom_words(rules, n_blocks)
    possible = F.get(words, _block(F.col("key"), n_blocks)).bitwiseAND(_bits(F.col("key"))) == _bits(F.col("key"))
    # Keys that are certainly no rule's go; each row keeps one line, with or without a key.
    probes = (
        candidates.withColumn("rule", F.when(possible, F.col("key")))
        .where(F.col("rule").isNotNull() | F.coalesce(F.col("place") == 0, F.lit(True)))
        .drop("place", "key")
    )
    hits = probes.join(rules, "rule", "left")
    best = F.max(
        F.when(
            F.col("rule_verdict").isNotNull(),
            F.struct(F.length("rule").alias("length"), F.length("rule_host").alias("host_length"), "rule", "rule_verdict"),
        )
    )
    judged = hits.groupBy(row).agg(F.first(inner).alias(inner), best.alias("best"))
    return judged.select(
        f"{inner}.*",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
