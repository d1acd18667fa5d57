"""Word statistics over text columns.

Tokens come from ``explode(split(...))`` on the executors; counts are hash
aggregates with a partial step, so very frequent words ("the") are combined
on the map side before the shuffle. Several languages are handled in one
scan: each row takes the cleaning rule of its language through ``CASE``.
Documents are processed whole -- no prefix of a text is ever taken.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import (
    LANGUAGE_RULES,
    WordRules,
    is_word,
    line_count,
    non_space_length,
    strip_disallowed,
    token_count,
    whitespace_split,
)


def words_by_lang(
    docs: DataFrame,
    rules: Mapping[str, WordRules],
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per valid word occurrence: ``lang``, ``word``."""
    lang = F.col(lang_col)
    cleaned: Column | None = None
    valid: Column | None = None
    for code, r in rules.items():
        expr = strip_disallowed(F.col(text_col), r)
        cleaned = F.when(lang == code, expr) if cleaned is None else cleaned.when(lang == code, expr)
    tokens = docs.filter(lang.isin(*rules)).select(
        lang.alias("lang"), F.explode(whitespace_split(cleaned)).alias("word")
    )
    for code, r in rules.items():
        cond = (F.col("lang") == code) & is_word(F.col("word"), r)
        valid = cond if valid is None else valid | cond
    return tokens.filter(valid)


def word_counts_by_lang(
    docs: DataFrame,
    languages: Mapping[str, WordRules] | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang``, ``word``, ``n``: occurrences of each word per language.
    Compute once and answer the word questions from it."""
    rules = languages if languages is not None else LANGUAGE_RULES
    return words_by_lang(docs, rules, text_col, lang_col).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, lang: str, k: int = 10, length: int | None = None) -> DataFrame:
    """The ``k`` most common words of one language (optionally of one
    length); ties go to the alphabetically first word."""
    rows = counts.filter(F.col("lang") == lang)
    if length is not None:
        rows = rows.filter(F.length("word") == length)
    return rows.orderBy(F.desc("n"), F.asc("word")).limit(k).select("word", "n")


def longest_frequent_word(counts: DataFrame, min_count: int = 150) -> DataFrame:
    """The longest word seen at least ``min_count`` times over all languages
    together; ties by count, then alphabetically."""
    return (
        counts.groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= min_count)
        .orderBy(F.desc(F.length("word")), F.desc("n"), F.asc("word"))
        .limit(1)
    )


def avg_word_length(counts: DataFrame) -> DataFrame:
    """Mean word length per language, weighted by occurrences, 2 digits."""
    return counts.groupBy("lang").agg(
        F.round(F.sum(F.length("word") * F.col("n")) / F.sum("n"), 2).alias("avg_len")
    )


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Lines, white-space separated words and non-white-space characters,
    as one row. Works on line rows (one line each) and on whole documents
    (lines split at newlines) alike, without exploding anything."""
    t = F.col(text_col)
    return df.agg(
        F.sum(line_count(t)).cast("bigint").alias("lines"),
        F.sum(token_count(t)).cast("bigint").alias("words"),
        F.sum(non_space_length(t)).cast("bigint").alias("chars"),
    )


def raw_tokens(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Every white-space separated token as is (``word``)."""
    return df.select(F.explode(whitespace_split(F.col(text_col))).alias("word")).filter(F.col("word") != "")


def raw_word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word``, ``n`` over raw tokens (the map / group / reduce word count)."""
    return raw_tokens(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def words_of_length(df: DataFrame, length: int, text_col: str = "text") -> DataFrame:
    """Number of raw tokens of exactly ``length`` characters (one row, ``n``)."""
    fitting = F.filter(whitespace_split(F.col(text_col)), lambda w: F.length(w) == length)
    return df.agg(F.coalesce(F.sum(F.size(fitting)), F.lit(0)).cast("bigint").alias("n"))


def most_common_word_of_length(df: DataFrame, length: int, text_col: str = "text") -> DataFrame:
    """The most common raw token of ``length`` characters and its count;
    ties go to the alphabetically first token."""
    fitting = F.filter(whitespace_split(F.col(text_col)), lambda w: F.length(w) == length)
    return (
        df.select(F.explode(fitting).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("word"))
        .limit(1)
    )
