"""Word rules (D5-D7, D13, D16) on hand-made text."""

from tessera.functions.text import ENGLISH, FINNISH
from tessera.operators import words


def _counts(spark, lang, text):
    docs = spark.createDataFrame([(lang, text)], "lang string, text string")
    rules = {"en": ENGLISH, "fi": FINNISH}
    return {r["word"]: r["n"] for r in words.word_counts_by_lang(docs, rules).collect()}


SAMPLE = "Well-known a--b -x- I b Wikipedia sää don't"


def test_english_rules(spark):
    assert set(_counts(spark, "en", SAMPLE)) == {"well-known", "i", "wikipedia", "dont"}


def test_finnish_rules(spark):
    assert set(_counts(spark, "fi", SAMPLE)) == {"well-known", "sää", "dont"}


def test_case_is_ignored_and_counts_add_up(spark):
    got = _counts(spark, "en", "English ENGLISH english, a A")
    assert got == {"english": 3, "a": 2}


def test_non_space_characters_include_tabs(spark):
    df = spark.createDataFrame([("a\tb c",)], "text string")
    row = words.text_stats(df).first()
    assert (row["lines"], row["words"], row["chars"]) == (1, 3, 3)


def test_text_stats_on_documents_and_lines_agree(spark):
    doc = "first line here\nsecond  line\n\nlast"
    docs = spark.createDataFrame([(doc,)], "text string")
    lines = spark.createDataFrame([(x,) for x in doc.split("\n")], "text string")
    assert tuple(words.text_stats(docs).first()) == tuple(words.text_stats(lines).first()) == (4, 6, 27)


def test_top_words_ties_alphabetical(spark):
    counts = spark.createDataFrame(
        [("en", "bb", 5), ("en", "aa", 5), ("en", "cc", 7), ("fi", "zz", 99)], "lang string, word string, n bigint"
    )
    assert [r["word"] for r in words.top_words(counts, "en", 2).collect()] == ["cc", "aa"]


def test_longest_frequent_word_sums_languages(spark):
    counts = spark.createDataFrame(
        [("en", "longword", 100), ("fi", "longword", 60), ("en", "short", 500), ("en", "longestword", 149)],
        "lang string, word string, n bigint",
    )
    row = words.longest_frequent_word(counts, 150).first()
    assert (row["word"], row["n"]) == ("longword", 160)


def test_raw_word_length_questions(spark):
    docs = spark.createDataFrame([("action action motion x actions\tmotion action",)], "text string")
    assert words.words_of_length(docs, 6).first()["n"] == 5
    row = words.most_common_word_of_length(docs, 6).first()
    assert (row["word"], row["n"]) == ("action", 3)


def test_a_token_of_fifty_thousand_hyphens_is_a_word(spark):
    token = "-".join("a" * 50_001)
    docs = spark.createDataFrame([(f"{token} x--y -z {token}-", "en"), ("à la mode", "fr"), ("y así", "es")], "text string, lang string")
    got = {(r["lang"], r["word"]): r["n"] for r in words.word_counts_by_lang(docs).collect()}
    assert got == {("en", token): 1, ("fr", "à"): 1, ("fr", "la"): 1, ("fr", "mode"): 1, ("es", "y"): 1, ("es", "así"): 1}
