"""BPE, token counts and language ID against the libraries and brute force."""

import base64
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe, langid, token_count
from tessera.llm.common import broadcast_file
from tessera.llm.queries import QUERIES, RANK_FILE, SPLIT_PATTERN, TOKENIZER_FILE
from tessera.sources.tables import read_table

from .conftest import LONG, RUN, sha

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts_of(spark):
    return {r["doc_id"]: r["text"] or "" for r in read_table(spark, DIR, "documents").collect()}


def test_bpe_query_against_the_library(spark, encoder):
    texts = texts_of(spark)
    for r in QUERIES["op3_byte_bpe"](spark, DIR).collect():
        ids = encoder.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]].encode())


@settings(max_examples=200, deadline=None)
@given(st.text("ab9 \n\t'sré!?  \x85", max_size=60))
def test_pieces_cut_at_safe_boundaries_change_no_id(encoder, text):
    splitter = regex.compile(SPLIT_PATTERN)
    assert "".join(bpe.safe_pieces(text, 3)) == text
    assert bpe.encode(encoder, splitter, text, 3).tolist() == encoder.encode_ordinary(text)


def test_bpe_awkward_texts_and_round_trip(spark, awkward, empty, encoder):
    ranks = bpe.rank_file(spark, RANK_FILE)
    ids = bpe.encode_column(F.col("text"), ranks, SPLIT_PATTERN)
    rows = awkward.select("text", ids.alias("ids")).select("*", bpe.decode_column(F.col("ids"), ranks, SPLIT_PATTERN).alias("raw")).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert bytes(r["raw"]).decode() == (r["text"] or "")
        if r["text"] and len(r["text"]) < 1000:
            assert r["ids"] == encoder.encode_ordinary(r["text"])
    assert empty.select(ids.alias("ids")).collect() == []


def test_bpe_one_run_of_a_million_blanks(encoder):
    # The library's own regex engine exhausts its stack on this text.
    text = "x" + " " * 1_000_000 + "y"
    ids = bpe.encode(encoder, regex.compile(SPLIT_PATTERN), text)
    assert encoder.decode(ids.tolist()) == text


def test_rank_file_size_is_checked(spark):
    with pytest.raises(ValueError):
        broadcast_file(spark, RANK_FILE, max_bytes=1000)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER_FILE)


def plain_count(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_count_query_against_the_library(spark, tokenizer):
    texts = texts_of(spark)
    for r in QUERIES["op9_token_counts"](spark, DIR).collect():
        n = plain_count(tokenizer, texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)


def test_spliced_chunks_and_units_count_like_the_whole(tokenizer):
    data = open(TOKENIZER_FILE, "rb").read()
    small = token_count.TokenCounter(data, huge=60, chunk=30, overlap=4, memo=5)
    rng = random.Random(7)
    pieces = ["word", " the", "  ", "\n", " \n", "é", "'s", " 12", "<|endoftext|>", " x" * 30, "Q" * 50, ".", " ", " naïve,", "\t"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(300)]
    assert small.counts(texts) == [plain_count(tokenizer, t) for t in texts]


def test_huge_documents_are_spliced(tokenizer):
    counter = token_count.TokenCounter(open(TOKENIZER_FILE, "rb").read())
    rng = random.Random(1)
    text = "".join(rng.choices([" alpha", " beta,", " gamma\n", "s", " 77", " <|endoftext|>"], k=60_000))
    assert len(text) > 2 * token_count.HUGE_CHARS
    assert counter.counts([text, RUN, LONG]) == [plain_count(tokenizer, t) for t in (text, RUN, LONG)]


def test_token_counts_awkward(spark, awkward, empty, tokenizer):
    c = token_count.count_column(F.col("text"), broadcast_file(spark, TOKENIZER_FILE), 2)
    rows = awkward.select("text", c.alias("c")).select("text", "c.*").collect()
    for r in rows:
        n = plain_count(tokenizer, r["text"] or "")
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 2)
    assert empty.select(c).collect() == []


def brute_grams(text):
    """N-grams by plain counting: letters, words bounded by one mark."""
    marked = "\1" + "".join(c if c.isalpha() else "\1" for c in text.lower()) + "\1"
    marked = re.sub("\1+", "\1", marked)
    if marked == "\1":
        return Counter()
    found = Counter(c for c in marked if c != "\1")
    for n in (2, 3):
        found.update(marked[i : i + n] for i in range(len(marked) - n + 1))
    return found


def pack(gram):
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_grams_against_plain_counting(text):
    found, counts = langid.grams(text)
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == {pack(g): n for g, n in brute_grams(text).items()}


def test_grams_over_blocks(monkeypatch):
    whole = langid.grams(LONG[:500])
    monkeypatch.setattr(langid, "BLOCK_CHARS", 7)
    assert all((a == b).all() for a, b in zip(whole, langid.grams(LONG[:500]), strict=True))


def brute_predict(profiles, text, size):
    mine = sorted(((-n, pack(g)) for g, n in brute_grams(text).items()))[:size]
    if not mine or not profiles:
        return "und"
    distance = {}
    for lang, profile in profiles.items():
        rank = {g: i for i, g in enumerate(profile)}
        distance[lang] = sum(abs(rank[g] - i) if g in rank else size for i, (_, g) in enumerate(mine))
    return min(sorted(distance), key=distance.get)


def test_language_predictions(spark):
    docs = read_table(spark, DIR, "documents")
    profiles = langid.learn_profiles(docs.where(~langid.held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    # The profiles are the brute-force counts of the learned rows: all of them, below the bound.
    by_lang = {}
    known = {r["doc_id"]: r for r in docs.collect()}
    got = {r["doc_id"]: r for r in QUERIES["op5_language_id"](spark, DIR).collect()}
    for i, r in known.items():
        if r["text"] is not None and r["lang"] is not None and not got[i]["held_out"]:
            by_lang.setdefault(r["lang"], []).append(r["text"])
    assert profiles.keys() == by_lang.keys()
    for lang, texts in by_lang.items():
        counted = Counter()
        for t in texts:
            counted.update(brute_grams(t))
        best = sorted((-n, pack(g)) for g, n in counted.items())[: langid.PROFILE_GRAMS]
        assert profiles[lang] == [g for _, g in best]
    assert {i: r["lang_pred"] for i, r in got.items()} == {
        i: brute_predict(profiles, r["text"] or "", langid.PROFILE_GRAMS) for i, r in known.items()
    }
    held = [i for i in got if got[i]["held_out"] and known[i]["lang"]]
    assert sum(got[i]["lang_pred"] == known[i]["lang"] for i in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_profiles_do_not_depend_on_the_layout(spark):
    docs = read_table(spark, DIR, "documents")
    learned = [langid.learn_profiles(docs.repartition(n, F.rand(n)), "doc_id", "text", "lang") for n in (1, 3, 16)]
    assert learned[0] == learned[1] == learned[2] and len(learned[0]) == 4


OTHERS = [
    "De regering heeft gisteren besloten dat de nieuwe wet niet wordt ingevoerd, omdat er te veel bezwaren waren van burgers en bedrijven.",
    "Il governo ha deciso ieri che la nuova legge non sarà introdotta perché ci sono state troppe obiezioni da parte dei cittadini.",
    "Regeringen beslutade igår att den nya lagen inte ska införas eftersom det fanns för många invändningar från medborgare och företag.",
    "qzx kkw vvp", "zkrv bdgq xxpl wqtt nmfd hjkc vbzx plkj qwrt sdfg zxcv bnmk", "你好世界", "12 34", "", None,
]


def test_other_languages_and_noise_are_rejected(spark):
    """Least scores are learned from the training fold; the held-out fold stays, whole."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    training = docs.where(~langid.held_out(F.col("doc_id")))
    profiles = spark.sparkContext.broadcast(langid.learn_profiles(training, "doc_id", "text", "lang"))
    least = langid.learn_least_scores(training, "doc_id", "text", "lang", profiles)
    assert set(least) == set(profiles.value) and all(0.2 < x < 0.6 for x in least.values())
    predicted = langid.predict_column(F.col("text"), profiles)
    held = docs.where(langid.held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    lost = held.select(predicted.alias("p")).where(~langid.accepted(F.col("p"), least)).count()
    assert lost <= 0.002 * held.count()
    others = spark.createDataFrame([(t,) for t in OTHERS], "text string").select("text", predicted.alias("p"))
    assert others.where(langid.accepted(F.col("p"), least)).collect() == []
    assert others.where(langid.accepted(F.col("p"), {})).collect() == []


def test_language_models_come_from_every_training_row(spark):
    """6,190 rows of one language: letter i is in 300 + i of them, so a row left out changes the ranks."""
    letters = "abcdefghijklmnopqrst"
    texts = [x for i, x in enumerate(letters) for _ in range(300 + i)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs, "doc_id", "text", "lang")
    assert [chr(g) for g in profiles["en"] if 1 < g < 1 << 21] == list(reversed(letters))
    # Scores differ by row: a word alone is the worse, the later it stands in the profile.
    shared = spark.sparkContext.broadcast(profiles)
    low = docs.select(langid.predict_column(F.col("text"), shared)["score"].alias("s")).agg(F.percentile("s", F.lit(langid.LEAST_QUANTILE))).first()[0]
    rare = docs.unionByName(spark.createDataFrame([(10_000 + i, "zz zz", "en") for i in range(8)], docs.schema))
    assert langid.learn_least_scores(docs, "doc_id", "text", "lang", shared)["en"] == langid.LEAST_SHARE * low > 0
    # Eight bad rows of 6,198 are more than one in a thousand, whichever rows they are.
    assert langid.learn_least_scores(rare, "doc_id", "text", "lang", shared)["en"] == 0


def test_quantiles_are_those_of_percentile(spark):
    rng = random.Random(5)
    rows = [("a", rng.randrange(400) / 400) for _ in range(3000)] + [("b", rng.random()) for _ in range(2001)]
    rows += [("c", 0.25)] * 50 + [("d", 1.0), ("e", 0.0), ("e", 1.0)] + [("f", 0.5 + i * 1e-9) for i in range(1500)]
    scored = spark.createDataFrame(rows, "lang string, score double").repartition(5)
    for q in (0.0, 0.001, 0.3, 0.5, 1.0):
        expected = {r[0]: r[1] for r in scored.groupBy("lang").agg(F.percentile("score", F.lit(q))).collect()}
        assert {r["lang"]: r["low"] for r in langid.quantiles(scored, q).collect()} == pytest.approx(expected, abs=1e-15)


def test_language_awkward(spark, awkward, empty):
    assert langid.learn_profiles(empty, "doc_id", "text", "lang") == {}
    assert langid.learn_least_scores(empty, "doc_id", "text", "lang", spark.sparkContext.broadcast({})) == {}
    nothing = langid.predict_column(F.col("text"), spark.sparkContext.broadcast({}))
    assert {r["p"]["lang_pred"] for r in awkward.select(nothing.alias("p")).collect()} == {"und"}
    profiles = langid.learn_profiles(awkward, "doc_id", "text", "lang")
    some = langid.predict_column(F.col("text"), spark.sparkContext.broadcast(profiles))
    got = {r["text"]: r["p"] for r in awkward.select("text", some.alias("p")).collect()}
    for t, p in got.items():
        assert (p["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))
