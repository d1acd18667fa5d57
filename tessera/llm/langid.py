"""Language identification by rank-order profiles.

A profile holds a language's most frequent n-grams (one to three letters, words
bounded by one mark) by rank. A document's own most frequent n-grams are ranked
the same way; its distance to a profile is the sum of how far each of its
n-grams stands out of place, with the profile's length for one that is missing.
The nearest profile wins; ties go to the language that sorts first. The score is
one minus the distance over the largest possible one.

Training counts come from all labelled rows. Workers count, Spark sums, and only
the profiles, ``PROFILE_GRAMS`` n-grams for each of at most ``MAX_LANGS``
languages, reach the driver and are broadcast. (A caller who wants less can give
``train_docs``, about so many documents of each language by a hash of the id; no
query does.)

A text in no learned language has a nearest profile too. For rejecting it, every
language has a least score, learned from the scores of all its training documents
(``learn_least_scores``); ``accepted`` compares with it.

Defined results: a null text, one without letters, or any text when nothing was
learned is ``und`` with score 0. A text that shares no n-gram with any profile
gets the first language with score 0. Ties between n-grams go to the smaller
code. Null ids count as the empty string in the split.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, stored, utf8

PROFILE_GRAMS = 400
MAX_LANGS = 1_000
UNDETERMINED = "und"
LEAST_QUANTILE = 0.001  # of the training documents' scores
LEAST_SHARE = 0.8  # of that score, for a text to be in the language
SCORE_BINS = 4096

EDGE = 1  # the mark at a word's edges; no letter has this code
BLOCK_CHARS = 1 << 20
BLOCK_GRAMS = 1 << 20  # of several texts, that a worker adds up at once


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: itself for a letter, else the word mark."""
    codes = np.arange(0x110000, dtype=np.int64)
    is_letter = np.fromiter((chr(c).isalpha() for c in codes), bool, len(codes))
    return np.where(is_letter, codes, EDGE)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text (packed, 21 bits a letter) and their
    counts; counted block by block, so memory stays bounded by the block and
    the distinct n-grams."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    mapped = np.concatenate([[EDGE], _letters()[codes], [EDGE]])
    mapped = mapped[(mapped != EDGE) | np.concatenate([[True], mapped[:-1] != EDGE])]
    if len(mapped) < 2:  # only marks
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(mapped), BLOCK_CHARS):
        c = mapped[at : at + BLOCK_CHARS + 2]
        own = min(BLOCK_CHARS, len(mapped) - at)
        two = (c[:-1] << 21) | c[1:]
        three = (two[:-1] << 21) | c[2:]
        one = c[:own]
        some = np.sort(np.concatenate([one[one != EDGE], two[:own], three[:own]]))
        begins = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
        values, n = some[begins], np.diff(begins, append=len(some))
        if len(found):
            values, where = np.unique(np.concatenate([found, values]), return_inverse=True)
            n = np.bincount(where, np.concatenate([counts, n]), len(values)).astype(np.int64)
        found, counts = values, n
    return found, counts


def top(found: np.ndarray, counts: np.ndarray, size: int = PROFILE_GRAMS) -> np.ndarray:
    """The most frequent n-grams by rank; ties go to the smaller code."""
    if len(counts) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        chosen = counts >= least
        found, counts = found[chosen], counts[chosen]
    return found[np.argsort(-counts, kind="stable")][:size]  # ``found`` is sorted


class Profiles:
    """Ranks of the profiles, ready to compare documents with."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_GRAMS):
        self.langs, self.size = sorted(profiles), size
        self.codes = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.ranks = np.full((len(self.langs), len(self.codes)), -1)
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.codes, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language and the score."""
        mine = top(*grams(text), self.size)
        if not len(mine) or not len(self.codes):
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        known = self.codes[at] == mine
        ranks = self.ranks[:, at[known]]
        out_of_place = np.where(ranks < 0, self.size, np.abs(ranks - np.flatnonzero(known)))
        distance = out_of_place.sum(axis=1) + self.size * int((~known).sum())
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(mine))


def held_out(doc_id: Column) -> Column:
    """Rows of the fold that nothing is learned from: crc32(id as text) mod 4 = 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def _training(
    labelled: DataFrame, id_col: str, text_col: str, lang_col: str, train_docs: int | None
) -> tuple[list[str], DataFrame | None]:
    """The languages, and the rows (lang, text) to learn from."""
    rows = labelled.select(
        col(id_col).cast("string").alias("id"), col(text_col).alias("text"), col(lang_col).alias("lang")
    ).where("text is not null and lang is not null")
    known = rows.groupBy("lang").count().limit(MAX_LANGS + 1).collect()
    if len(known) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not known:
        return [], None
    if train_docs is not None:
        # Each language's share of the hash range: all rows, or about train_docs of them.
        share = F.create_map(*[x for r in known for x in (F.lit(r["lang"]), F.lit(min(1.0, train_docs / r["count"])))])
        chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        rows = rows.where(chance < share[F.col("lang")])
    return [r["lang"] for r in known], rows.select("lang", utf8(F.col("text")).alias("text"))


def learn_profiles(
    labelled: DataFrame, id_col: str, text_col: str, lang_col: str, train_docs: int | None = None, size: int = PROFILE_GRAMS
) -> dict[str, list[int]]:
    """Profiles from all rows with a language. Rows without text or language teach nothing."""
    langs, training = _training(labelled, id_col, text_col, lang_col, train_docs)
    if training is None:
        return {}

    def added(lang: str, alone: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        found, where = np.unique(np.concatenate([f for f, _ in alone]), return_inverse=True)
        n = np.bincount(where, np.concatenate([c for _, c in alone]), len(found)).astype(np.int64)
        return pd.DataFrame({"lang": lang, "gram": found, "n": n})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                alone, held = [], 0
                for t in texts:
                    # Each text alone: the counts do not depend on which texts share a batch.
                    alone.append(grams(str(t, "utf-8", "replace")))
                    held += len(alone[-1][0])
                    if held >= BLOCK_GRAMS:
                        yield added(lang, alone)
                        alone, held = [], 0
                if alone:
                    yield added(lang, alone)

    counted = training.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranks = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counted.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= size).orderBy("lang", "rank")
    profiles: dict[str, list[int]] = {lang: [] for lang in langs}
    for r in best.collect():
        profiles[r["lang"]].append(r["gram"])
    return {lang: p for lang, p in profiles.items() if p}


def predict_column(text: Column, profiles: Broadcast, size: int = PROFILE_GRAMS) -> Column:
    """A struct of lang_pred and score, from the whole text alone."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Profiles(profiles.value, size)
        for batch in batches:
            found = [model.predict(str(b, "utf-8", "replace")) for b in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["lang_pred", "score"],
            )

    return predict(utf8(text))


def quantiles(scored: DataFrame, q: float) -> DataFrame:
    """``lang``, ``low``: the exact q-quantile of each language's ``score`` values (0 to
    1), as Spark's ``percentile`` interpolates it. That function holds all values of a
    group at once; here the bins that hold the wanted ranks are found first, and only their
    values are put in order. A score is a distance over at most ``size`` squared, so
    a bin has a few thousand different ones at most, whatever the number of texts."""
    counted = scored.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n")).withColumn("bin", F.floor(F.col("score") * SCORE_BINS))
    bins = counted.groupBy("lang", "bin").agg(F.sum("n").alias("in_bin"))
    upto = F.sum("in_bin").over(Window.partitionBy("lang").orderBy("bin"))
    total = F.sum("in_bin").over(Window.partitionBy("lang"))
    wanted = (
        bins.withColumns({"before": upto - F.col("in_bin"), "upto": upto, "at": F.lit(q) * (total - 1)})
        .where((F.col("before") <= F.ceil("at")) & (F.col("upto") > F.floor("at")))
        .select("lang", "bin", "before", "at")
    )
    ranks = F.col("before") + F.sum("n").over(Window.partitionBy("lang", "bin").orderBy("score"))
    ordered = counted.join(F.broadcast(wanted), ["lang", "bin"]).withColumn("upto", ranks)

    def value(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col("score")))

    ends = ordered.groupBy("lang", "at").agg(value(F.floor("at")).alias("a"), value(F.ceil("at")).alias("b"))
    between = (F.ceil("at") - F.col("at")) * F.col("a") + (F.col("at") - F.floor("at")) * F.col("b")
    return ends.select("lang", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(between).alias("low"))


def learn_least_scores(
    labelled: DataFrame, id_col: str, text_col: str, lang_col: str, profiles: Broadcast, train_docs: int | None = None,
    size: int = PROFILE_GRAMS,
) -> dict[str, float]:
    """For each language the least score at which a text is taken to be in it:
    ``LEAST_SHARE`` of the score that all but ``LEAST_QUANTILE`` of its training
    documents reach. A language of which no training document is recognised has 0."""
    _, training = _training(labelled, id_col, text_col, lang_col, train_docs)
    if training is None:
        return {}
    predicted = training.select("lang", predict_column(F.col("text").cast("string"), profiles, size).alias("p"))
    # Stored: the predictions are made once, for the filter and both passes over the scores.
    scored = stored(predicted.select("lang", "p.*"), "training-scores")
    low = quantiles(scored.where("lang_pred = lang").select("lang", "score"), LEAST_QUANTILE)
    least = {r["lang"]: LEAST_SHARE * r["low"] for r in low.collect()}  # one row a language
    return {lang: least.get(lang, 0.0) for lang in profiles.value}


def accepted(predicted: Column, least: dict[str, float]) -> Column:
    """Whether a prediction's score reaches its language's least score; never for ``und``."""
    if not least:
        return F.lit(False)
    table = F.create_map(*[x for lang, score in sorted(least.items()) for x in (F.lit(lang), F.lit(score))])
    return F.coalesce(predicted["score"] >= F.try_element_at(table, predicted["lang_pred"]), F.lit(False))
