"""Periodic runs against a dense DP over all lags."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import periodic
from tests.llm.conftest import AWKWARD, LONG, RUN


def brute_runs(ids):
    """(start, length, period) of all runs, one diagonal after the other."""
    n, found = len(ids), {}
    for q in range(1, n):
        i = q
        while i < n:
            if ids[i] != ids[i - q]:
                i += 1
                continue
            first = i
            while i < n and ids[i] == ids[i - q]:
                i += 1
            if i - first + q >= max(12, 2 * q):
                span = (first - q, i - 1)
                found[span] = min(q, found.get(span, q))
    return sorted((s, e - s + 1, q) for (s, e), q in found.items())


def runs_of(numbers):
    return periodic.find_runs(np.array(numbers, np.int64), max(numbers, default=0) + 1)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    word = [0]
    while len(word) < n:
        word += [1 - c for c in word]
    return word[:n]


def random_texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.randrange(150), rng.choice([1, 2, 3, 4, 10])
        yield [rng.randrange(letters) for _ in range(n)]
        pieces = []
        while len(pieces) < n:
            pieces += [rng.randrange(letters) for _ in range(rng.randrange(1, 20))] * rng.randrange(1, 6)
        yield pieces
        unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 5))]
        pieces = []
        while len(pieces) < n:  # runs of one root that touch, overlap and turn around
            pieces += unit * rng.randrange(1, 15)
            pieces = pieces[: len(pieces) - rng.randrange(len(unit) + 1)] or [0]
            pieces += rng.choice([[], [9], unit[::-1] * rng.randrange(1, 10)])
        yield pieces


def test_against_the_dense_dp():
    texts = [fibonacci(150), thue_morse(70) * 2, [0, 1] * 20 + [1, 0] * 20, ([0] * 50 + [1]) * 4, list(range(9)) * 3, []]
    found = 0
    for numbers in [*texts, *random_texts(11, 400)]:
        want = brute_runs(numbers)
        assert runs_of(numbers) == want, numbers
        found += len(want)
    assert found > 2000


def test_many_words_of_vocabulary():
    # More words than six packed numbers hold: grams are ranked in two halves.
    numbers = list(range(1500)) + [5, 6, 7, 8, 9, 10, 11] * 3 + list(range(1500))
    assert runs_of(numbers) == brute_runs(numbers)
    assert runs_of(list(range(5000)) * 2) == [(0, 10_000, 5000)]


def test_time_stays_linear():
    texts = ([0] * 400_000, [0, 1, 2] * 100_000, list(range(1000)) * 200, np.random.default_rng(1).integers(0, 2, 100_000).tolist())
    began = time.process_time()
    for numbers in texts:
        assert runs_of(numbers)
    assert time.process_time() - began < 30


def test_awkward(spark, awkward, empty):
    found = awkward.select("doc_id", periodic.runs_column(F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(AWKWARD) + 2
    for i, text in enumerate(AWKWARD):
        words = (text or "").split()
        assert by_id[i]["n_words"] == len(words)
        if text not in (LONG, RUN):
            assert by_id[i]["collapsed"] == " ".join(words) and by_id[i]["runs"] == []
    at = AWKWARD.index(LONG)
    assert [tuple(r) for r in by_id[at]["runs"]] == [(0, 18_000, 3)]
    assert by_id[at]["collapsed"] == "lorem ipsum dolor"
    assert empty.select(periodic.runs_column(F.col("text"))).collect() == []


def test_collapse_keeps_what_one_run_needs():
    words = [str(c).encode() for c in [7, *[1, 2] * 8, 3, *[4] * 12, 5]]
    runs = periodic.find_runs(*periodic.word_numbers(words))
    assert runs == [(1, 16, 2), (18, 12, 1)]
    assert periodic.collapse(words, runs) == [b"7", b"1", b"2", b"3", b"4", b"5"]


def test_white_space_is_ascii(spark):
    text = "a b c\x1cd\x0be\x85f"  # only the vertical tab and the blank part words
    row = spark.createDataFrame([(text,)], "t string").select(periodic.runs_column(F.col("t")).alias("r")).first()
    assert row["r"]["n_words"] == 3


def test_longest_and_repeat(spark):
    runs = "transform(array(array(5L, 20L, 4L), array(2L, 20L, 3L), array(0L, 12L, 1L)), r -> struct(r[0] as start, r[1] as length, r[2] as period))"
    row = spark.range(1).select(
        periodic.longest(F.expr(runs)).alias("best"),
        periodic.longest(F.expr("slice(" + runs + ", 1, 0)")).alias("none"),
        periodic.repeat_from(F.array(*map(F.lit, "abcdefg")), F.lit(2), F.lit(2)).alias("two"),
        periodic.repeat_from(F.array(*map(F.lit, "abc")), F.lit(0), F.lit(3)).alias("same"),
    ).first()
    assert tuple(row["best"]) == (2, 20, 3) and row["none"] is None
    assert "".join(row["two"]) == "abcdcdc" and "".join(row["same"]) == "abc"
