"""MinHash near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np

from tessera.llm import minhash
from tests.llm.conftest import AWKWARD


def brute_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    return {" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute(rows):
    """Sorted (id, set size, component) over all pairs."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for place, (i, _) in enumerate(rows):
        r = find(place)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return sorted(((i, len(s), least[find(p)]) for p, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in minhash.near_duplicates(frame, "doc_id", "text", **options).collect()), key=repr)


def copies(seed, n, words, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        yield " ".join(text)


def test_against_all_pairs(spark):
    texts = [*copies(1, 60, 60, 9), *copies(2, 12, 200, 30), *copies(3, 5, 8, 2), *(f"lone text number {i} of many" for i in range(20))]
    chain = [f"c{i}" for i in range(80)]
    for step in range(12):  # each text links with the next one only
        texts.append(" ".join(chain[step * 4 : step * 4 + 40]))
    texts += [texts[0], texts[0].upper(), "one", "One", "one one", None, "", " \t "]
    rows = list(enumerate(texts)) + [(None, texts[3]), (None, "no id"), (7, texts[7])]
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 40  # there is something to find
    assert found(spark, rows) == want
    assert found(spark, rows, tile_chars=1500) == want  # families of many tiles


def test_forest_of_a_group_equals_all_pairs():
    rng = random.Random(5)
    for seed in range(30):
        texts = [t.encode() for t in copies(seed, 25, 30, rng.choice([3, 8, 14]))]
        want = brute([(i, t.decode()) for i, t in enumerate(texts)])
        roots = minhash.similar_forest(texts)
        assert sorted(((i, len(brute_set(t.decode())), r) for i, (t, r) in enumerate(zip(texts, roots))), key=repr) == want
        across = minhash.similar_forest(texts, left=10)
        for a in range(25):
            for b in range(a):
                x, y = brute_set(texts[a].decode()), brute_set(texts[b].decode())
                if (a < 10) != (b < 10) and 100 * len(x & y) >= 80 * len(x | y):
                    assert across[a] == across[b]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100, 5000):
        values = rng.integers(0, 2**63, n).astype(np.uint64)
        coordinates = minhash.sketch(values, 560)
        assert (coordinates != np.iinfo(np.uint64).max).all()
        assert (coordinates == minhash.sketch(values[::-1].copy(), 560)).all()
    for n, share in ((10, 8), (1000, 800), (300, 150)):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = a.copy()
        b[share:] = rng.integers(0, 2**63, n - share).astype(np.uint64)
        agree = np.mean([np.mean(minhash.sketch(a + np.uint64(i), 560) == minhash.sketch(b + np.uint64(i), 560)) for i in range(20)])
        assert abs(agree - share / (2 * n - share)) < 0.06


def test_other_shingles(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j k"), (3, "a b"), (4, "A  B"), (5, "z")]
    got = found(spark, rows, shingle=3)
    assert got == [(1, 8, 1), (2, 9, 1), (3, 1, 3), (4, 1, 3), (5, 1, 5)]


def test_awkward(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = sorted((tuple(r) for r in minhash.near_duplicates(awkward, "doc_id", "text").collect()), key=repr)
    assert len(rows) == len(AWKWARD) + 2 and got == brute(rows)
    assert minhash.near_duplicates(empty, "doc_id", "text").collect() == []
