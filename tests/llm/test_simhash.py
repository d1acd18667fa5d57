"""SimHash near-duplicates against brute force over all pairs."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.queries import QUERIES
from tessera.sources.tables import read_table

DIR = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints, bits=3):
    """(root of each place) over all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(prints))]


def test_query_against_all_pairs(spark):
    docs = read_table(spark, DIR, "documents").orderBy("doc_id").collect()
    prints = [brute_fingerprint(r["text"]) for r in docs]
    roots = brute_components(prints)
    want = {r["doc_id"]: (f"{p:016x}", docs[root]["doc_id"]) for r, p, root in zip(docs, prints, roots, strict=True)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op10_simhash"](spark, DIR).collect()}
    assert got == want


def test_components_of_chains_and_dense_groups(spark):
    # A chain that links only step by step, a dense group, and lone fingerprints; small tiles split every class.
    rng = np.random.default_rng(3)
    start = int(rng.integers(1 << 62))
    chain = [start]
    for i in range(20):
        chain.append(chain[-1] ^ (0b111 << (3 * i)))
    center = int(rng.integers(1 << 62))
    dense = [center ^ (1 << i) for i in range(60)]
    lone = [int(x) for x in rng.integers(1 << 62, size=100)]
    prints = sorted(set(chain + dense + lone + [0, 1 << 63]))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    order = sorted(range(len(signed)), key=signed.__getitem__)  # roots are the smallest signed
    prints, signed = [prints[i] for i in order], [signed[i] for i in order]
    roots = brute_components(prints)
    want = {signed[i]: signed[r] for i, r in enumerate(roots) if roots.count(r) > 1}
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = simhash.links(frame, tile_rows=4)
    assert links.count() <= 20 * len(prints)  # forests, not all pairs
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == want


def test_awkward(spark, awkward, empty):
    found = simhash.near_duplicates(awkward, "doc_id", "text").collect()
    assert len(found) == awkward.count()
    by_id = {r["doc_id"]: r for r in found}
    # Texts without words share fingerprint zero and link like any other.
    assert [by_id[i]["fp"] for i in (0, 1, 2)] == [0, 0, 0]
    assert {by_id[i]["component_id"] for i in (0, 1, 2)} == {0}
    assert by_id[12]["component_id"] == by_id[11]["component_id"] == 11
    kept = simhash.keep_one(awkward, "doc_id", "text")
    assert kept.columns == awkward.columns
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(r["fp"]) for r in found})
    assert simhash.near_duplicates(empty, "doc_id", "text").collect() == []
    assert simhash.keep_one(empty, "doc_id", "text").collect() == []


def test_all_ids_null(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "d")], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.near_duplicates(docs, "doc_id", "text").collect()} == {None}
    assert sorted(r["text"] for r in simhash.keep_one(docs, "doc_id", "text").collect()) == ["a b c", "d"]


def test_hex_of_the_sign_bit(spark):
    row = spark.createDataFrame([(-1,), (5,), (0,)], "fp long").select(simhash.fingerprint_hex(F.col("fp")).alias("h"))
    assert [r["h"] for r in row.collect()] == ["f" * 16, "0" * 15 + "5", "0" * 16]
