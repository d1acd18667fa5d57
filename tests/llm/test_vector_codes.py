"""Product codebooks against a plain version over all vectors."""

import math
import random

import numpy as np
import pytest

from tessera.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, row int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """[(id, code, error)] and codebooks; rows are (id, vector)."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], [[] for _ in range(parts)]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            homes = [assign(c[p], book)[1] for c in cut]
            for e in range(len(book)):
                members = [c[p] for c, h in zip(cut, homes) if h == e]
                if members:
                    book[e] = [sum(x) // len(members) for x in zip(*members)]
    found = []
    for (i, _), c in zip(kept, cut):
        best = [assign(c[p], books[p]) for p in range(parts)]
        found.append((i, [e for _, e in best], min(2**63 - 1, sum(d for d, _ in best))))
    return found, books


def vectors(seed, n, width=16, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(width)]) for i in range(n)]


def compressed(spark, rows, **options):
    full = [(i, v, (i or 0) % 3, "clash", 7) for i, v in rows]
    found = vector_codes.compress(spark.createDataFrame(full, SCHEMA).repartition(3), "vec_id", "embedding", **options)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    return sorted(((r["vec_id"], list(r["code"]), r["error"]) for r in found.rows.collect()), key=key), found.codebooks


def check(spark, rows, **options):
    got, books = compressed(spark, rows, **options)
    want, want_books = brute(rows)
    assert books == want_books
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))


def test_against_the_plain_version(spark):
    rows = vectors(1, 150)
    rows += [(i, [0.5] * 16) for i in range(1000, 1070)]  # one vector with a third of all rows
    rows += [(3, rows[3][1]), (3, rows[4][1])]  # repeated ids
    rows += [(None, [0.1] * 16), (None, rows[7][1])]
    rows += [(2000, None), (2001, [None] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] + [0.0] * 15)]
    check(spark, rows)
    check(spark, rows, cell_rows=20)  # many salts


def test_few_vectors_and_ties(spark):
    check(spark, vectors(2, 5))
    check(spark, [(1, [0.0] * 8)])
    check(spark, [(i, [float(i % 2)] * 8) for i in range(40)])  # equal entries: the lower index


def test_large_components_stay_exact(spark):
    check(spark, vectors(3, 40, spread=1e5))
    got, _ = compressed(spark, [(1, [1e300] * 8), (2, [-1e300] * 8)], entries=1)
    assert [r[2] for r in got] == [2**63 - 1] * 2


def test_empty_and_ragged(spark):
    assert compressed(spark, []) == ([], [[] for _ in range(8)])
    assert compressed(spark, [(1, None)])[0] == []
    for rows in ([(1, [0.0] * 8), (2, [0.0] * 16)], [(1, [0.0] * 7)]):
        with pytest.raises(ValueError, match="equal parts"):
            compressed(spark, rows)


def test_columns_stay(spark):
    frame = spark.createDataFrame([(1, [0.5] * 8, None, "x", 9)], SCHEMA)
    rows = vector_codes.compress(frame, "vec_id", "embedding").rows
    assert rows.columns == ["vec_id", "embedding", "label", "row", "code", "error"]
    assert rows.first()["row"] == 9 and list(rows.first()["code"]) == [0] * 8


def test_only_changed_members_are_shuffled(spark):
    layout = vector_codes.Layout(1, 2, 2)
    rows, parts = np.arange(100), np.arange(100).reshape(-1, 1)
    books = [[[0], [1000]]]
    blocks = list(vector_codes._dealt(rows, parts, 0, vector_codes.nearest(parts, books[0])[0], layout))
    members = spark.sparkContext.parallelize(blocks, 2).partitionBy(4, vector_codes._owner)
    moved = vector_codes._migrated(members, [[[0], [98]]], layout, 4)
    assert moved.getNumPartitions() == 4 and "PartitionerAwareUnionRDD" in moved.toDebugString().decode()
    cells = {cell: sorted(r.tolist()) for cell, (r, _) in moved.collect()}
    assert sorted(cells[0] + cells[1]) == list(range(50)) and sorted(cells[2] + cells[3]) == list(range(50, 100))
    assert all(r % 2 == cell % 2 for cell, rows in cells.items() for r in rows)
