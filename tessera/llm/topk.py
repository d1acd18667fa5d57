"""Exact top-k by inner product: no-random-access aggregation of sorted lists.

Candidates are dealt into tiles of about ``TILE_ROWS`` rows and queries into blocks of
about ``QUERY_ROWS``; Spark brings every block together with every tile (a stated
query set against all rows, in blocks), and a task handles one pair at a time.

In a tile each component is a list sorted by its value. The lists are read from
both ends, one stretch a round and never at random. After a round a value that
was read is known, and one that was not lies between the two places that the
reading has reached; so every candidate has a lower and an upper bound for every
query. The k-th largest lower bound is the query's threshold, and a candidate
whose upper bound is below it cannot qualify. When few are left, or all is read,
the exact scores of those left are resolved. Each pair returns k rows a query
at most, and a rank over these gives the result.

Values are integers and sums are exact: in floats while they stay below 2^53,
else in Python integers.

Defined results: rows whose vector is null or holds null or non-finite components
take no part; vectors are compared with vectors of the same length only; a query
is not its own candidate (rows with its id are its own); a repeated candidate row
counts each time, a repeated query row once (queries that share an id but not the
vector are ranked together); a null id takes no part; ties go to
the smaller id; scores beyond 64 bits are held at the largest or smallest long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col

TILE_ROWS = 4096
QUERY_ROWS = 512
DEPTHS = (1 / 8, 1 / 4, 3 / 8, 7 / 16)  # shares of a list read from each end after each round
RESULT = "query_id long, vec_id long, score long"


def scaled(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if any is null or not finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")))


def nra(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, candidate id, score): each query's k best of one tile."""
    n = len(rows)
    own = query_ids[:, None] == ids[None, :]
    ranks = np.argsort(np.argsort(rows, axis=0, kind="stable"), axis=0, kind="stable")
    by_value = np.sort(rows, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    both = np.concatenate([up, down], axis=1)
    left: list[np.ndarray | None] = [None] * len(queries)
    open_ = np.arange(len(queries))
    exact = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(rows.shape[1], 1) < 2**53
    for depth in DEPTHS if exact and n > 4 * k else ():
        read = max(1, int(n * depth))
        low, high = by_value[read - 1], by_value[n - read]
        seen = (ranks < read) | (ranks >= n - read)
        least, most = np.where(seen, rows, low), np.where(seen, rows, high)
        upper = both[open_] @ np.concatenate([most, least], axis=1).T
        lower = both[open_] @ np.concatenate([least, most], axis=1).T
        lower[own[open_]] = upper[own[open_]] = -np.inf
        threshold = np.partition(lower, n - k, axis=1)[:, n - k, None]
        alive = (upper >= threshold) & ~own[open_]
        done = alive.sum(axis=1) <= 8 * k
        for at in np.flatnonzero(done):
            left[open_[at]] = np.flatnonzero(alive[at])
        if depth == DEPTHS[-1]:
            for at in np.flatnonzero(~done):
                left[open_[at]] = np.flatnonzero(alive[at])
        open_ = open_[~done]
        if not len(open_):
            break
    out = []
    for q, query_id in enumerate(query_ids.tolist()):
        chosen = np.flatnonzero(~own[q]) if left[q] is None else left[q]
        if exact:
            scores = (rows[chosen] @ queries[q]).astype(np.int64)
        else:
            vector = [int(x) for x in queries[q]]
            sums = [sum(int(x) * y for x, y in zip(row, vector, strict=True)) for row in rows[chosen]]
            scores = np.array([max(-(2**63), min(2**63 - 1, s)) for s in sums], np.int64)
        best = np.lexsort((ids[chosen], ~scores))[:k]  # ~x falls as x grows, without overflow
        out += [(query_id, i, s) for i, s in zip(ids[chosen][best].tolist(), scores[best].tolist(), strict=True)]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 10, tile_rows: int = TILE_ROWS, query_rows: int = QUERY_ROWS, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best rows of ``vectors``."""

    def usable(df: DataFrame) -> DataFrame:
        v = df.select(col(id_col).cast("long").alias("id"), scaled(col(vector_col), scale).alias("v"))
        return v.where("id is not null and v is not null")

    candidates, asked = usable(vectors), usable(queries).dropDuplicates(["id", "v"])
    # Whole numbers of tiles and blocks: only two counts reach the driver.
    tiles = max(1, -(-candidates.count() // tile_rows))
    blocks = max(1, -(-asked.count() // query_rows))

    def spread(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # The row's place is part of the hash: rows that repeat one id spread as well.
    tile = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(tiles)).cast("int")
    block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")
    left = asked.select("id", "v", F.size("v").alias("d"), block.alias("block")).withColumn("tile", spread(tiles))
    right = candidates.select("id", "v", F.size("v").alias("d"), tile.alias("tile")).withColumn("block", spread(blocks))

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        found = []
        if a.num_rows and b.num_rows:
            q, c = (_matrix(t) for t in (a, b))
            found = nra(q, a["id"].to_numpy(), c, b["id"].to_numpy(), k)
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    keys = ("block", "tile", "d")
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(table: pa.Table) -> np.ndarray:
    v = table["v"].combine_chunks()
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return v.flatten().to_numpy().reshape(table.num_rows, -1 if len(v.flatten()) else 0)
