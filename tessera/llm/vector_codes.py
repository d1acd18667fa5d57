"""Vector code compression: product codebooks by member-resident Lloyd.

Vectors of integers (floor(scale * x)) are cut into equal parts, and each part
position learns a codebook of a few entries. Lloyd's rounds keep the members where
they are:

1. A member is one part of one vector. Members are partitioned by (position,
   entry, salt); a cell of these holds its members as numpy blocks. The salt is
   taken from the row's number, so an entry with a third of all vectors is held by
   many cells, each of bounded size.
2. The owners of the cells add up their resident members; the sums of an entry's
   salts are added, and the new entries (one bounded table) go to the driver and
   back to all.
3. Each owner looks up the nearest new entry of its members. Those that keep their
   entry stay: the blocks go from one round to the next inside their partition.
   Only members that change their entry go through the next shuffle, to the cell
   of the new entry, and join the residents there.
4. After the last round the members are assigned once more, and a vector's parts
   are put together by the row's number.

This is the one operator here that needs RDDs: a union of two RDDs of the same
partitioner keeps the residents in place, which DataFrames do not offer. Blocks
are numpy arrays, so rows are never handled one by one. Every few rounds the
members are checkpointed in the shared folder; a lost executor's blocks are
computed again from there.

Defined results: rows whose vector is null or holds null or non-finite components
are dropped; the first entries are the vectors with the smallest ids, null ids
last, ties by components; with fewer vectors than entries, the codebooks have as
many entries as there are vectors; repeated rows count each; an entry without
members stays as it is; ties go to the lower index. Vectors of different lengths,
or of one that the parts do not divide, raise an error. Components beyond 2^62
after scaling are held there; sums and distances are exact, and an error beyond 64
bits is held at the largest long. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, stored, without

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
CELL_ROWS = 65_536  # members of a cell, if one entry holds all vectors
LEAST_SALTS = 4
CHECKPOINT_ROUNDS = 3
HELD = 2**62
LARGEST = 2**63 - 1
Block = tuple[np.ndarray, np.ndarray]  # row numbers, parts


class Codes(NamedTuple):
    """``rows``: the kept rows with ``code`` (array<int>) and ``error`` (long);
    ``codebooks``: [position][entry][component]."""

    rows: DataFrame
    codebooks: list[list[list[int]]]


class Layout(NamedTuple):
    """Cells are numbered by position, entry and salt."""

    parts: int
    entries: int
    salts: int

    def cells(self, position: int, entry: int, rows: np.ndarray) -> np.ndarray:
        return (position * self.entries + entry) * self.salts + rows % self.salts

    def place(self, cell: int) -> tuple[int, int]:
        """Position and entry of a cell."""
        return divmod(cell // self.salts, self.entries)


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as longs; null if any is null or not finite."""

    def whole(x: Column) -> Column:
        held = F.greatest(F.least(x.cast("double") * scale, F.lit(float(HELD))), F.lit(-float(HELD)))
        return F.floor(held).cast("long")

    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, whole))


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))


def nearest(parts: np.ndarray, codebook: list[list[int]]) -> Block:
    """The index of each part's nearest entry (ties: the lowest) and its squared
    distance: in floats while all sums stay below 2^53, else in Python integers."""
    entries = np.array(codebook, dtype=object).reshape(len(codebook), -1)
    most = max(_largest(parts), max((abs(x) for entry in codebook for x in entry), default=0))
    kind = np.float64 if 4 * parts.shape[1] * most * most < 2**53 else object
    p, e = parts.astype(kind), entries.astype(kind)
    distance = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None, :]
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(parts)), best]


def _narrow(parts: np.ndarray) -> np.ndarray:
    """The parts in the smallest integer type that holds them."""
    most = _largest(parts)
    return parts.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def _dealt(rows: np.ndarray, parts: np.ndarray, position: int, entry: np.ndarray, layout: Layout) -> Iterator[tuple[int, Block]]:
    """Blocks of members by the cells of their entries."""
    cell = layout.cells(position, entry, rows)
    order = np.argsort(cell, kind="stable")
    for chosen in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(rows) else ():
        yield int(cell[chosen[0]]), (rows[chosen], parts[chosen])


def _owner(cell: int) -> int:
    return cell


def _joined(blocks: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, Block]]:
    """One block for each cell of a partition."""
    cells: dict[int, list[Block]] = defaultdict(list)
    for cell, block in blocks:
        cells[cell].append(block)
    while cells:
        cell, found = cells.popitem()
        yield cell, found[0] if len(found) == 1 else (np.concatenate([r for r, _ in found]), _narrow(np.concatenate([p for _, p in found])))


def _first_members(kept: DataFrame, row: str, vector: str, codebooks: list, layout: Layout, partitions: int) -> RDD:
    width = len(codebooks[0][0])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            vectors = batch.column(1).flatten().to_numpy().reshape(len(rows), -1)
            blocks = []
            for position, codebook in enumerate(codebooks):
                parts = _narrow(vectors[:, position * width : (position + 1) * width])
                blocks += _dealt(rows, parts, position, nearest(parts, codebook)[0], layout)
            columns = zip(*((c, r.tobytes(), p.tobytes(), p.dtype.str) for c, (r, p) in blocks), strict=True)
            types = (pa.int64(), pa.binary(), pa.binary(), pa.string())
            arrays = [pa.array(x, t) for x, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["cell", "rows", "parts", "kind"])

    def block(r: tuple) -> tuple[int, Block]:
        rows = np.frombuffer(r["rows"], np.int64)
        return r["cell"], (rows, np.frombuffer(r["parts"], r["kind"]).reshape(len(rows), width))

    schema = "cell long, rows binary, parts binary, kind string"
    blocks = kept.select(col(row), col(vector)).mapInArrow(deal, schema).rdd.map(block)
    return blocks.partitionBy(partitions, _owner).mapPartitions(_joined, preservesPartitioning=True)


def _updated(members: RDD, codebooks: list, layout: Layout) -> list:
    """The codebooks with each entry at the floor of its members' mean."""

    def sums(blocks: Iterator[tuple[int, Block]]) -> Iterator:
        for cell, (rows, parts) in blocks:
            wide = parts.astype(np.int64 if _largest(parts) * len(rows) < HELD else object)
            yield layout.place(cell), (len(rows), wide.sum(axis=0).tolist())

    def added(a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], [int(x) + int(y) for x, y in zip(a[1], b[1], strict=True)]

    # At most parts x entries sums, whatever the input.
    totals = members.mapPartitions(sums).reduceByKey(added, min(layout.parts, members.getNumPartitions())).collectAsMap()
    new = [list(entries) for entries in codebooks]
    for (position, entry), (count, total) in totals.items():
        new[position][entry] = [int(x) // count for x in total]
    return new


def _migrated(members: RDD, codebooks: list, layout: Layout, partitions: int) -> RDD:
    """The members after each was assigned anew: those of an unchanged entry stay
    in their partition, the others go to the owner of their new cell."""

    def residents(blocks: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, Block]]:
        for cell, (rows, parts) in blocks:
            position, entry = layout.place(cell)
            stays = nearest(parts, codebooks[position])[0] == entry
            if stays.any():
                yield cell, (rows[stays], parts[stays])

    def movers(blocks: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, Block]]:
        for cell, (rows, parts) in blocks:
            position, entry = layout.place(cell)
            new = nearest(parts, codebooks[position])[0]
            goes = new != entry
            yield from _dealt(rows[goes], parts[goes], position, new[goes], layout)

    stay = members.mapPartitions(residents, preservesPartitioning=True)
    arrive = members.mapPartitions(movers).partitionBy(partitions, _owner)
    # One partitioner on both sides: the union is by partition, and nothing that stays is shuffled.
    return stay.union(arrive).mapPartitions(_joined, preservesPartitioning=True)


def _coded(members: RDD, codebooks: list, layout: Layout, df: DataFrame) -> DataFrame:
    """(row, position, entry, error) of every member's last assignment."""

    def code(blocks: Iterator[tuple[int, Block]]) -> Iterator[tuple]:
        for cell, (rows, parts) in blocks:
            position, _ = layout.place(cell)
            entry, distance = nearest(parts, codebooks[position])
            held = np.array([min(int(d), LARGEST) for d in distance], np.int64)
            yield position, rows.tobytes(), entry.astype(np.int32).tobytes(), held.tobytes()

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, rows, entry, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = np.frombuffer(rows, np.int64)
                arrays = [row, np.full(len(row), position, np.int32), np.frombuffer(entry, np.int32), np.frombuffer(held, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["row", "position", "entry", "error"])

    schema = "position int, rows binary, entries binary, errors binary"
    blocks = df.sparkSession.createDataFrame(members.mapPartitions(code), schema, verifySchema=False)
    return blocks.mapInArrow(single, "row long, position int, entry int, error long")


def compress(
    vectors: DataFrame, id_col: str, vector_col: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE, cell_rows: int = CELL_ROWS,
) -> Codes:
    """Codebooks for the vectors, and each vector's code and error: every column of
    its row but one named ``code`` or ``error`` stays."""
    row, whole = fresh(vectors, "row"), fresh(vectors, "whole")
    numbered = vectors.withColumn(whole, scaled(col(vector_col), scale)).where(col(whole).isNotNull())
    kept = stored(numbered.withColumn(row, F.monotonically_increasing_id()), "vectors")
    size = F.size(col(whole))
    n, shortest, longest = kept.agg(F.count("*"), F.min(size), F.max(size)).first()
    others = without(kept, row, whole, "code", "error")
    if not n:
        return Codes(kept.select(*others, F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error")), [[] for _ in range(parts)])
    if shortest != longest or longest % parts:
        raise ValueError(f"vectors of {shortest} to {longest} components cannot be cut into {parts} equal parts")

    width = longest // parts
    first = kept.orderBy(col(id_col).asc_nulls_last(), whole).select(whole).limit(entries).collect()
    codebooks = [[list(r[0][p * width : (p + 1) * width]) for r in first] for p in range(parts)]
    layout = Layout(parts, len(first), max(LEAST_SALTS, -(-n // cell_rows)))
    partitions = max(vectors.sparkSession.sparkContext.defaultParallelism, layout.salts)
    members = _first_members(kept, row, whole, codebooks, layout, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    partitions, before = members.getNumPartitions(), None
    for r in range(rounds):
        codebooks = _updated(members, codebooks, layout)
        if before is not None:
            before.unpersist()
        if r == rounds - 1:
            break  # the last assignment is read where the members are
        before, members = members, _migrated(members, codebooks, layout, partitions).persist(StorageLevel.MEMORY_AND_DISK)
        if (r + 1) % CHECKPOINT_ROUNDS == 0:
            members.checkpoint()
    codes = _coded(members, codebooks, layout, vectors).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("position", "entry")))["entry"].alias("code"),  # one of each position
        F.coalesce(F.try_sum("error"), F.lit(LARGEST)).alias("error"),
    )
    rows = stored(kept.select(*others, col(row)).join(codes.toDF(row, "code", "error"), row).drop(row), "codes")
    members.unpersist()
    return Codes(rows, codebooks)
