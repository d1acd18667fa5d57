"""SimHash near-duplicates by tiled exact comparison.

1. A worker turns each text into a 64-bit fingerprint: A-Z lower-cased, words
   between ASCII white space, shingles of three words (repeats included), XXH64
   of each, and a bit is 1 where more than half of the hashes have it.
2. The distinct fingerprints, with the smallest id of each, go on: a group of
   exact copies counts once from here, combined before the shuffle.
3. Fingerprints are dealt into tiles by the population counts of their two
   halves, classes of more than ``TILE_ROWS`` into several tiles, each packed as one
   binary. Two fingerprints within r bits have counts that differ by r at most in
   sum, so tile pairs beyond that are skipped. Every other pair of tiles is compared
   exactly with numpy: exclusive or, then bit counts, in strips of bounded size.
4. A tile pair gives a spanning forest of its links, never all linked pairs, so a
   large group of near copies stays linear. Components are found by rounds of
   joins: every node points to its smallest neighbour, pointers are shortened,
   and the links shrink to links between roots until none is left.

Tables between the steps are written to the shared folder; nothing is collected.

Defined results: a null text counts as empty; texts without words have
fingerprint zero and link like any other. A null id never is a component's id
unless all ids of the component are null. ``keep_one`` breaks ties by
fingerprint and keeps one of repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, stored, utf8

SHINGLE_WORDS = 3
MAX_BITS = 3
TILE_ROWS = 65_536  # half a megabyte
PARTNERS = 8  # tiles that one task compares with its own
STRIP_CELLS = 2**18  # of a table of comparisons
HASH_SEED = 42


def fingerprint(data: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text's UTF-8 bytes, as a signed 64-bit integer."""
    words = data.lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    last = max(len(words) - shingle, 0)
    ones = np.zeros(64, np.int64)
    for at in range(0, last + 1, 65_536):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), HASH_SEED) for i in range(at, min(at + 65_536, last + 1))),
            "<u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > last + 1, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of each text as a long."""

    @F.arrow_udf("long")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(b, shingle) for b in batch.to_pylist()], pa.int64())

    return fingerprints(utf8(text))


def fingerprint_hex(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _forest(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two sets of fingerprints (or
    within one): every node points to the smallest of its component."""
    nodes = np.unique(np.concatenate([left, right]))
    li, ri = np.searchsorted(nodes, left), np.searchsorted(nodes, right)
    root = np.arange(len(nodes))
    lu, ru = left.view(np.uint64), right.view(np.uint64)
    strip = max(1, STRIP_CELLS // max(1, len(right)))
    for at in range(0, len(left), strip):
        near = np.bitwise_count(lu[at : at + strip, None] ^ ru[None, :]) <= bits
        a, b = np.nonzero(near)
        a, b = li[at + a], ri[b]
        while True:
            a, b = root[a], root[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != (shorter := root[root])).any():
                root = shorter
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[linked], nodes[root[linked]]


def _tiles(fingerprints: DataFrame, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """(sizes, tiles): the classes (hi, lo) of the halves' bit counts with their
    numbers of tiles, and every tile (hi, lo, t) with its fingerprints as one binary."""
    halves = [F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"), F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo")]
    classed = fingerprints.select("fp", *halves)
    # At most 33 x 33 classes, whatever the input.
    sizes = stored(classed.groupBy("hi", "lo").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles")), "classes")
    placed = classed.join(F.broadcast(sizes), ["hi", "lo"]).select("hi", "lo", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int").alias("t"), "fp")

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        columns = {n: pa.array([k.as_py()], pa.int32()) for n, k in zip(("hi", "lo", "t"), key, strict=True)}
        return pa.table(columns | {"packed": pa.array([np.sort(table["fp"].to_numpy()).tobytes()], pa.binary())})

    return sizes, stored(placed.groupBy("hi", "lo", "t").applyInArrow(packed, "hi int, lo int, t int, packed binary"), "tiles")


def _neighbours(sizes: DataFrame, bits: int) -> DataFrame:
    """(first, second, part): every pair of tiles whose bit counts allow a link, each
    pair once (a tile with itself included); a tile's partners in parts of ``PARTNERS``."""
    offsets = [(h, low) for h in range(-bits, bits + 1) for low in range(-bits, bits + 1) if abs(h) + abs(low) <= bits]
    near = sizes.select(
        F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("tiles").alias("tiles2"),
        F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(low).alias("l")) for h, low in offsets])).alias("o"),
    ).select((F.col("hi2") + F.col("o.h")).alias("hi"), (F.col("lo2") + F.col("o.l")).alias("lo"), "hi2", "lo2", "tiles2")
    around = sizes.join(near, ["hi", "lo"]).groupBy("hi", "lo", "tiles").agg(F.collect_list(F.struct("hi2", "lo2", "tiles2")).alias("around"))
    every = F.flatten(
        F.transform(
            "around",
            lambda c: F.transform(
                F.sequence(F.lit(0), c["tiles2"] - 1), lambda t: F.struct(c["hi2"].alias("hi"), c["lo2"].alias("lo"), t.alias("t"))
            ),
        )
    )
    firsts = around.select("hi", "lo", "around", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("t"))
    named = firsts.select(F.struct("hi", "lo", "t").alias("first"), every.alias("every"))
    later = F.filter("every", lambda second: second >= F.col("first"))
    return named.select("first", F.posexplode(later).alias("place", "second")).select(
        "first", "second", F.floor(F.col("place") / PARTNERS).cast("int").alias("part")
    )


def links(fingerprints: DataFrame, bits: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fp``) within
    ``bits`` bits: a spanning forest of each tile pair. A tile travels as one packed
    binary to each part of its earlier neighbours' pairs, and once to each part of its
    own; a task holds at most ``PARTNERS`` + 1 tiles."""
    sizes, tiles = _tiles(fingerprints, tile_rows)
    pairs = _neighbours(sizes, bits)
    held = tiles.select(F.struct("hi", "lo", "t").alias("second"), "packed")
    partners = pairs.join(held, "second").select("first", "part", F.lit(False).alias("own"), (F.col("first") == F.col("second")).alias("same"), "packed")
    owners = pairs.select("first", "part").distinct().join(held.withColumnRenamed("second", "first"), "first")
    owners = owners.select("first", "part", F.lit(True).alias("own"), F.lit(False).alias("same"), "packed")
    # Keys as text: a tile's name. Spark deals the groups out by hash.
    named = owners.union(partners).select(F.concat_ws(".", "first.hi", "first.lo", "first.t").alias("tile"), "part", "own", "same", "packed")

    def compare(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(np.frombuffer(r["packed"], np.int64) for r in rows if r["own"])
        found = [_forest(own, own if r["same"] else np.frombuffer(r["packed"], np.int64), bits) for r in rows if not r["own"]]
        ends = [np.concatenate(x) for x in zip(*found, strict=True)]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    return named.groupBy("tile", "part").applyInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest
    node of its component. Each round stores its tables in the shared folder."""
    edges = stored(edges.where("a <> b").distinct(), "links")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        to = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        to = stored(_shortened(_shortened(to)), "pointers")
        start, end = to.toDF("a", "root_a"), to.toDF("b", "root_b")
        if roots is None:
            roots = to
        else:
            moved = to.toDF("root", "next")
            roots = stored(
                roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots"
            )
        edges = stored(
            edges.join(start, "a").join(end, "b").where("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "links"
        )
    return roots if roots is not None else edges.toDF("node", "root")


def _shortened(to: DataFrame) -> DataFrame:
    """Pointers to the pointer's target."""
    return to.join(to.toDF("root", "next"), "root").select("node", F.col("next").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: the id, fp and component_id (the smallest id of
    its component)."""
    prints = stored(docs.select(col(id_col).alias("id"), fingerprint_column(col(text_col), shingle).alias("fp")), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    # A plain join of two stored tables: AQE can split a fingerprint that a third of all rows share.
    grouped = stored(_grouped(nodes, bits).select("fp", "component_id"), "grouped")
    return prints.join(grouped, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _grouped(nodes: DataFrame, bits: int) -> DataFrame:
    """The distinct fingerprints (fp, with the smallest id of each) with
    component_id and first_fp, the fingerprint of the document that a component
    keeps. Further columns of ``nodes`` stay."""
    linked = components(links(nodes, bits)).join(nodes.select(F.col("fp").alias("node"), "id"), "node")
    first = linked.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "node")).alias("first"))
    named = linked.select("node", "root").join(first, "root").select(F.col("node").alias("fp"), "first")
    return nodes.join(named, "fp", "left").select(
        *nodes.columns,
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        F.coalesce("first.node", "fp").alias("first_fp"),
    )


def keep_one(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One whole document of each component: that with the smallest id. Each row
    is numbered when it is stored; only numbers go through the grouping, and the
    texts are shuffled once, for the last join, by their unique numbers."""
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    numbered = docs.withColumn(fp, fingerprint_column(col(text_col), shingle)).withColumn(row, F.monotonically_increasing_id())
    marked = stored(numbered, "marked")
    prints = marked.select(col(id_col).alias("id"), col(fp).alias("fp"), col(row).alias("row"))
    first_row = F.coalesce(F.min_by("row", "id"), F.min("row"))
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("id"), first_row.alias("row")), "nodes")
    kept = _grouped(nodes, bits).where("fp = first_fp").select(F.col("row").alias(row))
    return marked.join(kept, row, "left_semi").drop(fp, row)
