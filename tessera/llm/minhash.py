"""MinHash near-duplicates by fast similarity sketching.

1. A text's set holds its distinct word shingles. In each round every element is
   hashed to one bin and a value, and a bin keeps the least (round, value) that it
   has met. After the round in which the last bin fills, later rounds cannot change
   anything. A bin that is still empty after as many rounds as there are bins takes
   the least value over all elements in a round of its own. So every coordinate is
   filled, two sets agree in a coordinate with the probability of their Jaccard
   similarity, and the share of agreeing coordinates is concentrated around it.
2. Equal sets are one node from here on. The coordinates are cut into ``BANDS``
   bands of ``BAND_ROWS``; nodes that agree in a whole band meet in a bucket. At a
   similarity of 0.8 two sets share no band with a probability below 1e-8. A bucket
   gives a star of links to its first node, never pairs, and the stars' components
   are families: whatever is similar enough lies within one family.
3. Families are verified on their full sets of words, with exact counts. Families
   share groups of about ``TILE_CHARS`` characters; a larger one is cut into tiles
   and every pair of its tiles is one group. In a group the shared shingles of one
   set with all others are counted in one pass over their inverted lists. Members
   of the component of a typical set need no pass of their own: every link that
   leaves this component has its other end outside.
4. A group gives a spanning forest of its links, and rounds of joins give the
   components. Tables between the steps go to the shared folder.

Defined results: null texts and texts without words have an empty set, which links
with nothing; a text with fewer words than a shingle is one shingle. A-Z are
lower-cased and words are what stands between ASCII white space. Repeated rows
have equal sets and link. A null id is never a component's id unless all ids of
the component are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, stored, utf8
from tessera.llm.simhash import components

SHINGLE_WORDS = 2
PERCENT = 80
BANDS = 80
BAND_ROWS = 7
TILE_CHARS = 4_000_000
HUBS = 8
KNOWN_WORDS = 300_000  # hashes of words that a worker remembers
GOLDEN = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes half of the output's."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_ids(words: list[bytes], numbers: dict[bytes, int], shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles as rows of word numbers; ``numbers`` grows with new words."""
    if not words:
        return np.empty((0, shingle), np.int64)
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(ids) < shingle:
        return np.concatenate([ids, np.full(shingle - len(ids), -1)])[None, :]
    rows = np.lib.stride_tricks.sliding_window_view(ids, shingle)
    if shingle == 2 and len(numbers) < 2**31:
        packed = np.unique((rows[:, 0] << 32) | rows[:, 1])
        return np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1)
    return np.unique(rows, axis=0)


def sketch(hashes: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a non-empty set of 64-bit hashes."""
    least = np.full(size, np.iinfo(np.uint64).max, np.uint64)

    def values(rounds: np.ndarray) -> np.ndarray:
        seeds = (rounds.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN)
        return _mixed(hashes[None, :] ^ _mixed(seeds)[:, None])

    low = np.uint64(0xFFFFFFFF)
    at, block = 0, max(1, -(-4 * size // len(hashes)))
    while at < size:
        rounds = np.arange(at, min(at + block, size))
        drawn = values(rounds)
        bins = ((drawn >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        np.minimum.at(least, bins.ravel().astype(np.int64), ((rounds.astype(np.uint64)[:, None] << np.uint64(32)) | (drawn & low)).ravel())
        at += len(rounds)
        if (least != np.iinfo(np.uint64).max).all():
            return least
    empty = np.flatnonzero(least == np.iinfo(np.uint64).max)
    for some in np.array_split(empty, -(-len(empty) * len(hashes) // 1_000_000)):
        rounds = size + some
        least[some] = (rounds.astype(np.uint64) << np.uint64(32)) | (values(rounds) & low).min(axis=1)
    return least


class Sketcher:
    """Sizes, keys and bands of texts; remembers the hashes of words."""

    def __init__(self, shingle: int, bands: int, band_rows: int) -> None:
        self.shingle, self.bands, self.band_rows = shingle, bands, band_rows
        self.known: dict[bytes, int] = {}

    def hashes(self, data: bytes) -> np.ndarray:
        """The hashes of the distinct shingles, sorted."""
        numbers: dict[bytes, int] = {}
        rows = shingle_ids(data.lower().split(), numbers, self.shingle)  # bytes: only A-Z and ASCII white space count
        if not len(rows):
            return np.empty(0, np.uint64)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        of_word = np.array([known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in numbers] + [0], np.uint64)
        mixed = np.full(len(rows), self.shingle, np.uint64)
        for at in range(self.shingle):
            mixed = _mixed(mixed * np.uint64(GOLDEN) + of_word[rows[:, at]])
        return np.sort(mixed)

    def of(self, data: bytes) -> tuple[int, bytes | None, list[int] | None]:
        hashes = self.hashes(data)
        if not len(hashes):
            return 0, None, None
        raw = sketch(hashes, self.bands * self.band_rows).astype("<u8").tobytes()
        step = 8 * self.band_rows
        # The band's number is the seed: equal values in different bands do not meet.
        bands = [xxhash.xxh3_64_intdigest(raw[b * step : (b + 1) * step], b) for b in range(self.bands)]
        return len(hashes), xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes()), bands


def sketch_column(text: Column, shingle: int = SHINGLE_WORDS, bands: int = BANDS, band_rows: int = BAND_ROWS) -> Column:
    """struct(n, key, bands) of each text: the size of its set, a key that equal
    sets share, and the hashes of the bands."""

    @F.arrow_udf("n long, key binary, bands array<long>")
    def sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker = Sketcher(shingle, bands, band_rows)
        for batch in batches:
            sizes, keys, hashes = zip(*(worker.of(data.as_py()) for data in batch), strict=True) if len(batch) else ([], [], [])
            flat = np.array([h for x in hashes if x for h in x], np.uint64).view(np.int64)
            ends = np.cumsum([0] + [len(x) if x else 0 for x in hashes]).astype(np.int32)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["n", "key", "bands"],
            )

    return sketches(utf8(text))


class _Forest:
    """Links between places, kept as a spanning forest."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, x: int, others: list[int]) -> None:
        x = self.root(x)
        for y in others:
            y = self.root(y)
            x, y = min(x, y), max(x, y)
            self.up[y] = x


class _Sets:
    """The sets of some texts, with inverted lists of the shingles that several share."""

    def __init__(self, texts: list[bytes], shingle: int) -> None:
        numbers: dict[bytes, int] = {}
        rows = [shingle_ids(t.lower().split(), numbers, shingle) for t in texts]
        self.size = np.array([len(r) for r in rows], np.int64)
        _, column = np.unique(np.concatenate(rows), axis=0, return_inverse=True) if shingle != 2 else _pairs(np.concatenate(rows))
        column = column.reshape(-1)
        place = np.repeat(np.arange(len(texts)), self.size)
        shared = np.bincount(column)[column] > 1
        column, place = column[shared], place[shared]
        by = np.argsort(column, kind="stable")
        self.lists = place[by]
        self.begin = np.searchsorted(column[by], np.arange(column.max(initial=-1) + 2))
        self.columns = column  # still by text
        self.rows = np.searchsorted(place, np.arange(len(texts) + 1))
        weight = np.diff(self.begin)[column] if len(column) else column
        self.typical = np.bincount(place, weight, len(texts)) / self.size

    def similar(self, x: int, percent: int) -> np.ndarray:
        """The places of all sets similar enough to set ``x`` (itself included)."""
        columns = self.columns[self.rows[x] : self.rows[x + 1]]
        begin, size = self.begin[columns], self.begin[columns + 1] - self.begin[columns]
        total = int(size.sum())
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(total)
        both = np.bincount(self.lists[at], minlength=len(self.size))
        return np.flatnonzero((100 * both >= percent * (self.size[x] + self.size - both)) & (both > 0))


def _pairs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique((rows[:, 0] << 32) | (rows[:, 1] & 0xFFFFFFFF), return_inverse=True)


def similar_forest(texts: list[bytes], shingle: int = SHINGLE_WORDS, percent: int = PERCENT, left: int | None = None) -> list[int]:
    """For each text the first text of its component; with ``left``, of the links
    between the first ``left`` texts and the others, found from the smaller side."""
    sets, forest = _Sets(texts, shingle), _Forest(len(texts))
    if left is None:
        order = np.argsort(-sets.typical, kind="stable").tolist()
        for x in order[:HUBS]:
            forest.link(x, sets.similar(x, percent).tolist())
        roots = [forest.root(x) for x in range(len(texts))]
        main = max(order[:HUBS], key=lambda x: roots.count(roots[x]))
        for x in order[HUBS:]:
            if forest.root(x) != forest.root(main):
                forest.link(x, sets.similar(x, percent).tolist())
    else:
        for x in range(left) if 2 * left <= len(texts) else range(left, len(texts)):
            forest.link(x, sets.similar(x, percent).tolist())
    return [forest.root(x) for x in range(len(texts))]


def _families(nodes: DataFrame) -> DataFrame:
    """(node, root) of the nodes that share a band with another one."""
    meets = nodes.select("node", F.explode("bands").alias("bucket"))
    first = F.min("node").over(Window.partitionBy("bucket"))
    return components(meets.withColumn("first", first).where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))


def _links(members: DataFrame, shingle: int, percent: int, tile_chars: int) -> DataFrame:
    """Links (a, b) between similar members (root, node, text) of the families: a
    spanning forest of each group."""
    sizes = members.groupBy("root").agg(F.sum(F.length("text") + 64).alias("chars"))
    sizes = sizes.withColumn("tiles", F.ceil(F.col("chars") / tile_chars).cast("int"))
    total = sizes.where("tiles = 1").agg(F.sum("chars")).first()[0] or 0
    bins = max(1, -(-int(total) // tile_chars))
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    placed = members.join(sizes.drop("chars"), "root").withColumn("tile", tile)
    # A family of one tile shares a group with others; of several, each pair of tiles is a group.
    other = F.explode(F.when(F.col("tiles") > 1, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array(F.lit(0))))
    paired = placed.withColumn("other", other)
    group = F.when(
        F.col("tiles") > 1, F.concat_ws(".", "root", F.least("tile", "other"), F.greatest("tile", "other"))
    ).otherwise(F.concat(F.lit("bin "), F.pmod(F.xxhash64("root"), F.lit(bins))))
    named = paired.select(group.alias("group"), "root", "node", F.col("tile").alias("tile"), (F.col("tile") != F.col("other")).alias("across"), utf8(F.col("text")).alias("text"))

    def verify(table: pd.DataFrame) -> pd.DataFrame:
        found = []
        # In a pair of tiles the first tile's rows come first, then the second's.
        table = table.sort_values(["root", "tile", "node"])
        for _, family in table.groupby("root", sort=False):
            left = int((family["tile"] == family["tile"].iat[0]).sum()) if family["across"].iat[0] else None
            nodes = family["node"].tolist()
            roots = similar_forest(family["text"].tolist(), shingle, percent, left)
            found += [(nodes[r], nodes[x]) for x, r in enumerate(roots) if r != x]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return named.groupBy("group").applyInPandas(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE_WORDS, percent: int = PERCENT,
    bands: int = BANDS, band_rows: int = BAND_ROWS, tile_chars: int = TILE_CHARS,
) -> DataFrame:
    """One row per document: the id, n_shingles and component_id (the smallest id
    of its component)."""
    numbered = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    whole = stored(numbered.withColumn("s", sketch_column(F.col("text"), shingle, bands, band_rows)).select("id", "text", "row", "s.*"), "sketches")
    # One node for each set; the row's number names it.
    nodes = whole.where("n > 0").groupBy("key").agg(F.min("row").alias("node"), F.min("id").alias("id"), F.first("bands").alias("bands"))
    nodes = stored(nodes, "nodes")
    families = _families(nodes)
    texts = whole.select(F.col("row").alias("node"), "text")
    # A merge join at every size: the texts are shuffled once, whatever the families' size.
    members = stored(texts.join(families.hint("merge"), "node"), "members")
    linked = components(_links(members, shingle, percent, tile_chars)).join(nodes.select("node", "key", "id"), "node")
    first = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    named = linked.join(first, "root").select("key", "component_id")
    grouped = stored(nodes.join(named, "key", "left").select("key", F.coalesce("component_id", "id").alias("component_id")), "grouped")
    # A plain join of two stored tables: AQE can split a set that a third of all rows share.
    some = whole.where("n > 0").select("id", "n", "key").join(grouped, "key").select("id", "n", "component_id")
    none = whole.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.union(none).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
