"""Benchmark decontamination with a generalised suffix automaton.

The automaton is built over the words of all test items and holds every run of
consecutive words of any item. Documents are streamed through it word by word:
the state and the length of the longest run that ends here are tracked, so one
pass finds every occurrence. Where that length reaches ``window`` words, the
last ``window`` words are hit; where it reaches a shorter item's whole length,
that item's words are hit. Hit words form spans; a document is contaminated
when its hit words reach a share of all its words.

Distinct items are dealt into shards of bounded size (``SHARD_CHARS`` of text). Tasks
build one automaton for each and store it in the shared folder; it is broadcast for its
pass over the documents, so what is broadcast is bounded however many items there are.
With several shards each pass stores row numbers and finds of the texts that it hits,
no texts, and one join brings the merged finds back to the documents.
Measured: a million characters of random words give 185,000 states, 140 MB in
each worker and 7 MB to broadcast, so a full shard stays below 300 MB a worker.

Words: A-Z lower-cased, then runs of digits, letters a-z and characters beyond
ASCII. Defined results: a null text has no words, no hits and is clean; an item
without words has no window; an item without id hits words but is not counted
or listed; repeated items count once.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, col, fresh, stored, utf8

WINDOW = 13
SHARD_CHARS = 2_000_000
MIN_SHARE = 20  # contaminated: 1 of this many words is hit, or more

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
TEXT_WORD = r"[0-9a-z\x{80}-\x{10ffff}]+"  # the same in a text


def words(data: bytes) -> list[bytes]:
    """The words of a text's UTF-8 bytes."""
    return WORD.findall(data.lower())  # bytes.lower() changes A-Z only


class Automaton:
    """A generalised suffix automaton over items' words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[str | None]] = {}  # state -> items with an occurrence that ends in it
        whole: dict[int, dict[int, set[str | None]]] = {}  # state -> length -> short items of just that text
        for item, item_words in items:
            state = 0
            for word in item_words:
                state = self._extend(state, word)
                ends.setdefault(state, set()).add(item)
            if 0 < len(item_words) < window:
                whole.setdefault(state, {}).setdefault(len(item_words), set()).add(item)
        self._mark(ends, whole)

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._state({}, self.length[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _state(self, edges: dict[bytes, int], length: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        clone = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _mark(self, ends, whole) -> None:
        """For each state: the state of its last ``window`` words, the items
        of such states, and the short items that end in it."""
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        window_items: dict[int, set] = {}
        for state in reversed(order):  # the longest first: what occurs here occurs in the link too
            found = ends.get(state)
            if not found or state == 0:
                continue
            if self.length[self.link[state]] >= self.window:
                ends.setdefault(self.link[state], set()).update(found)
            elif self.length[state] >= self.window:
                window_items[state] = found
        self.window_state = [-1] * len(self.next)
        # state -> ((length, items), ...): short items that are the text's end, in this state or on its links
        self.short: list[tuple] = [()] * len(self.next)
        for state in order[1:]:
            link = self.link[state]
            if self.length[state] >= self.window:
                self.window_state[state] = state if self.length[link] < self.window else self.window_state[link]
            own = tuple((n, frozenset(i)) for n, i in sorted(whole.get(state, {}).items()))
            self.short[state] = self.short[link] + own
        self.window_items = {s: frozenset(i) for s, i in window_items.items()}

    def match(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans [start, end) of hit words, merged and in order, and the items
        with an occurrence."""
        edges, link, length, window = self.next, self.link, self.length, self.window
        window_state, short = self.window_state, self.short
        state = run = 0
        spans: list[tuple[int, int]] = []
        hit_states, hit_short = set(), set()
        for i, word in enumerate(text):
            to = edges[state].get(word)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = edges[state].get(word)
                run = length[state]
                if to is None:
                    continue
            state = to
            run += 1
            longest = 0
            if run >= window:
                longest = window
                # The run may be shorter than the state's own texts, never shorter than its link's.
                hit_states.add(window_state[state])
            if short[state]:
                for n, items in short[state]:
                    if n <= run:
                        longest = max(longest, n)
                        hit_short.add(items)
            if longest:
                start = i + 1 - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        found = set().union(*hit_short, *(self.window_items.get(s, ()) for s in hit_states))
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


MATCH_TYPE = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def _match_column(text: Column, automaton: Broadcast | None) -> Column:
    """What an automaton finds in each text, in one pass; nothing without one."""

    @F.arrow_udf(MATCH_TYPE)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for data in texts.to_pylist():
                text_words = words(data)
                spans, items = _held(automaton).match(text_words) if automaton is not None else ([], set())
                out.append({
                    "n_words": len(text_words), "n_hit": sum(e - s for s, e in spans), "items": sorted(i for i in items if i is not None),
                    "spans": [{"start": s, "end": e} for s, e in spans],
                })
            yield pa.array(out, _ARROW_TYPE)

    return match(utf8(text))


def _merge_column(found: Column) -> Column:
    """The finds of several shards in one text as one."""

    @F.arrow_udf(MATCH_TYPE)
    def merge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for shards in batch.to_pylist():
                spans = merged([(s["start"], s["end"]) for m in shards for s in m["spans"]])
                out.append({
                    "n_words": shards[0]["n_words"], "n_hit": sum(e - s for s, e in spans), "items": sorted({i for m in shards for i in m["items"]}),
                    "spans": [{"start": s, "end": e} for s, e in spans],
                })
            yield pa.array(out, _ARROW_TYPE)

    return merge(found)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ARROW_TYPE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", _SPANS)])


def automata(spark: SparkSession, items: DataFrame, id_col: str, text_col: str, window: int = WINDOW, shard_chars: int = SHARD_CHARS):
    """Broadcast automata, each over a shard of the distinct items of bounded size.
    Tasks build them, one a shard, and store them in the shared folder; the driver only
    passes a shard's finished bytes on."""
    rows = items.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text"))
    rows = stored(rows.where("text is not null").distinct(), "items")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + int(total // shard_chars)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        some = [(i, words(t.encode())) for i, t in zip(table["id"].to_pylist(), table["text"].to_pylist(), strict=True)]
        data = pickle.dumps(Automaton(some, window), pickle.HIGHEST_PROTOCOL)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "automaton": pa.array([data], pa.binary())})

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("text", "id"), F.lit(n)).cast("int"))
    built = stored(sharded.groupBy("shard").applyInArrow(build, "shard int, automaton binary"), "automata")
    for i in range(n):
        found = built.where(F.col("shard") == i).select("automaton").first()
        if found is not None:
            yield spark.sparkContext.broadcast(found[0])


@lru_cache(maxsize=1)
def _held(automaton: Broadcast) -> Automaton:
    """A worker's copy of the automaton, unpacked once."""
    return pickle.loads(automaton.value)


def find_contamination(
    docs: DataFrame, text_col: str, items: DataFrame, item_id: str, item_text: str, out: str = "match", window: int = WINDOW,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """``docs`` with a column ``out``: n_words, n_hit, the items found (as
    strings, sorted) and the hit spans in words. With several shards the documents are
    stored once under row numbers; each shard's pass keeps numbers, spans and items
    only, and the texts meet the merged finds in one join."""
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    shards = automata(docs.sparkSession, items, item_id, item_text, window, shard_chars)
    first, second = next(shards, None), next(shards, None)
    if second is None:
        return docs.select(*[col(c) for c in kept], _match_column(col(text_col), first).alias(out))
    row = fresh(docs, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    finds = None
    for automaton in chain((first, second), shards):
        some = numbered.select(col(row).alias("row"), _match_column(col(text_col), automaton).alias("m"))
        some = stored(some.where("m.n_hit > 0"), "match")
        finds = some if finds is None else finds.union(some)
        automaton.unpersist()
    merged_finds = finds.groupBy("row").agg(F.collect_list("m").alias("found"))  # at most one a shard
    merged_finds = merged_finds.select(F.col("row").alias(row), _merge_column(F.col("found")).alias(out))
    joined = numbered.select(*[col(c) for c in (*kept, row)]).join(merged_finds, row, "left")
    nothing = F.struct(
        F.regexp_count(ascii_lower(F.coalesce(col(text_col).cast("string"), F.lit(""))), F.lit(TEXT_WORD)).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
    )
    return joined.select(*[col(c) for c in kept], F.coalesce(col(out), nothing).alias(out))


def contaminated(match: Column, min_share: int = MIN_SHARE) -> Column:
    """Whether hit words are at least one in ``min_share``."""
    return (match["n_hit"] > 0) & (match["n_hit"] * min_share >= match["n_words"])


def drop_contaminated(docs: DataFrame, text_col: str, items: DataFrame, item_id: str, item_text: str, **limits) -> DataFrame:
    """The documents under the coverage limit, unchanged."""
    out = fresh(docs, "match")
    return find_contamination(docs, text_col, items, item_id, item_text, out, **limits).where(~contaminated(col(out))).drop(out)


def remove_spans(text: Column, match: Column, min_words: int = WINDOW, min_share: int = MIN_SHARE) -> Column:
    """The text without its hit spans of at least ``min_words`` words, or
    without all of them where the document is contaminated. What stands between
    words stays; a null text stays null."""

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans, everything in batches:
            out = []
            for data, found, every in zip(texts.to_pylist(), spans.to_pylist(), everything.to_pylist(), strict=True):
                if data is None:
                    out.append(None)
                    continue
                doomed = [s for s in found if every or s["end"] - s["start"] >= min_words]
                at = [m.span() for m in WORD.finditer(data.lower())] if doomed else []
                parts, end = [], 0
                for s in doomed:
                    parts.append(data[end : at[s["start"]][0]])
                    end = at[s["end"] - 1][1]
                out.append(str(b"".join([*parts, data[end:]]), "utf-8", "replace"))
            yield pa.array(out, pa.string())

    return cut(text.cast("string").cast("binary"), match["spans"], contaminated(match, min_share))
