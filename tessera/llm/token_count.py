"""Token counts with the tokenizers library; huge documents in overlapping chunks.

* **Huge documents** (over ``HUGE_CHARS``) are encoded in overlapping chunks
  with offsets. Two neighbouring chunks are spliced at a token that both begin
  at the same character and that follows a stable boundary: the beginning of a
  blank that stands before a character that is no white space, where the
  split pattern always begins a match, whatever stands left or right. Where the
  overlap holds no such place the overlap is doubled, up to the whole rest.
* **Other documents** are sums over the units between those same boundaries.
  Each distinct unit of a batch is encoded once by the library (many units in
  one call, told apart by the token that begins with the blank) and its count is
  kept in a memo of bounded size. Documents in which blanks meet other white
  space are encoded whole.
* The library takes special tokens' strings out first and encodes what stands
  between them separately; so does this.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special
strings inside texts count as the library's default has them; bytes that are no
UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.llm.common import utf8

HUGE_CHARS = 65_536
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
MEMO_UNITS = 400_000
MISS_CHARS = 16_384
GROUP_CHARS = 1_000_000

UNSTABLE_BLANK = re.compile(r" (?:\s|\Z)")
STABLE_BLANK = re.compile(r" (?=\S)")


class TokenCounter:
    """Counts tokens with one tokenizer; one object per Python worker."""

    def __init__(self, tokenizer_json: bytes, huge=HUGE_CHARS, chunk=CHUNK_CHARS, overlap=OVERLAP_CHARS, memo=MEMO_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task: Spark spreads the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(tokenizer_json)
        added = spec.get("added_tokens", [])
        self.special = re.compile("|".join(sorted((re.escape(t["content"]) for t in added), key=len, reverse=True)) or r"(?!)")
        # Stable boundaries are proven for the byte-level split pattern and plain special tokens only.
        pre = spec.get("pre_tokenizer") or {}
        self.stable = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and spec.get("normalizer") is None
        self.stable &= not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        vocabulary = self.tokenizer.get_vocab()
        self.blank_first = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.blank_first[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.huge, self.chunk, self.overlap, self.memo_units = huge, chunk, overlap, memo
        self.memo: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def counts(self, texts: list[str]) -> list[int]:
        """The token count of each text."""
        if not self.stable:
            return [self.whole(text) for text in texts]
        out = [0] * len(texts)
        units: list[tuple[int, str, list[str]]] = []
        for i, text in enumerate(texts):
            segments = self.special.split(text)
            out[i] = len(segments) - 1
            for segment in segments:
                if len(segment) > self.huge:
                    out[i] += self.spliced(segment)
                elif UNSTABLE_BLANK.search(segment):
                    out[i] += self.whole(segment)
                elif segment:
                    first, *rest = segment.split(" ")
                    units.append((i, first, rest))
        self.learn(set().union(*(rest for _, _, rest in units)) - self.memo.keys())
        for i, first, rest in units:
            out[i] += self.whole(first) + sum(map(self.memo.__getitem__, rest))
        if len(self.memo) > self.memo_units:
            self.memo.clear()
        return out

    def learn(self, missing: set[str]) -> None:
        """Encode units, each after a blank, and keep their counts."""
        units = list(missing)
        groups, size = [[]], 0
        for u in units:
            if size > MISS_CHARS:
                groups.append([])
                size = 0
            groups[-1].append(u)
            size += len(u) + 1
        texts = [" " + " ".join(g) for g in groups if g]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for group, e in zip(groups, encoded, strict=False):
            ids = np.array(e.ids)
            begins = np.flatnonzero(self.blank_first[ids])
            if len(begins) != len(group):
                raise AssertionError("a unit must begin with exactly one blank")
            self.memo.update(zip(group, np.diff(begins, append=len(ids)).tolist(), strict=True))

    def spliced(self, text: str) -> int:
        """Overlapping chunks, spliced where both encodings begin a token at a
        stable boundary of their overlap."""
        total, start = 0, 0  # tokens of text[:start] are counted; start is a splice point
        while True:
            end = start + self.chunk
            overlap = self.overlap
            while True:
                left_end = min(len(text), end + overlap)
                left = self.begins(text, start, left_end)
                if left_end == len(text):
                    return total + len(left)
                both = set(left).intersection(self.begins(text, end, min(len(text), left_end + overlap)))
                place = next((m.start() for m in STABLE_BLANK.finditer(text, end + 1, left_end) if m.start() in both), None)
                if place is not None:
                    total += sum(1 for at in left if at < place)
                    start = place
                    break
                overlap *= 2

    def begins(self, text: str, start: int, end: int) -> list[int]:
        """Where each token of text[start:end] begins, in the whole text."""
        return [start + a for a, _ in self.tokenizer.encode(text[start:end], add_special_tokens=False).offsets]


def count_column(text: Column, tokenizer_json: Broadcast, limit: int, **options: int) -> Column:
    """A struct of n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""

    @F.arrow_udf("n_bytes long, n_tokens long, over_limit boolean")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = TokenCounter(tokenizer_json.value, **options)
        for batch in batches:
            sizes, tokens, group, held = [], [], [], 0
            for b in batch:  # units of one group are in memory at a time, not those of a batch
                text = str(b.as_py(), "utf-8", "replace")
                sizes.append(len(b.as_py()))
                group.append(text)
                held += len(text)
                if held > GROUP_CHARS:
                    tokens += counter.counts(group)
                    group, held = [], 0
            n = np.array(tokens + counter.counts(group), np.int64)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(n), pa.array(n > limit)], names=["n_bytes", "n_tokens", "over_limit"]
            )

    return counts(utf8(text))
