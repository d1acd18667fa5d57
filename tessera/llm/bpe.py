"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read on the driver, its size is checked, and its bytes are
broadcast; each Python worker builds one encoder from them. Long texts are cut
at safe boundaries, where the split pattern always ends a match whatever
follows, so the pieces' ids joined are the ids of the whole text, and memory
and the regex engine's stack stay bounded.

Safe boundaries (the pattern's matches are runs of letters, of digits or of
other characters, each with one space before it at most, contractions, and
runs of white space): after a character that is no white space and before a
white space; from a letter to a digit or other character; from a digit to a
letter or other character. A match without any such place in it (one huge run)
is found by the ``regex`` module and encoded alone.

Defined results: a null text counts as empty (no ids); bytes that are no UTF-8
are read as U+FFFD; documents are independent, so repeated rows repeat.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_file, utf8

# Texts longer than this many characters are cut at the next safe boundary.
PIECE_CHARS = 32_768

SAFE_BOUNDARY = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")


def load_encoder(rank_file: bytes, pattern: str):
    """A tiktoken encoder from the bytes of a rank file, without special tokens."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in rank_file.splitlines() if line)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut at safe boundaries
    only; a piece is longer where there is none."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_BOUNDARY.search(text, start + size)
        if cut is None or cut.start() >= len(text):
            break
        yield text[start : cut.start()]
        start = cut.start()
    if start < len(text) or not text:
        yield text[start:]


def encode(encoder, splitter, text: str, size: int = PIECE_CHARS) -> np.ndarray:
    """The ids of a whole text as little-endian unsigned 32-bit integers."""
    if len(text) <= size:
        return encoder.encode_to_numpy(text).astype("<u4", copy=False)
    parts = []
    for piece in safe_pieces(text, size):
        if len(piece) <= 2 * size:
            parts.append(encoder.encode_to_numpy(piece))
        else:
            for match in splitter.finditer(piece):
                parts.append(np.array(encoder._encode_single_piece(match.group()), "<u4"))
    return np.concatenate(parts).astype("<u4", copy=False)


def encode_column(text: Column, ranks: Broadcast, pattern: str, size: int = PIECE_CHARS) -> Column:
    """The ids of a text as ``array<int>``."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, splitter = load_encoder(ranks.value, pattern), regex.compile(pattern)
        for batch in batches:
            yield pa.array(
                [encode(encoder, splitter, str(b.as_py(), "utf-8", "replace"), size).astype(np.int32) for b in batch],
                pa.list_(pa.int32()),
            )

    return ids(utf8(text))


def decode_column(ids: Column, ranks: Broadcast, pattern: str) -> Column:
    """The bytes that ids stand for; they need not be whole characters. A null
    array gives null."""

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load_encoder(ranks.value, pattern)
        for batch in batches:
            yield pa.array([None if (v := b.as_py()) is None else encoder.decode_bytes(v) for b in batch], pa.binary())

    return raw(ids)


def round_trip_column(text: Column, ranks: Broadcast, pattern: str, size: int = PIECE_CHARS, with_ids: bool = False) -> Column:
    """Encode, then decode the ids: a struct of n_tokens, ids_sha256 and
    decoded_sha256, and with ``with_ids`` the ids; else they stay in the worker."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, splitter = load_encoder(ranks.value, pattern), regex.compile(pattern)
        for batch in batches:
            counts, id_hashes, text_hashes, kept = [], [], [], []
            for b in batch:
                ids = encode(encoder, splitter, str(b.as_py(), "utf-8", "replace"), size)
                counts.append(len(ids))
                id_hashes.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_hashes.append(hashlib.sha256(encoder.decode_bytes(ids.tolist())).hexdigest())
                if with_ids:
                    kept.append(ids.astype(np.int32))
            columns = [pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return digests(utf8(text))


def rank_file(spark: SparkSession, path: str) -> Broadcast:
    """The rank file's bytes, broadcast behind a check of their size."""
    return broadcast_file(spark, path)
