"""Reuse of one intermediate result by several outputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def shared(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` while several outputs are computed from it, then
    release it. Blocks that do not fit in memory spill to local disk; a lost
    block is recomputed from the lineage."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
