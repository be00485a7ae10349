"""Shuffle sizes that fit the data."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTING = "spark.sql.shuffle.partitions"
BYTES_PER_PARTITION = 128 << 20
# Beyond this many, partitions grow instead: Spark spills them, while the number of shuffle
# blocks, which is tasks times partitions, would become the problem.
MOST_PARTITIONS = 50_000


_LOCK = threading.Lock()
# What each session had set, and what the blocks that run now need.
_HELD: dict[SparkSession, tuple[str, list[int]]] = {}


@contextmanager
def shuffle_for(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Run jobs that shuffle about `size` bytes of files with enough partitions.

    The session's own setting is the least; adaptive execution joins partitions that turn
    out small. Blocks of several threads share a session: the largest need holds for all.
    """
    needed = min(-(-(size or 0) // BYTES_PER_PARTITION), MOST_PARTITIONS)

    def hold(before: str, needs: list[int]) -> None:
        spark.conf.set(SETTING, str(max(int(before), *needs)) if needs else before)

    with _LOCK:
        before, needs = _HELD.setdefault(spark, (spark.conf.get(SETTING), []))
        needs.append(needed)
        hold(before, needs)
    try:
        yield
    finally:
        with _LOCK:
            needs.remove(needed)
            hold(before, needs)
            if not needs:
                del _HELD[spark]
