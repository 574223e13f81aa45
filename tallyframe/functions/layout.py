"""Partition layout of inputs to heavy work."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import ref
from tallyframe.sources.scratch import stored

PARTITIONS = 64  # parts that training rows are dealt into, unless a larger table asks for more
PART_ROWS = 500_000  # most rows of a part, about: a part is what one task of a learner reads at once
SHARE_ROWS = 10_000  # most copies of a row that are made from one


def dealt(df: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """Rows dealt by a hash of all their cells into ``partitions``, sorted by it within each; into a multiple of ``partitions`` if
    there are more than ``PART_ROWS`` for each.

    Equal rows are counted first and their copies dealt round, as a table of a few codes has few different rows; each part makes its own
    copies. The layout depends on the rows and ``partitions`` alone, not on cores, files or the order of arrival, so an algorithm that
    draws rows by partition and position draws the same ones everywhere. Cells of -0.0 become 0.0.
    """
    cells = [ref(c) for c in df.columns]
    counted = stored(df.groupBy(*cells).agg(F.count(F.lit(1)).alias("__n")), "dealt")
    total = counted.agg(F.sum("__n")).first()[0] or 0
    parts = partitions * max(1, -(-total // (partitions * PART_ROWS)))
    n, share, shares = F.col("__n"), F.col("__share"), F.col("__shares")
    keyed = counted.withColumn("__key", F.xxhash64(F.to_json(F.struct(*cells))))
    keyed = keyed.withColumn("__shares", F.greatest(F.least(n, F.lit(parts)), F.ceil(n / SHARE_ROWS)))
    split = keyed.withColumn("__share", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)))
    part = F.pmod(F.pmod(F.col("__key"), F.lit(parts)) + share, F.lit(parts)).cast("int")
    placed = split.repartitionById(parts, part).sortWithinPartitions("__key", "__share")
    copies = F.expr("__n DIV __shares") + F.when(share < n % shares, 1).otherwise(0)
    return placed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*cells)


@contextmanager
def repeated(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept for a block that scans it several times; what does not fit in memory goes to disk."""
    rows = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()
