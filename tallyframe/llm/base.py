"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import sys
import types

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.scratch import scratch_dir

BLANKS = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
WORD = r"[^\x20\x09-\x0D]+"


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20  # of rows that go to a Python worker at once, while a table is saved


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: lineage ends here, and lost executors lose nothing."""
    spark = df.sparkSession
    path, before = scratch_dir(spark, purpose), spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition under which null equals null."""
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def bounded_broadcast(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows; beyond that Spark shuffles. ``df`` must be cheap to count."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, most_rows: int = 500_000, share: int = 1000) -> DataFrame:
    """``rows`` left-joined with ``groups``, which has one row per key and, in ``size``, about how many of the ``total`` rows have it.

    Up to ``most_rows`` groups go to all tasks. Of more, only those of keys that over one in ``share`` of the rows have, ``share`` at most,
    go to all tasks; the other rows and groups meet in a shuffle, so no key gathers more than its ``share`` in one task. Keys are not null.
    """
    if groups.limit(most_rows + 1).count() <= most_rows:
        return rows.join(F.broadcast(groups), keys, "left")
    often = F.col(size) * share > total
    hot = F.broadcast(groups.where(often))
    far = rows.join(hot, keys, "left_anti").join(groups.where(~often), keys, "left")
    return rows.join(hot, keys).unionByName(far)


def among_first(key: Column, wanted: int, rows: Column) -> Column:
    """Whether a hashed key, even over all longs, may be among the ``wanted`` least of ``rows``: true for about twice as many.

    Filters a table before its least keys are picked, so that tasks do not each send ``wanted`` rows to one. That fewer than ``wanted``
    pass has a probability of less than 1e-20.
    """
    return (key.cast("double") / float(1 << 63) + 1) / 2 * rows <= 2 * wanted + 200


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def release_memory() -> None:
    """Give memory that a task has freed back to the system, as an idle Python worker would hold it beside the next stage's workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library of Linux
    if trim is not None:
        trim(0)


def worker_state(name: str) -> dict:
    """A dict that a Python worker keeps between its tasks. Only for caches: any task may find it empty."""
    home = sys.modules.setdefault("tallyframe_worker_state", types.ModuleType("tallyframe_worker_state"))
    return home.__dict__.setdefault(name, {})
