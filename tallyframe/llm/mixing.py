"""Mixing sources to target weights by repeating or thinning whole documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.base import WORD, bounded_broadcast, fresh, saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix"
BROADCAST_SOURCES = 10_000
ADDED = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_rates(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times all sizes. No target exceeds ``most`` times
    its source; what is cut off goes to the others by weight. That fills all sources to one common level per unit of weight: with the
    sources sorted by the level at which each is full, a source is full if the level left for it and all later ones reaches that.
    The windows run over one row per source, which the aggregation has made before.
    """
    own = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = own.withColumn("turn", turn)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    weighed = weighed.withColumn("weight", weight)
    full = F.col("source_size") * most / F.col("weight")
    order = Window.orderBy("full", "turn")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    left = share * F.sum("source_size").over(all_rows) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    levels = weighed.withColumn("full", full).withColumn("level", left / F.sum("weight").over(after))
    common = F.max(F.when(F.col("full") > F.col("level"), F.col("level"))).over(all_rows)
    target = F.when(F.col("full") <= F.col("level"), (F.col("source_size") * most).cast("double")).otherwise(common * F.col("weight"))
    levels = levels.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return saved(levels.select("source", "source_size", "target", rate.alias("rate")), "rates")


def unit_draw(doc_id: Column, seed: str = SEED) -> Column:
    """Number from 0 up to 1 that depends on ``doc_id`` and ``seed`` alone: 48 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def with_copies(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``: how often the mix takes the document.

    A document is taken floor(rate) times, and once more if its own hashed draw is below the fraction of the rate, so the same rows give
    the same mix in any order and on any cluster.

    Null text has size 0. Null sources are one source, the last. Rows with the same ``doc_id``, null included, share their draw. A source
    of size 0 has rate 0, so its documents are not taken. An empty table gives an empty table. Columns of these four names are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ADDED])
    rates = source_rates(docs.select("source", word_count(F.col("text")).alias("size")), weights, share, most)
    key, rate = fresh(docs, "rate_source"), fresh(docs, "rate")
    rates = bounded_broadcast(rates.withColumnsRenamed({"source": key, "rate": rate}), BROADCAST_SOURCES)
    out = docs.withColumn("size", word_count(F.col("text"))).join(rates, docs["source"].eqNullSafe(rates[key]))
    extra = unit_draw(F.col("doc_id"), seed) < F.col(rate) - F.floor(rate)
    copies = (F.floor(rate) + F.when(extra, 1).otherwise(0)).cast("int")
    return out.withColumn("copies", copies).drop(key, rate)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``with_copies`` says, columns unchanged."""
    inner = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns if c.lower() in ADDED})
    copies = with_copies(inner, **options)
    taken = copies.withColumn(fresh(copies, "copy"), F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return taken.select(*[F.col(i).alias(c) for i, c in zip(inner.columns, docs.columns)])
