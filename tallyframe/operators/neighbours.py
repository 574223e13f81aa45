"""Mutual information between measured features and the outcome, from distances to nearest neighbours (Ross 2014).

For a row, d is the distance to its k-th neighbour of the same class, and m the number of rows of any class nearer than d, itself
included. With digamma p, the information is p(rows) + mean of p(k) - p(rows of the class) - p(m). Everything is ranks in sorted values,
and sorted values are cut into ranges and blocks, so no feature and no class of one is ever in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.sources.scratch import stored

NEIGHBOURS = 3
BLOCK = 20_000  # neighbouring rows of a class that one window looks at


def digamma(n: Column) -> Column:
    """Digamma of numbers from 1 on, to about 1e-13: the asymptotic series at ``n + 10``, stepped back."""
    y = n.cast("double") + 10
    series = F.ln(y) - 1 / (2 * y) - 1 / (12 * y**2) + 1 / (120 * y**4) - 1 / (252 * y**6) + 1 / (240 * y**8)
    return series - sum((1 / (n + i) for i in range(1, 10)), 1 / n.cast("double"))


def running_totals(rows: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``weight`` over the rows of the same ``keys`` that come before in ``order``.

    Rows are dealt by ranges of keys and order; each range adds up its own, and the totals of whole ranges before it are one row each.
    """
    part = "__part"
    dealt = stored(rows.repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id()), "ranges")
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    totals = dealt.groupBy(*keys, part).agg(F.sum(weight).alias("total"))
    before = until(Window.partitionBy(*keys).orderBy(part))
    offsets = totals.select(*keys, part, none(F.sum("total").over(before)).alias("offset"))
    inside = until(Window.partitionBy(*keys, part).orderBy(*order))
    counted = dealt.withColumn("inner", none(F.sum(weight).over(inside))).join(offsets, [*keys, part])
    return counted.withColumn(name, F.col("inner") + F.col("offset")).drop("inner", "offset", part)


def _reach(k: int) -> dict[str, Column]:
    """``d`` and the ends of the open interval of rows nearer than it; an end is a value where the k-th neighbour is one, else its mirror image."""
    x = F.col("value")
    left = [F.lit(0.0)] + [x - F.col(f"l{i}") for i in range(1, k + 1)]
    right = [F.lit(0.0)] + [F.col(f"r{i}") - x for i in range(1, k + 1)]
    # i neighbours to the left and the rest to the right; null if there are not so many
    ways = [
        F.when(F.col("k") == size, F.when(left[i].isNotNull() & right[size - i].isNotNull(), F.greatest(left[i], right[size - i])))
        for size in range(1, k + 1)
        for i in range(size + 1)
    ]
    d = F.col("d")
    low = F.coalesce(*[F.when(left[i] == d, F.col(f"l{i}")) for i in range(1, k + 1)], x - d)
    high = F.coalesce(*[F.when(right[i] == d, F.col(f"r{i}")) for i in range(1, k + 1)], x + d)
    return {"d": F.least(*ways), "low": low, "high": high}


def neighbour_distances(counts: DataFrame, neighbours: int = NEIGHBOURS, block: int = BLOCK) -> DataFrame:
    """(feature, label, value, n, ny, k, d, low, high) from ``counts`` (feature, value, label, n) of classes of two rows or more.

    ``k`` is ``neighbours``, or all others in smaller classes. Of rows with one value k + 1 are enough to know all distances. Rows are cut
    into blocks by their rank within the class, and blocks see the k rows beyond each end.
    """
    if not 0 < neighbours < block:
        raise ValueError("neighbours must be positive and fewer than the rows of a block")
    classes = counts.groupBy("feature", "label").agg(F.sum("n").alias("ny")).where("ny > 1")
    rows = counts.join(classes, ["feature", "label"]).withColumn("k", F.least(F.lit(neighbours), F.col("ny") - 1).cast("int"))
    rows = rows.withColumn("copies", F.least(F.col("n"), F.lit(neighbours + 1)))
    ranked = running_totals(rows, ["feature", "label"], ["value"], "copies", "rank")
    each = ranked.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))).withColumn("rank", F.col("rank") + F.col("copy"))
    home, place = F.floor(F.col("rank") / block), F.col("rank") % block
    beside = F.array_compact(F.array(home, F.when(place < neighbours, home - 1), F.when(place >= block - neighbours, home + 1)))
    seen = each.withColumn("home", home).withColumn("block", F.explode(beside))
    order = Window.partitionBy("feature", "label", "block").orderBy("rank")
    steps = range(1, neighbours + 1)
    near = {f"l{i}": F.lag("value", i).over(order) for i in steps} | {f"r{i}": F.lead("value", i).over(order) for i in steps}
    own = seen.withColumns(near).where("home = block AND copy = 0")
    ends = _reach(neighbours)
    return own.withColumn("d", ends.pop("d")).withColumns(ends).select("feature", "label", "value", "n", "ny", "k", "d", "low", "high")


def neighbour_information_from_counts(counts: DataFrame, neighbours: int = NEIGHBOURS, block: int = BLOCK) -> DataFrame:
    """(feature, mi) in nats from (feature, value, label, n): rows of a class are near each other where the feature tells them apart.

    Nothing is drawn at random. Ties go by rule: if the k-th neighbour has the same value, m counts the rows of that value; else m counts rows
    strictly nearer. Infinite values and classes of one row take no part.
    """
    counts = stored(counts.where(F.abs("value") < float("inf")), "value-counts")
    points = stored(neighbour_distances(counts, neighbours, block), "distances")
    values = points.groupBy("feature", F.col("value").alias("at")).agg(F.sum("n").alias("weight")).withColumn("kind", F.lit(1))
    same = F.col("d") == 0
    # kind 0 stands before the rows of an equal value, kind 2 after them
    mark = lambda end, at_same, apart, sign: F.struct(
        F.when(same, F.col("value")).otherwise(F.col(end)).alias("at"), F.when(same, at_same).otherwise(apart).alias("kind"), F.lit(sign).alias("sign")
    )
    marks = F.explode(F.array(mark("low", 0, 2, -1), mark("high", 2, 0, 1))).alias("mark")
    marked = points.select("feature", "label", "value", "n", "ny", "k", marks).select("*", "mark.*", F.lit(0).cast("long").alias("weight")).drop("mark")
    placed = running_totals(marked.unionByName(values, allowMissingColumns=True), ["feature"], ["at", "kind"], "weight", "below")
    inside = placed.where("kind <> 1").groupBy("feature", "label", "value", "n", "ny", "k").agg(F.sum(F.col("sign") * F.col("below")).alias("m"))
    n = F.col("n").cast("double")
    terms = digamma(F.col("k")) - digamma(F.col("ny")) - digamma(F.col("m"))
    sums = inside.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(n * terms).alias("sum"))
    return sums.select("feature", F.greatest(digamma(F.col("rows")) + F.col("sum") / F.col("rows"), F.lit(0.0)).alias("mi"))
