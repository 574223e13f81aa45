"""Mutual information between coded features and the outcome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.numbers import as_double, ref
from tallyframe.operators.columns import ColumnStats, column_stats
from tallyframe.operators.neighbours import neighbour_information_from_counts

BINS = 50


def equal_width_bin(value: Column, low: float | None, high: float | None, bins: int = BINS) -> Column:
    """0-based bin of ``value`` among ``bins`` equal slices of ``[low, high]``."""
    if low is None or high is None or low == high:
        return F.when(value.isNotNull(), F.lit(0)).cast("int")
    place = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
    # greatest and least skip nulls, so the gap has to be kept explicitly
    return F.when(value.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(bins - 1), place))).cast("int")


def value_counts(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    *,
    binned: Mapping[str, tuple[float, float, int]] | None = None,
) -> DataFrame:
    """Rows per (feature, value, label), nulls of the feature left out.

    Columns named in ``binned`` are counted per equal-width bin: lower end, upper
    end and number of bins.  Every task adds up its own rows first, so a dominant
    value costs one shuffle row.
    """
    binned = binned or {}
    projected = [
        equal_width_bin(as_double(df, c), *binned[c]).cast("double").alias(c)
        if c in binned
        else as_double(df, c).alias(c)
        for c in columns
    ]
    return (
        df.select(ref(label).alias("__label"), *projected)
        .unpivot(["__label"], [ref(c) for c in columns], "feature", "value")
        .where("value IS NOT NULL AND __label IS NOT NULL")
        .groupBy("feature", "value", F.col("__label").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _n_ln_n(n: Column) -> Column:
    return n * F.ln(n)


def information_from_counts(counts: DataFrame) -> DataFrame:
    """Plug-in mutual information in nats from (feature, value, label, n).

    With n rows of a value and label, nv of a value, ny of a label and t in all,
    it is (S(n ln n) - S(nv ln nv) - S(ny ln ny) + t ln t) / t: sums of sums, so
    values are spread by hash and no feature is ever gathered.
    """
    n = F.col("n").cast("double")
    by_value = counts.groupBy("feature", "value").agg(F.sum(n).alias("nv"), F.sum(_n_ln_n(n)).alias("joint"))
    values = by_value.groupBy("feature").agg(
        F.sum("joint").alias("joint"), F.sum(_n_ln_n(F.col("nv"))).alias("values"), F.sum("nv").alias("t")
    )
    by_label = counts.groupBy("feature", "label").agg(F.sum(n).alias("ny"))
    labels = by_label.groupBy("feature").agg(F.sum(_n_ln_n(F.col("ny"))).alias("labels"))
    mi = (F.col("joint") - F.col("values") - F.col("labels") + _n_ln_n(F.col("t"))) / F.col("t")
    return values.join(labels, "feature").select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))


def mutual_information(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    continuous: Mapping[str, int] | Sequence[str] = (),
    measured: Sequence[str] = (),
    stats: ColumnStats | None = None,
) -> DataFrame:
    """(feature, mi, binned), most informative first.

    Every value of a feature is counted, however many there are, except for the
    features named in ``continuous``: these are cut into equal-width bins first,
    as many as the mapping says or ``BINS``.  ``binned`` tells which they are.
    Features named in ``measured`` are ranked by nearest neighbours instead.
    """
    near = [c for c in features if c in set(measured)]
    features = [c for c in features if c not in near]
    bins = dict(continuous) if isinstance(continuous, Mapping) else dict.fromkeys(continuous, BINS)
    bins = {c: n for c, n in bins.items() if c in features}
    if bins and stats is None:
        stats = column_stats(df, list(bins))
    ranges = {c: (stats.low[c], stats.high[c], n) for c, n in bins.items()}
    tables = [information_from_counts(value_counts(df, features, label, binned=ranges))] if features else []
    if near:
        tables.append(neighbour_information_from_counts(value_counts(df, near, label)))
    table = reduce(DataFrame.unionByName, tables)
    return table.withColumn("binned", F.col("feature").isin(*bins)).orderBy(F.desc("mi"), "feature")


def top_features(ranking: DataFrame, n: int = 10) -> DataFrame:
    return ranking.orderBy(F.desc("mi"), "feature").limit(n)
