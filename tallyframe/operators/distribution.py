"""Distribution summaries behind histogram, density, box and scatter charts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.numbers import as_double, doubles, numeric_columns, ref
from tallyframe.operators.columns import column_stats
from tallyframe.operators.information import BINS, equal_width_bin
from tallyframe.operators.quantiles import EXACT_ROWS, exact_quantiles, midpoint_rank

GRID = 200
# Rows handled at once against the whole grid inside one task.
_DENSITY_CHUNK = 512


def _by_key(values: dict, key: str) -> Column:
    """Constant per column, looked up by the value of ``key``."""
    return F.element_at(F.create_map(*[F.lit(v) for item in values.items() for v in item]), F.col(key))


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = BINS) -> DataFrame:
    """Rows per equal-width bin and column; bins without rows are left out.

    One scan finds the ranges, a second counts; each task sends one row per
    filled bin.
    """
    names = list(columns or numeric_columns(df))
    stats = column_stats(df, names)
    names = [c for c in names if stats.non_null[c]]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, bin int, low double, high double, n bigint")
    places = [equal_width_bin(as_double(df, c), stats.low[c], stats.high[c], bins).alias(c) for c in names]
    counted = (
        df.select(*places)
        .unpivot([], [ref(c) for c in names], "column", "bin")
        .where("bin IS NOT NULL")
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low = _by_key({c: float(stats.low[c]) for c in names}, "column")
    high = _by_key({c: float(stats.high[c]) for c in names}, "column")
    width = (high - low) / F.lit(float(bins))
    return counted.select(
        "column",
        "bin",
        (low + F.col("bin") * width).alias("low"),
        F.when(low == high, high).otherwise(low + (F.col("bin") + 1) * width).alias("high"),
        "n",
    )


def _density_sums(shapes: dict[int, tuple[float, float, float]], points: int):
    """Per-task kernel sums on each column's grid; rows are (c, value, weight).

    ``shapes`` maps a column number to the start and step of its grid and its
    bandwidth.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, rows in batch.groupby("c", sort=False):
                low, step, bandwidth = shapes[c]
                grid = low + step * np.arange(points)
                total = totals.setdefault(c, np.zeros(points))
                value, weight = rows["value"].to_numpy(), rows["weight"].to_numpy()
                for start in range(0, len(value), _DENSITY_CHUNK):
                    part = slice(start, start + _DENSITY_CHUNK)
                    z = (grid[None, :] - value[part, None]) / bandwidth
                    total += weight[part] @ np.exp(-0.5 * z * z)
        for c, total in totals.items():
            yield pd.DataFrame({"c": np.int32(c), "point": np.arange(points, dtype="int32"), "s": total})

    return run


def kde(df: DataFrame, columns: Sequence[str], points: int = GRID) -> DataFrame:
    """Gaussian kernel density per column on an even grid from minimum to maximum.

    Bandwidth is the sample deviation times ``n ** (-1/5)``.  Rows are counted per
    value first, which also deals the kernel sums over all tasks; after that only
    ``points`` rows per column and task move.  Every row contributes to every grid point, nothing is binned or cut off.
    Constant columns have no density and are left out.
    """
    names = list(columns)
    data = doubles(df, names)
    figures = {"n": F.count, "lo": F.min, "hi": F.max, "s": F.stddev_samp}
    row = data.agg(
        *[figure(ref(c)).alias(f"{key}{i}") for i, c in enumerate(names) for key, figure in figures.items()]
    ).first()

    shapes, scales = {}, {}
    for i in range(len(names)):
        n, low, high, deviation = (row[f"{key}{i}"] for key in ("n", "lo", "hi", "s"))
        if n and deviation:
            bandwidth = deviation * n**-0.2
            shapes[i] = (low, (high - low) / (points - 1), bandwidth)
            scales[i] = 1.0 / (n * bandwidth * math.sqrt(2.0 * math.pi))
    if not shapes:
        return df.sparkSession.createDataFrame([], "column string, point int, x double, density double")

    numbered = data.select(*[ref(names[i]).alias(str(i)) for i in shapes])
    cells = numbered.unpivot([], [str(i) for i in shapes], "c", "value").where("value IS NOT NULL")
    counted = cells.groupBy(F.col("c").cast("int").alias("c"), "value").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    sums = counted.mapInPandas(_density_sums(shapes, points), "c int, point int, s double")

    return (
        sums.groupBy("c", "point")
        .agg(F.sum("s").alias("s"))
        .select(
            _by_key({i: names[i] for i in shapes}, "c").alias("column"),
            "point",
            (
                _by_key({i: low for i, (low, _, _) in shapes.items()}, "c")
                + F.col("point") * _by_key({i: step for i, (_, step, _) in shapes.items()}, "c")
            ).alias("x"),
            (F.col("s") * _by_key(scales, "c")).alias("density"),
        )
    )


def kde_binned(df: DataFrame, columns: Sequence[str], points: int = GRID, tolerance: float = 1e-4, max_bins: int = 1 << 20) -> DataFrame:
    """(column, point, x, density, error_bound): as ``kde``, with rows counted in fine bins first, whatever the number of different values.

    A row adds to the two bin ends beside it by its nearness, which replaces the kernel by its linear interpolation between bin ends: with
    bins of width d the density is wrong by at most d^2 / 8 times the largest curvature of the kernel, 1 / (sqrt(2 pi) h^3).  That is
    ``error_bound``.  Bins are as wide as ``tolerance`` times the kernel's peak allows, but at most about ``max_bins`` in number; the bound says what
    that costs.  Bins are convolved with the kernel by Fourier transform, a column in a task.
    """
    names = list(columns)
    data = doubles(df, names)
    figures = {"n": F.count, "lo": F.min, "hi": F.max, "s": F.stddev_samp}
    row = data.agg(*[figure(ref(c)).alias(f"{key}{i}") for i, c in enumerate(names) for key, figure in figures.items()]).first()
    shapes = {}
    for i in range(len(names)):
        n, low, high, deviation = (row[f"{key}{i}"] for key in ("n", "lo", "hi", "s"))
        if n and deviation:
            bandwidth, step = deviation * n**-0.2, (high - low) / (points - 1)
            parts = min(max(math.ceil(step / (bandwidth * math.sqrt(8 * tolerance))), 1), max(max_bins // (points - 1), 1))
            shapes[i] = (low, step, bandwidth, parts, n)
    if not shapes:
        return df.sparkSession.createDataFrame([], "column string, point int, x double, density double, error_bound double")

    numbered = data.select(*[ref(names[i]).alias(str(i)) for i in shapes])
    cells = numbered.unpivot([], [str(i) for i in shapes], "c", "value").where("value IS NOT NULL").withColumn("c", F.col("c").cast("int"))
    place = (F.col("value") - _by_key({i: x[0] for i, x in shapes.items()}, "c")) / _by_key({i: x[1] / x[3] for i, x in shapes.items()}, "c")
    last = _by_key({i: float((points - 1) * x[3] - 1) for i, x in shapes.items()}, "c")
    bins = cells.withColumn("place", place).withColumn("bin", F.greatest(F.least(F.floor("place").cast("double"), last), F.lit(0.0)).cast("int"))
    bins = bins.groupBy("c", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("place") - F.col("bin")).alias("beyond"))

    def smoothed(rows: pd.DataFrame) -> pd.DataFrame:
        c = int(rows["c"].iloc[0])
        low, step, bandwidth, parts, n = shapes[c]
        size, width = (points - 1) * parts + 1, step / parts
        weight = np.zeros(size)
        at, count, beyond = (rows[k].to_numpy() for k in ("bin", "n", "beyond"))
        np.add.at(weight, at, count - beyond)
        np.add.at(weight, at + 1, beyond)
        kernel = np.exp(-0.5 * (width / bandwidth * np.arange(size)) ** 2)
        length = 1 << (2 * size - 1).bit_length()
        around = np.zeros(length)
        around[:size] = kernel
        around[length - size + 1 :] = kernel[:0:-1]
        sums = np.fft.irfft(np.fft.rfft(weight, length) * np.fft.rfft(around), length)[:size:parts]
        scale = 1.0 / (n * bandwidth * math.sqrt(2.0 * math.pi))
        bound = (width / bandwidth) ** 2 / 8 / (bandwidth * math.sqrt(2.0 * math.pi))
        point = np.arange(points, dtype="int32")
        return pd.DataFrame({"column": names[c], "point": point, "x": low + point * step, "density": np.maximum(sums, 0.0) * scale, "error_bound": bound})

    return bins.groupBy("c").applyInPandas(smoothed, "column string, point int, x double, density double, error_bound double")


def box_stats(df: DataFrame, columns: Sequence[str], *, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Quartiles, whiskers at the last value inside 1.5 interquartile ranges, outlier count."""
    names = list(columns)
    data = doubles(df, names)
    fences = _quartiles_and_fences(data, names, exact_rows)
    names = [c for c in names if c in fences]
    schema = (
        "column string, q1 double, median double, q3 double, "
        "lower_whisker double, upper_whisker double, outliers bigint"
    )
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    aggregates = []
    for i, c in enumerate(names):
        (q1, _, q3), (low, high) = fences[c]
        v = ref(c)
        aggregates += [
            F.least(F.lit(q1), F.min(F.when(v >= low, v))).alias(f"lo{i}"),
            F.greatest(F.lit(q3), F.max(F.when(v <= high, v))).alias(f"hi{i}"),
            F.count_if((v < low) | (v > high)).alias(f"out{i}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(fences[c][0][0]).alias("q1"),
            F.lit(fences[c][0][1]).alias("median"),
            F.lit(fences[c][0][2]).alias("q3"),
            F.col(f"lo{i}").alias("lower_whisker"),
            F.col(f"hi{i}").alias("upper_whisker"),
            F.col(f"out{i}").alias("outliers"),
        )
        for i, c in enumerate(names)
    ]
    stats = data.agg(*aggregates)
    return stats.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def box_outliers(df: DataFrame, column: str, *, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """All rows whose value lies outside the fences of ``column``."""
    fences = _quartiles_and_fences(doubles(df, [column]), [column], exact_rows)
    if not fences:
        return df.limit(0)
    low, high = fences[column][1]
    value = as_double(df, column)
    return df.where((value < low) | (value > high))


def _quartiles_and_fences(data: DataFrame, names: list[str], exact_rows: int):
    found = exact_quantiles(data, names, [0.25, 0.5, 0.75], rank=midpoint_rank, exact_rows=exact_rows)
    result = {}
    for c in names:
        if found[c][0] is not None:
            q1, _, q3 = found[c]
            reach = 1.5 * (q3 - q1)
            result[c] = (found[c], (q1 - reach, q3 + reach))
    return result


def scatter_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """Both values of every row that has both."""
    return df.select(as_double(df, x).alias("x"), as_double(df, y).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")


def scatter_sample(df: DataFrame, x: str, y: str, size: int, by: Sequence[str] = ()) -> DataFrame:
    """Points to draw: the ``size`` rows of least hash among those that have both values, with the hash.

    The hash is the MD5 of the columns in ``by`` as texts with commas between (null as nothing), of both values if there are none.  So the points
    depend on the rows alone, not on partitions or retries, and samples of parts merge: the least of all are among the least of each part.
    Rows of one hash go by their values.
    """
    texts = [F.coalesce(ref(c).cast("string"), F.lit("")) for c in by or (x, y)]
    points = df.select(as_double(df, x).alias("x"), as_double(df, y).alias("y"), F.md5(F.concat_ws(",", *texts).cast("binary")).alias("hash"))
    return points.where("x IS NOT NULL AND y IS NOT NULL").orderBy("hash", "x", "y").limit(size)


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = BINS) -> DataFrame:
    """Points per cell of an even ``bins`` by ``bins`` grid, for tables too large to draw."""
    points = scatter_points(df, x, y)
    stats = column_stats(points)
    return (
        points.select(
            equal_width_bin(F.col("x"), stats.low["x"], stats.high["x"], bins).alias("x_bin"),
            equal_width_bin(F.col("y"), stats.low["y"], stats.high["y"], bins).alias("y_bin"),
        )
        .groupBy("x_bin", "y_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ols_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``: slope, intercept, fit and point count."""
    points = scatter_points(df, x, y)
    return points.agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def ols_fitted(df: DataFrame, x: str, y: str) -> DataFrame:
    """Points with the fitted value of the trend line."""
    line = ols_trend(df, x, y).first()
    points = scatter_points(df, x, y)
    if line["slope"] is None:
        return points.withColumn("fitted", F.lit(None).cast("double"))
    return points.withColumn("fitted", F.lit(line["intercept"]) + F.lit(line["slope"]) * F.col("x"))
