"""Pairwise-complete Pearson correlation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import as_double, doubles, numeric_columns, pair_correlation
from tallyframe.operators.quantiles import means

_SUMS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double, xl double, xh double, yl double, yh double"


def pair_corr(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of two columns, one aggregate."""
    return df.agg(pair_correlation(as_double(df, x), as_double(df, y)).alias("r"))


def _cross_sums(centre: np.ndarray):
    """Per-task pair sums by matrix products; every task emits one row per pair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(centre)
        n, sx, sxx, sxy = (np.zeros((k, k)) for _ in range(4))
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for batch in batches:
            values = batch.to_numpy(dtype="float64", na_value=np.nan) - centre
            filled = ~np.isnan(values)
            values = np.where(filled, values, 0.0)
            mask = filled.astype("float64")
            n += mask.T @ mask
            sx += values.T @ mask
            sxx += (values * values).T @ mask
            sxy += values.T @ values
            for other in range(k):
                both = filled & filled[:, [other]]
                low[:, other] = np.minimum(low[:, other], np.where(both, values, np.inf).min(axis=0, initial=np.inf))
                high[:, other] = np.maximum(high[:, other], np.where(both, values, -np.inf).max(axis=0, initial=-np.inf))
        i, j = np.triu_indices(k)
        yield pd.DataFrame(
            {
                "i": i.astype("int32"),
                "j": j.astype("int32"),
                "n": n[i, j],
                "sx": sx[i, j],
                "sy": sx[j, i],
                "sxx": sxx[i, j],
                "syy": sxx[j, i],
                "sxy": sxy[i, j],
                "xl": low[i, j],
                "xh": high[i, j],
                "yl": low[j, i],
                "yh": high[j, i],
            }
        )

    return run


def corr_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Upper triangle, diagonal included: (i, j, feature_1, feature_2, n, r).

    Columns are centred on their means first, so sums of products keep their
    digits for values far from zero.  The data is never shuffled: only one row
    per pair and task is.
    """
    names = list(columns or numeric_columns(df))
    data = doubles(df, names)
    centre = means(data, names)
    shift = np.array([centre[c] if centre[c] is not None else 0.0 for c in names])
    sums = (
        data.toDF(*[f"c{i}" for i in range(len(names))])
        .mapInPandas(_cross_sums(shift), _SUMS)
        .groupBy("i", "j")
        .agg(
            *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")],
            *[F.min(c).alias(c) for c in ("xl", "yl")],
            *[F.max(c).alias(c) for c in ("xh", "yh")],
        )
    )
    n = F.col("n")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    # constant is what has one value in the rows of the pair, as in pair_correlation
    varies = (F.col("xl") < F.col("xh")) & (F.col("yl") < F.col("yh")) & (vx > 0) & (vy > 0)
    cov = n * F.col("sxy") - F.col("sx") * F.col("sy")
    r = F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy))
    # rounding can leave r just outside its range
    r = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    labels = F.array(*map(F.lit, names))
    return sums.select(
        "i",
        "j",
        F.element_at(labels, F.col("i") + 1).alias("feature_1"),
        F.element_at(labels, F.col("j") + 1).alias("feature_2"),
        n.cast("bigint").alias("n"),
        r.alias("r"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full matrix in long form: one row per ordered pair of columns."""
    upper = corr_pairs(df, columns)
    both = F.when(
        F.col("i") == F.col("j"), F.array(F.struct("feature_1", "feature_2"))
    ).otherwise(
        F.array(
            F.struct("feature_1", "feature_2"),
            F.struct(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2")),
        )
    )
    return upper.select(F.explode(both).alias("pair"), "n", "r").select("pair.*", "n", "r")


def top_correlations(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """Pairs of different columns with the largest absolute correlation."""
    return (
        corr_pairs(df, columns)
        .where("i < j")
        .orderBy(F.desc_nulls_last(F.abs("r")), "i", "j")
        .limit(n)
        .select("feature_1", "feature_2", "r")
    )
