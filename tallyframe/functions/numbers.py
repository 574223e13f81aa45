"""Numeric column expressions.

Null is the only missing value inside the library: text that is not a number
and NaN both become null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


_NUMBER_START = r"(?i)^[\x00-\x20]*[+-]?(?:[0-9.]|inf|nan)"


def ref(name: str) -> Column:
    """Column reference that is safe for names holding dots or other punctuation."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def as_double(df: DataFrame, name: str) -> Column:
    """``name`` as a double; unreadable text and NaN become null."""
    kind = df.schema[name].dataType
    value = ref(name)
    if isinstance(kind, T.StringType):
        # a failed text cast raises inside the JVM, which is slow per row; only
        # text that starts like a number, NaN or Infinity is tried at all
        value = F.when(value.rlike(_NUMBER_START), value.try_cast("double"))
    elif not isinstance(kind, T.DoubleType):
        value = value.cast("double")
    if isinstance(kind, (T.StringType, T.FloatType, T.DoubleType)):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value


def doubles(df: DataFrame, names: Sequence[str], *keep: str) -> DataFrame:
    """Project ``names`` as doubles, plus the untouched columns in ``keep``."""
    return df.select(*map(ref, keep), *[as_double(df, n).alias(n) for n in names])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating-point column."""
    floating = (T.FloatType, T.DoubleType)
    return df.select(
        *[
            F.nanvl(ref(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, floating)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` in double arithmetic, null where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pair_correlation(x: Column, y: Column) -> Column:
    """Pearson correlation aggregate over pairwise-complete rows.

    Null when either side is constant, where the built-in aggregate divides by
    zero under ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    varies = (F.min(px) < F.max(px)) & (F.min(py) < F.max(py))
    return F.when(varies, F.try_divide(F.covar_samp(px, py), F.stddev_samp(px) * F.stddev_samp(py)))


def one_row_per_column(stats: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct in ``entries``."""
    return stats.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")
