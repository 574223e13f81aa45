"""Projection, filter and column-dropping rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyframe.functions.numbers import as_double, doubles, nan_to_null, ref
from tallyframe.spec import SurveySpec


def require_target(df: DataFrame, spec: SurveySpec) -> DataFrame:
    if spec.target not in df.columns:
        raise ValueError(f"target column {spec.target!r} is missing")
    return df


def require_features(df: DataFrame, spec: SurveySpec) -> list[str]:
    names = [c for c in df.columns if c != spec.target]
    if not names:
        raise ValueError("no feature column is left")
    return names


def project_columns(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Allow-listed columns that are present, in allow-list order."""
    return require_target(df.select(*map(ref, spec.present(df.columns))), spec)


def drop_non_numeric(df: DataFrame) -> DataFrame:
    """Keep numeric columns, turn booleans into doubles, drop everything else."""
    kept = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            kept.append(ref(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            kept.append(ref(f.name).cast("double").alias(f.name))
    return df.select(*kept)


def cast_double(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast to double without failing on bad text; other columns pass through."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[as_double(df, c).alias(c) if c in chosen else ref(c) for c in df.columns]
    )


def _recoded(raw: Column, spec: SurveySpec) -> Column:
    """All codes are replaced at once; a code is never replaced twice."""
    coded = F
    for old, new in spec.recode.items():
        coded = coded.when(raw == F.lit(float(old)), F.lit(float(new)))
    return coded.otherwise(raw) if spec.recode else raw


def recode_target(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Apply the outcome coding; unknown codes become null, rows are kept."""
    raw = as_double(require_target(df, spec), spec.target)
    coded = _recoded(raw, spec)
    if spec.unknown:
        coded = F.when(~raw.isin(*map(float, spec.unknown)), coded)
    return df.withColumn(spec.target, coded)


def label_filter(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Rows with a known outcome, recoded.

    The filter names the stored column once and in plain terms, so it reaches a
    parquet scan; null codes fail the ``NOT IN`` test like unknown ones.
    """
    kind = require_target(df, spec).schema[spec.target].dataType
    raw = as_double(df, spec.target)
    if isinstance(kind, T.NumericType):
        stored = ref(spec.target)
        known = ~stored.isin(*spec.unknown) if spec.unknown else stored.isNotNull()
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            known = known & ~F.isnan(stored)
    else:
        known = ~raw.isin(*map(float, spec.unknown)) if spec.unknown else raw.isNotNull()
    return df.where(known).withColumn(spec.target, _recoded(raw, spec))


def label_int(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Outcome rounded half to even and stored as an integer."""
    return df.withColumn(spec.target, F.bround(ref(spec.target)).cast("int"))


def rename_label(df: DataFrame, spec: SurveySpec, label: str = "label") -> DataFrame:
    return df.withColumnRenamed(spec.target, label)


@dataclass(frozen=True)
class ColumnStats:
    """Row count plus non-null count, minimum, maximum and wholeness per column."""

    rows: int
    non_null: Mapping[str, int]
    low: Mapping[str, float | None]
    high: Mapping[str, float | None]
    whole: Mapping[str, bool | None] = field(default_factory=dict)

    def missing_pct(self, name: str) -> float:
        return 100.0 * (self.rows - self.non_null[name]) / self.rows if self.rows else 0.0

    def is_constant(self, name: str) -> bool:
        """One distinct value, null counting as a value."""
        filled = self.non_null[name]
        if filled == 0:
            return self.rows > 0
        return filled == self.rows and self.low[name] == self.high[name]

    def is_coded(self, name: str, max_codes: int) -> bool:
        """Whole numbers within a range of at most ``max_codes`` values."""
        return bool(self.whole.get(name)) and self.high[name] - self.low[name] < max_codes

    def sparse(self, names: Sequence[str], max_missing_pct: float) -> list[str]:
        return [n for n in names if self.missing_pct(n) > max_missing_pct]


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStats:
    """Collect :class:`ColumnStats` with one aggregate over one scan.

    Count, minimum and maximum decide both sparse and constant columns, so no
    distinct and no shuffle of values is needed: one row leaves each task.
    """
    names = list(df.columns if columns is None else columns)
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(names):
        value = ref(name)
        aggregates += [
            F.count(value).alias(f"c{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
            F.bool_and(value == F.rint(value)).alias(f"w{i}"),
        ]
    row = doubles(df, names).agg(*aggregates).first()
    return ColumnStats(
        rows=row["n"],
        non_null={name: row[f"c{i}"] for i, name in enumerate(names)},
        low={name: row[f"lo{i}"] for i, name in enumerate(names)},
        high={name: row[f"hi{i}"] for i, name in enumerate(names)},
        whole={name: row[f"w{i}"] for i, name in enumerate(names)},
    )


def column_decisions(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """One row per column: how many cells are filled and whether the column stays."""
    rows = F.count(F.lit(1))
    entries = []
    for name in df.columns:
        value = as_double(df, name)
        filled = F.count(value)
        missing = F.coalesce(100.0 * (rows - filled).cast("double") / F.nullif(rows, F.lit(0)), F.lit(0.0))
        constant = (rows > 0) & (
            (filled == 0) | ((filled == rows) & (F.min(value) == F.max(value)))
        )
        protected = F.lit(name == spec.target)
        sparse = missing > spec.max_missing_pct
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                filled.alias("non_null"),
                missing.alias("missing_pct"),
                F.coalesce(constant, F.lit(False)).alias("is_constant"),
                (protected | ~(sparse | F.coalesce(constant, F.lit(False)))).alias("kept"),
            )
        )
    return df.agg(F.array(*entries).alias("all")).select(F.explode("all").alias("e")).select("e.*")


def drop_sparse(df: DataFrame, spec: SurveySpec, stats: ColumnStats | None = None) -> DataFrame:
    """Drop columns with more than the allowed share of missing cells."""
    stats = stats or column_stats(df)
    gone = set(stats.sparse(df.columns, spec.max_missing_pct)) - {spec.target}
    return df.select(*[ref(c) for c in df.columns if c not in gone])


def drop_constant(df: DataFrame, spec: SurveySpec, stats: ColumnStats | None = None) -> DataFrame:
    """Drop columns holding one value; the target is never dropped."""
    stats = stats or column_stats(df)
    return df.select(
        *[ref(c) for c in df.columns if c == spec.target or not stats.is_constant(c)]
    )


def fill_missing(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Replace nulls by the given value per column; the columns become doubles."""
    return df.select(
        *[
            F.coalesce(as_double(df, c), F.lit(float(values[c]))).alias(c)
            if values.get(c) is not None
            else ref(c)
            for c in df.columns
        ]
    )


__all__ = [
    "ColumnStats",
    "cast_double",
    "column_decisions",
    "column_stats",
    "drop_constant",
    "drop_non_numeric",
    "drop_sparse",
    "fill_missing",
    "label_filter",
    "label_int",
    "nan_to_null",
    "project_columns",
    "recode_target",
    "rename_label",
    "require_features",
    "require_target",
]
