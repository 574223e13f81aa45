"""Whole-table profiles: shape, missing cells, describe, distinct counts, preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import as_double, doubles, numeric_columns, one_row_per_column, ref, share
from tallyframe.operators.quantiles import EXACT_ROWS, exact_quantiles
from tallyframe.operators.metrics import best_model
from tallyframe.operators.columns import ColumnStats


def _present(df: DataFrame, name: str):
    """Value whose nulls are the missing cells; text is missing only when null."""
    is_text = df.schema[name].dataType.typeName() == "string"
    return ref(name) if is_text or name not in numeric_columns(df) else as_double(df, name)


def _missing(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1)).alias("rows")
    filled = [F.count(_present(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    entries = []
    for i, c in enumerate(df.columns):
        missing = F.col("rows") - F.col(f"c{i}")
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                missing.alias("missing"),
                (share(missing, F.col("rows")) * 100.0).alias("missing_pct"),
            )
        )
    return one_row_per_column(df.agg(rows, *filled), entries).where("missing > 0")


def missing_stats(df: DataFrame) -> DataFrame:
    """Columns with missing cells, most missing first."""
    return _missing(df).orderBy(F.desc("missing"), "position").drop("position")


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing cells in schema order, percentage to two digits."""
    return (
        _missing(df)
        .withColumn("missing_pct", F.round("missing_pct", 2))
        .orderBy("position")
        .drop("position")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type, filled cells and empty cells per column."""
    rows = F.count(F.lit(1)).alias("rows")
    filled = [F.count(_present(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    types = dict(df.dtypes)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            F.col(f"c{i}").alias("non_null"),
            (F.col("rows") - F.col(f"c{i}")).alias("nulls"),
        )
        for i, c in enumerate(df.columns)
    ]
    return one_row_per_column(df.agg(rows, *filled), entries)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of records and of columns."""
    return df.agg(F.count(F.lit(1)).alias("records"), F.lit(len(df.columns)).alias("features"))


def overview(df: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """One row of key figures: table shape, accuracy of the best model, what is available."""
    table = shape(df)
    if metrics is None:
        figures = table.withColumns({"accuracy": F.lit(None).cast("double"), "models": F.lit(0)})
    else:
        # one-row tables side by side
        best = best_model(metrics).select("accuracy")
        models = metrics.agg(F.count(F.lit(1)).alias("models"))
        figures = table.unionByName(models, allowMissingColumns=True).unionByName(best, allowMissingColumns=True).agg(
            *[F.max(c).alias(c) for c in ("records", "features", "accuracy", "models")]
        )
    return figures.select(
        "records",
        "features",
        "accuracy",
        F.col("models").cast("bigint").alias("models"),
        (F.col("records") > 0).alias("data_available"),
        (F.col("models") > 0).alias("metrics_available"),
    )


def distinct_with_null(df: DataFrame, columns: Sequence[str] | None = None, *, approximate: bool = False) -> DataFrame:
    """Distinct values per numeric column, null counting as one value.

    Values are counted per (column, value) first, so a value that fills most of
    the table collapses inside each task before anything is shuffled.
    """
    names = list(columns or numeric_columns(df))
    data = doubles(df, names)
    if approximate:
        aggregates = [
            (F.approx_count_distinct(ref(c)) + F.max(ref(c).isNull().cast("bigint"))).alias(f"d{i}")
            for i, c in enumerate(names)
        ]
        entries = [
            F.struct(F.lit(c).alias("column"), F.coalesce(f"d{i}", F.lit(0)).alias("distinct_values"))
            for i, c in enumerate(names)
        ]
        return one_row_per_column(data.agg(*aggregates), entries)
    return (
        data.unpivot([], [ref(c) for c in names], "column", "value")
        .groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count("one").alias("distinct_values"))
    )


def describe(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    names = list(columns or numeric_columns(df))
    data = doubles(df, names)
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(names):
        v = ref(c)
        aggregates += [
            F.count(v).alias(f"count{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
            F.bool_and(v == F.rint(v)).alias(f"whole{i}"),
        ]
    row = data.agg(*aggregates).first()

    def per_column(key):
        return {c: row[f"{key}{i}"] for i, c in enumerate(names)}

    stats = ColumnStats(row["n"], per_column("count"), per_column("min"), per_column("max"), per_column("whole"))
    quartiles = exact_quantiles(data, names, [0.25, 0.5, 0.75], stats=stats, exact_rows=exact_rows)
    rows = [
        (c, stats.non_null[c], row[f"mean{i}"], row[f"std{i}"], stats.low[c], *quartiles[c], stats.high[c])
        for i, c in enumerate(names)
    ]
    schema = (
        "column string, count bigint, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order."""
    return df.orderBy(*map(ref, order_by)).limit(n)
