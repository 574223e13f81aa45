"""CSV and parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, types as T

from tallyframe.functions.numbers import nan_to_null
from tallyframe.sources.inference import MISSING, inferred_schema
from tallyframe.sources.versions import current_folder, replace


def survey_schema(columns: Sequence[str]) -> T.StructType:
    """One nullable double per column."""
    return T.StructType([T.StructField(c, T.DoubleType(), True) for c in columns])


def is_csv(path: str) -> bool:
    return PurePosixPath(str(path)).suffix.lower() == ".csv"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, missing: Sequence[str] = MISSING
) -> DataFrame:
    """CSV with a header line.  Without ``schema`` one scan infers the types from all cells; give one for a large table.

    Texts in ``missing`` say nothing about a column's type, and are null in columns that are not text.
    """
    if schema is None:
        schema = inferred_schema(spark.read.option("header", True).csv(str(path)), missing)
    return spark.read.option("header", True).schema(schema).csv(str(path))


def load_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    nan_as_null: bool = True,
) -> DataFrame:
    """Table by suffix: ``.csv`` is CSV, everything else parquet.  Of a versioned table, the current version.

    ``nan_as_null=False`` leaves the scan bare, so that later filters on
    floating-point columns reach it; the plans treat NaN as missing anyway.
    """
    folder = current_folder(spark, str(path)) or str(path)
    if is_csv(path):
        df = read_csv(spark, folder, schema)
    else:
        reader = spark.read
        df = (reader.schema(schema) if schema is not None else reader).parquet(folder)
    return nan_to_null(df) if nan_as_null else df


def save_table(df: DataFrame, path: str, *, versioned: bool = False) -> None:
    """Overwrite a table: CSV parts with header for ``.csv``, else parquet.

    A plain overwrite deletes the old table first.  ``versioned`` keeps it readable until the new one is complete; ``load_table`` follows.
    """

    def write(folder: str) -> None:
        writer = df.write.mode("overwrite")
        if is_csv(path):
            writer.option("header", True).csv(folder)
        else:
            writer.parquet(folder)

    if versioned:
        replace(df.sparkSession, str(path), write)
    else:
        write(str(path))
