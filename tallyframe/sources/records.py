"""JSON records: one text value per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tallyframe.functions.numbers import ref


def to_records(df: DataFrame, columns: Sequence[str] | None = None, *keep: str) -> DataFrame:
    """Each row as a JSON object in ``value``; null cells are left out of the object."""
    names = list(columns or df.columns)
    return df.select(*map(ref, keep), F.to_json(F.struct(*map(ref, names))).alias("value"))


def parse_records(
    records: DataFrame,
    schema: T.StructType | str,
    *keep: str,
    value: str = "value",
    corrupt: str | None = None,
) -> DataFrame:
    """Columns of the JSON objects in ``value``, for batch and streaming frames alike.

    Missing keys become null, malformed text a row of nulls.  ``corrupt`` names
    a column of ``schema`` that receives the malformed text.
    """
    options = {"mode": "PERMISSIVE"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    text = ref(value).cast("string")
    return records.select(*map(ref, keep), F.from_json(text, schema, options).alias("data")).select(
        *map(ref, keep), "data.*"
    )
