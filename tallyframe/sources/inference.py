"""Column types of CSV tables, from one mergeable aggregate over all cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyframe.functions.numbers import ref

# Texts that stand for a missing cell in common statistics software.
MISSING = (
    "NA", "N/A", "#N/A", "#N/A N/A", "#NA", "<NA>", "n/a", "NULL", "null", "None",
    "-1.#IND", "-1.#QNAN", "1.#IND", "1.#QNAN",
)

# A cell has the narrowest of these types; READS says which cells a type can read.
BIGINT, DOUBLE, BOOLEAN, DATE, TIMESTAMP, TEXT = range(6)
NAMES = ("bigint", "double", "boolean", "date", "timestamp", "string")
READS = {BIGINT: (BIGINT,), DOUBLE: (BIGINT, DOUBLE), BOOLEAN: (BOOLEAN,), DATE: (DATE,), TIMESTAMP: (DATE, TIMESTAMP)}
COUNTS = ("longs", "doubles", "booleans", "dates", "timestamps")
_KINDS = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "string": T.StringType()}


def cell_type(text: Column) -> Column:
    """Narrowest type that one cell can be read as."""
    whole = text.rlike(r"^[+-]?[0-9]{1,18}$") | (text.rlike(r"^[+-]?[0-9]{19,}$") & text.try_cast("bigint").isNotNull())
    number = text.rlike(r"(?i)^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$") | text.rlike(r"(?i)^[+-]?nan$")
    day = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    moment = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$")
    starts_with_digit = text.rlike(r"^[+-]?[0-9.nN]")
    return (
        F.when(~starts_with_digit, F.when(F.lower(text).isin("true", "false"), BOOLEAN).otherwise(TEXT))
        .when(whole, BIGINT)
        .when(number, DOUBLE)
        .when(day & text.try_cast("date").isNotNull(), DATE)
        .when(moment & text.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP)
        .otherwise(TEXT)
    )


def type_counts(df: DataFrame, missing: Sequence[str] = MISSING) -> DataFrame:
    """(position, column, cells, longs, doubles, booleans, dates, timestamps, type): one row per text column of ``df``.

    Counts say how many cells can be read as a type: every whole number as a double as well, every date as a timestamp. Empty cells and
    the texts in ``missing`` say nothing. The type is the narrowest that all cells can be read as, else string; a column
    without any cell is of numbers, all missing. One scan; each task sends one row of sums.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    filled = lambda c: F.when((ref(c) != "") & ~ref(c).isin(*missing) if missing else ref(c) != "", ref(c))
    kinds = df.select(*[F.when(filled(c).isNotNull(), cell_type(filled(c))).alias(f"k{i}") for i, c in enumerate(names)])
    sums = []
    for i in range(len(names)):
        kind = F.col(f"k{i}")
        sums.append(F.struct(F.count(kind).alias("cells"), *[F.count_if(kind.isin(*READS[t])).alias(name) for t, name in enumerate(COUNTS)]).alias(f"c{i}"))
    if not names:
        return df.sparkSession.createDataFrame([], f"position int, column string, cells bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, type string")
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"c{i}").alias("c")) for i, c in enumerate(names)])
    rows = kinds.agg(*sums).select(F.explode(entries).alias("e")).select("e.position", "e.column", "e.c.*")
    kind = F.when(F.col("cells") == 0, NAMES[DOUBLE])
    for t, name in enumerate(COUNTS):
        kind = kind.when(F.col(name) == F.col("cells"), NAMES[t])
    return rows.withColumn("type", kind.otherwise(NAMES[TEXT]))


def inferred_schema(df: DataFrame, missing: Sequence[str] = MISSING) -> T.StructType:
    """Schema under which a table read as text, such as a CSV without schema, can be read again."""
    found = {r["column"]: r["type"] for r in type_counts(df, missing).collect()}  # one row per column
    return T.StructType([T.StructField(f.name, _KINDS[found[f.name]] if f.name in found else f.dataType, True) for f in df.schema.fields])
