"""The survey view over ``lineitem`` and frames derived from it.

The test tables hold no nulls and no outcome codes, so the view adds unknown
codes, empty cells, a sparse column, a constant column and a text column.  The
same expressions run in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.operators.columns import label_filter, rename_label
from tallyframe.sources.tables import load_table
from tallyframe.spec import SurveySpec

KEY = "l_orderkey*31 + l_partkey*7 + l_linenumber"

VIEW = {
    "row_key": "h",
    "target": (
        "CASE WHEN h%20=0 THEN 7 WHEN h%20=1 THEN 9 WHEN h%20=2 THEN NULL "
        "WHEN (l_quantity>30 AND h%20<17) OR (l_quantity<=30 AND h%20>=17) THEN 1 ELSE 2 END"
    ),
    "genhlth": "CASE WHEN h%13=0 THEN NULL ELSE CAST(ceil(l_quantity/10) AS DOUBLE) END",
    "age": "l_quantity",
    "physhlth": "CASE WHEN h%11=0 THEN NULL ELSE l_discount END",
    "sparse": "CASE WHEN h%2=0 THEN NULL ELSE l_tax END",
    "konst": "CAST(1 AS DOUBLE)",
    "price": "l_extendedprice",
    "flag": "l_returnflag",
}

SURVEY_SQL = "WITH h AS (SELECT *, {key} AS h FROM lineitem), survey AS (SELECT {columns} FROM h)".format(
    key=KEY, columns=", ".join(f"{sql} AS {name}" for name, sql in VIEW.items())
)
LABELED_SQL = SURVEY_SQL + (
    ", labeled AS (SELECT *, CASE WHEN target=2 THEN CAST(0 AS DOUBLE) ELSE CAST(target AS DOUBLE) END AS label"
    " FROM survey WHERE target IS NOT NULL AND target NOT IN (7,9))"
)

SPEC = SurveySpec(
    target="target",
    columns=("genhlth", "age", "physhlth", "sparse", "konst", "price", "flag", "not_asked", "target"),
    continuous={"price": 50},
)
FEATURES = ["genhlth", "age", "physhlth", "price"]


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load_table(spark, f"{sf_dir}/lineitem.parquet", nan_as_null=False)
    keyed = lineitem.withColumn("h", F.expr(KEY))
    return keyed.select(*[F.expr(sql).alias(name) for name, sql in VIEW.items()])


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows with a known outcome as a double ``label``."""
    return rename_label(label_filter(survey(spark, sf_dir), SPEC), SPEC)


# Three fixed rules acting as models: (prediction, score) per labelled row.
RULES = {
    "age_rule": ("age > 25", "age"),
    "discount_rule": ("coalesce(physhlth, 0) > 0.05", "coalesce(physhlth, 0)"),
    "health_rule": ("coalesce(genhlth, 0) >= 3", "coalesce(genhlth, 0)"),
}

SCORED_SQL = LABELED_SQL + ", scored AS ({})".format(
    " UNION ALL ".join(
        f"SELECT '{name}' AS model, label, CASE WHEN {rule} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        f" AS prediction, CAST({score} AS DOUBLE) AS score FROM labeled"
        for name, (rule, score) in RULES.items()
    )
)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows scored by every rule."""
    each = [
        F.struct(
            F.lit(name).alias("model"),
            F.when(F.expr(rule), 1.0).otherwise(0.0).alias("prediction"),
            F.expr(score).cast("double").alias("score"),
        )
        for name, (rule, score) in RULES.items()
    ]
    rows = labeled(spark, sf_dir).select("label", F.explode(F.array(*each)).alias("s"))
    return rows.select("s.model", "label", "s.prediction", "s.score")


# Columns of a CSV file whose types have to be found: the same SQL in Spark and DuckDB, all texts.
MIXED = {
    "whole": "CAST(event_id AS VARCHAR(20))",
    "gaps": "CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR(20)) END",
    "marked": "CASE WHEN event_id % 5 = 0 THEN 'NA' ELSE CAST(user_id AS VARCHAR(20)) END",
    "decimal": "CASE WHEN event_id % 4 = 0 THEN CAST(user_id AS VARCHAR(20)) ELSE concat(CAST(user_id AS VARCHAR(20)), '.', CAST(event_id % 10 AS VARCHAR(20)), 'e-3') END",
    "not_a_number": "CASE WHEN event_id % 7 = 0 THEN 'NaN' ELSE CAST(event_id % 11 AS VARCHAR(20)) END",
    "huge": "concat('99999999999999999', CAST(event_id % 300 AS VARCHAR(20)))",
    "few_numbers": "CASE WHEN event_id % 50 = 0 THEN CAST(event_id AS VARCHAR(20)) ELSE event_type END",
    "flag": "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'False' END",
    "flag_or_one": "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE '1' END",
    "day": "concat('2024-0', CAST(1 + event_id % 9 AS VARCHAR(20)), '-1', CAST(event_id % 10 AS VARCHAR(20)))",
    "bad_day": "concat('2024-02-', CAST(10 + event_id % 30 AS VARCHAR(20)))",
    "moment": "concat('2024-03-1', CAST(event_id % 10 AS VARCHAR(20)), CASE WHEN event_id % 6 = 0 THEN '' ELSE ' 23:59:01.5' END)",
    "empty": "CAST(NULL AS VARCHAR(20))",
}
