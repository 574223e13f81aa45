"""Prepare, clean and training plans."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from tallyframe.functions.numbers import doubles
from tallyframe.operators.columns import (
    ColumnStats,
    cast_double,
    column_stats,
    drop_non_numeric,
    fill_missing,
    label_filter,
    label_int,
    project_columns,
)
from tallyframe.operators.information import mutual_information
from tallyframe.operators.quantiles import means, medians
from tallyframe.sources.kafka import read_topic
from tallyframe.sources.records import parse_records
from tallyframe.sources.tables import load_table, survey_schema
from tallyframe.spec import SurveySpec


@dataclass(frozen=True)
class FittedRules:
    """Columns to keep and values to fill, learned on one table.

    The rules are a few numbers, and applying them is a projection and a filter,
    so rules learned on a batch table also work on a stream or on a test split.
    """

    spec: SurveySpec
    columns: tuple[str, ...]
    fills: Mapping[str, float]
    stats: ColumnStats

    def apply(self, df: DataFrame) -> DataFrame:
        labelled = label_filter(project_columns(df, self.spec), self.spec)
        return fill_missing(doubles(labelled, self.columns), self.fills)


def labelled_numbers(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Allow-listed numeric columns of the rows with a known outcome, as doubles."""
    numeric = drop_non_numeric(project_columns(df, spec))
    return cast_double(label_filter(numeric, spec))


def fit_rules(df: DataFrame, spec: SurveySpec, *, drop_sparse: bool = True, strategy: str = "median") -> FittedRules:
    """Decide on columns and fill values: one scan for counts and ranges, one for the fills."""
    if strategy not in ("mean", "median"):
        raise ValueError(f"unknown fill strategy {strategy!r}")
    rows = labelled_numbers(df, spec)
    stats = column_stats(rows)
    if stats.rows and stats.low[spec.target] == stats.high[spec.target]:
        raise ValueError(f"target {spec.target!r} has a single class")
    gone = set(stats.sparse(rows.columns, spec.max_missing_pct)) if drop_sparse else set()
    kept = tuple(
        c for c in rows.columns if c == spec.target or (c not in gone and not stats.is_constant(c))
    )
    gaps = [c for c in kept if stats.non_null[c] < stats.rows]
    if strategy == "median":
        fills = medians(rows, gaps, stats=stats)
    else:
        fills = means(rows, gaps)
    return FittedRules(spec, kept, fills, stats)


def clean(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Known outcomes as 0/1 integers, constant and non-numeric columns gone, gaps filled."""
    return label_int(fit_rules(df, spec, drop_sparse=False).apply(df), spec)


@dataclass(frozen=True)
class Prepared:
    """The prepared table, lazily, with the rules behind it."""

    table: DataFrame
    rules: FittedRules
    own_stats: bool

    def ranking(self) -> DataFrame:
        """Features by mutual information with the target, most informative first."""
        target = self.rules.spec.target
        features = [c for c in self.rules.columns if c != target]
        # filling a gap with a median or mean does not widen a column's range
        stats = self.rules.stats if self.own_stats else None
        spec = self.rules.spec
        return mutual_information(self.table, features, target, continuous=spec.continuous, measured=spec.measured, stats=stats)


def prepare(df: DataFrame, spec: SurveySpec, *, fit_on: DataFrame | None = None) -> Prepared:
    """Known outcomes, sparse, constant and non-numeric columns gone, gaps filled by medians.

    Column choice and fill values are learned on ``fit_on`` (by default the
    whole table; pass the training rows to keep test rows out of them).
    """
    rules = fit_rules(df if fit_on is None else fit_on, spec)
    if not rules.stats.rows:
        raise ValueError("no row has a known outcome")
    return Prepared(rules.apply(df), rules, fit_on is None)


def training_frame(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Allow-listed columns as doubles, rows with a known outcome, gaps left open."""
    return cast_double(label_filter(project_columns(df, spec), spec))


def load_training_frame(
    spark: SparkSession, path: str, spec: SurveySpec, schema: T.StructType | str | None = None
) -> DataFrame:
    return training_frame(load_table(spark, path, schema, nan_as_null=False), spec)


def load_survey(
    spark: SparkSession,
    spec: SurveySpec,
    *,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    servers: str | None = None,
    topic: str | None = None,
) -> DataFrame:
    """Cleaned survey from a file or, when ``topic`` is given, from a Kafka topic."""
    if topic is not None:
        if servers is None or spec.columns is None:
            raise ValueError("a topic needs servers and a column list")
        raw = parse_records(read_topic(spark, servers, topic), survey_schema(spec.columns))
    elif path is not None:
        raw = load_table(spark, path, schema, nan_as_null=False)
    else:
        raise ValueError("give a path or a topic")
    return clean(raw, spec)
