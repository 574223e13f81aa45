"""The full run: prepare, optionally publish, train and compare, record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tallyframe.functions.layout import PARTITIONS
from tallyframe.functions.numbers import ref
from tallyframe.operators.columns import rename_label, require_features
from tallyframe.operators.models import compare_models, split
from tallyframe.plans.prepare import load_training_frame, prepare
from tallyframe.sources.kafka import publish
from tallyframe.sources.results import recorded_run, save_metrics
from tallyframe.sources.tables import load_table, save_table
from tallyframe.spec import SurveySpec


def train_and_compare(
    table: DataFrame,
    spec: SurveySpec,
    *,
    key: str | None = None,
    estimators: Mapping[str, Estimator] | None = None,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Ranked metrics of all models on an 80/20 split of a training frame."""
    features = [c for c in require_features(table, spec) if c != key]
    train, test = split(rename_label(table, spec), key)
    return compare_models(train, test, features, estimators, partitions=partitions)


def _counted(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` and the counts that its first action makes on its way."""
    seen = Observation()
    return df.observe(seen, *[F.count(value).alias(name) for name, value in counts.items()]), seen


def run(
    spark: SparkSession,
    spec: SurveySpec,
    source: str | DataFrame,
    prepared_path: str,
    metrics_path: str,
    run_log_path: str,
    *,
    schema: T.StructType | str | None = None,
    key: str | None = None,
    fit_on_train: bool = False,
    ranking_path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    estimators: Mapping[str, Estimator] | None = None,
    corrupt: str | None = None,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Prepare ``source``, publish it when ``topic`` is given, train from the prepared table.

    ``source`` is a path or a table, such as the rows of an ingest.  With ``key``, one of the spec's columns and never a feature, the split depends on
    the key alone; ``fit_on_train`` then learns column choice and fill values from
    training rows only.  ``ranking_path`` receives the features ranked by
    information.  Returns the ranked metrics.  The prepared table is written once and read by
    the later steps, so a lost executor never repeats the preparation; a run that dies leaves the table and the
    metrics of the run before.  Give ``schema`` for a large CSV source: inferring types takes a scan of its own.

    The run log holds what the steps counted on their way, without a scan for it: rows read and stored, malformed records if ``corrupt`` names the
    column of their text, and gaps of each kept column.  ``partitions`` is that of ``compare_models``.
    """
    parameters = {
        "source": source if isinstance(source, str) else "table",
        "key": key,
        "prepared_path": prepared_path,
        "metrics_path": metrics_path,
        "use_kafka": topic is not None,
        "topic": topic,
        "servers": servers,
    }
    if key is not None and key not in (spec.columns or [key]):
        raise ValueError(f"key {key!r} is not in the column list")
    if fit_on_train and key is None:
        raise ValueError("learning from training rows needs a key to split by")
    with recorded_run(spark, run_log_path, parameters) as record:
        with record.step("prepare"):
            raw = load_table(spark, source, schema, nan_as_null=False) if isinstance(source, str) else source
            prepared = prepare(raw, spec, fit_on=split(raw, key)[0] if fit_on_train else None)
            # only the plan that is stored counts its rows, as filters do not reach a scan below a count
            counted, read = _counted(raw, {"rows": F.lit(1), **({"malformed": ref(corrupt)} if corrupt else {})})
            table, written = _counted(prepared.rules.apply(counted), {"rows": F.lit(1)})
            save_table(table, prepared_path, versioned=True)
            record.counted("read", read.get)
            record.counted("stored", written.get)
            stats = prepared.rules.stats
            record.counted("gaps", {c: stats.rows - stats.non_null[c] for c in prepared.rules.columns})
        if ranking_path is not None:
            with record.step("rank_features"):
                ranking = prepared.ranking()
                save_table(ranking.where(F.col("feature") != key) if key else ranking, ranking_path)
        if topic is None:
            record.skip("publish")
        else:
            with record.step("publish"):
                publish(load_table(spark, prepared_path, prepared.table.schema), servers, topic)
        with record.step("train"):
            metrics = train_and_compare(
                load_training_frame(spark, prepared_path, spec, prepared.table.schema), spec, key=key, estimators=estimators,
                partitions=partitions,
            )
        with record.step("save_metrics"):
            save_metrics(metrics, metrics_path)
        record.models_compared(metrics)
        return metrics
