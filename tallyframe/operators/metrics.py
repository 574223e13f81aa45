"""Binary classification metrics over scored rows.

Input frames hold ``label`` (0/1) and ``prediction`` (0/1), optionally ``score``
and ``model``; all metrics are computed for every model in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.functions.numbers import share

METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "roc_auc", "specificity")
METRICS_SCHEMA = "model string, " + ", ".join(f"{name} double" for name in METRIC_NAMES)
_BEST_FIRST = ("f1", "roc_auc", "accuracy")


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Rows per model, label and prediction."""
    return scored.groupBy("model", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


_CELLS = ("tp", "tn", "fp", "fn")


def _cell_counts() -> list[Column]:
    label, hit = F.col("label") == 1, F.col("prediction") == 1
    cells = (label & hit, ~label & ~hit, ~label & hit, label & ~hit)
    return [F.count_if(c).cast("double").alias(name) for name, c in zip(_CELLS, cells)]


def _f1(hits: Column, wrong: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * hits, 2.0 * hits + wrong), F.lit(0.0))


def _cell_metrics() -> dict[str, Column]:
    tp, tn, fp, fn = map(F.col, _CELLS)
    wrong, total = fp + fn, tp + tn + fp + fn
    weighted = (tp + fn) * _f1(tp, wrong) + (tn + fp) * _f1(tn, wrong)
    return {
        "accuracy": share(tp + tn, total),
        "f1": share(weighted, total),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "specificity": share(tn, tn + fp),
        "f1_positive": _f1(tp, wrong),
    }


def classification_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, label-weighted F1, precision, recall and specificity per model.

    ``f1`` weighs the F1 of each class by its share of the labels;
    ``f1_positive`` is the F1 of class 1 alone.
    """
    cells = scored.groupBy("model").agg(*_cell_counts())
    return cells.select("model", *[value.alias(name) for name, value in _cell_metrics().items()])


_RUN_SUMS = ["p", "n", *_CELLS]
_RUN_SCHEMA = "model string, start double, u double, " + ", ".join(f"{c} double" for c in _RUN_SUMS)


def _rank_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fold rows sorted by (model, score) into one row per model of this task.

    ``u`` counts, for the positives of this run, the negatives of the same run
    with a lower score, ties counting half.
    """
    runs: dict[str, dict] = {}
    for batch in batches:
        for model, rows in batch.groupby("model", sort=False):
            p, n = rows["p"].to_numpy(), rows["n"].to_numpy()
            run = runs.get(model)
            if run is None:
                scores = rows["score"].dropna()
                start = float(scores.iloc[0]) if len(scores) else float("-inf")
                run = runs[model] = {"model": model, "start": start, "u": 0.0, **dict.fromkeys(_RUN_SUMS, 0.0)}
            below = run["n"] + n.cumsum() - n
            run["u"] += float((p * (below + n / 2.0)).sum())
            for name in _RUN_SUMS:
                run[name] += float(rows[name].sum())
    yield pd.DataFrame(list(runs.values()), columns=["model", "start", "u", *_RUN_SUMS])


def _ranked_totals(scored: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """One row per model: rank sum ``u``, positives ``p``, negatives ``n`` and the cell counts.

    Equal scores are added up before the shuffle, the distinct scores are range
    partitioned, and each range is folded on its own in score order.  What is
    left is one row per range, whose offsets a small window adds.  No task sees
    all scores and no sort is global.  Rows without a score, NaN included, count
    in the cells only.
    """
    score = F.nanvl(F.col("score").cast("double"), F.lit(None).cast("double"))
    ranked = score.isNotNull() & F.col("label").isNotNull()
    by_score = scored.groupBy("model", score.alias("score")).agg(
        F.count_if(ranked & (F.col("label") == 1)).cast("double").alias("p"),
        F.count_if(ranked & (F.col("label") != 1)).cast("double").alias("n"),
        *cells,
    )
    runs = (
        by_score.repartitionByRange("model", "score")
        .sortWithinPartitions("model", "score")
        .mapInPandas(_rank_runs, _RUN_SCHEMA)
    )
    earlier = Window.partitionBy("model").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(earlier), F.lit(0.0))
    return (
        runs.withColumn("u", F.col("u") + F.col("p") * offset)
        .groupBy("model")
        .agg(*[F.sum(c).alias(c) for c in ("u", *_RUN_SUMS)])
    )


def _auc() -> Column:
    return F.try_divide(F.col("u"), F.col("p") * F.col("n"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve per model, by ranks with ties counted half."""
    none = [F.lit(0.0).alias(c) for c in _CELLS]
    return _ranked_totals(scored, none).select("model", _auc().alias("roc_auc"))


def model_metrics(scored: DataFrame) -> DataFrame:
    """``METRIC_NAMES``, one row per model, from one pass over the rows; F1 is label-weighted, ROC AUC exact."""
    values = {**_cell_metrics(), "roc_auc": _auc()}
    return _ranked_totals(scored, _cell_counts()).select("model", *[values[n].alias(n) for n in METRIC_NAMES])


def rank_models(metrics: DataFrame) -> DataFrame:
    """Best model first: by F1, then ROC AUC, then accuracy; undefined values last."""
    defined = {c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in _BEST_FIRST}
    return metrics.withColumns(defined).orderBy(
        *[F.desc_nulls_last(c) for c in _BEST_FIRST], "model"
    )


def best_model(metrics: DataFrame) -> DataFrame:
    return rank_models(metrics).limit(1)


def metric_grade(metrics: DataFrame) -> DataFrame:
    """Verdicts by accuracy, with the thresholds of both report styles."""
    accuracy = F.col("accuracy")
    return metrics.select(
        "model",
        "accuracy",
        F.when(accuracy >= 0.8, "excellent").when(accuracy >= 0.7, "good").otherwise("needs improvement").alias("grade"),
        F.when(accuracy > 0.8, "good").otherwise("needs improvement").alias("verdict"),
        F.coalesce(accuracy > 0.75, F.lit(False)).alias("satisfactory"),
    )


def metric_bars(metrics: DataFrame, names: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """Bars to draw: one row per model and metric, undefined values as 0 labelled ``nan``."""
    value = F.nanvl(F.col("value"), F.lit(None).cast("double"))
    return metrics.unpivot(["model"], list(names), "metric", "value").select(
        "model",
        "metric",
        F.coalesce(value, F.lit(0.0)).alias("height"),
        F.when(value.isNotNull(), F.format_string("%.3f", value)).otherwise("nan").alias("label"),
    )
