"""Splitting, feature assembly, the three classifiers and their comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import MLWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.functions.layout import PARTITIONS, dealt, repeated
from tallyframe.functions.numbers import doubles, ref
from tallyframe.operators.columns import fill_missing
from tallyframe.operators.metrics import METRICS_SCHEMA, model_metrics, rank_models
from tallyframe.operators.quantiles import means, medians
from tallyframe.sources.scratch import scratch_dir

TRAIN_SHARE = 0.8
SEED = 42

# Model settings that decide the results.
LOGISTIC_MAX_ITER = 40
FOREST_TREES = 40
TREE_DEPTH = 8


def default_estimators() -> dict[str, Estimator]:
    return {
        "logistic_regression": LogisticRegression(maxIter=LOGISTIC_MAX_ITER),
        "random_forest": RandomForestClassifier(numTrees=FOREST_TREES, maxDepth=TREE_DEPTH, seed=SEED),
        "decision_tree": DecisionTreeClassifier(maxDepth=TREE_DEPTH, seed=SEED),
    }


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def split_by(df: DataFrame, in_train: Column) -> tuple[DataFrame, DataFrame]:
    """Split on a condition; rows where it is null go to the test side."""
    side = F.coalesce(in_train, F.lit(False))
    return df.where(side), df.where(~side)


def split(df: DataFrame, key: str | None = None, train_share: float = TRAIN_SHARE, seed: int = SEED):
    """Train and test rows.

    With ``key`` a row's side depends on its key alone, so it stays the same
    under any partitioning or after a lost executor.  Without one it is random.
    """
    if key is None:
        return tuple(df.randomSplit([train_share, 1.0 - train_share], seed=seed))
    return split_by(df, hash_bucket(ref(key), 10_000) < round(train_share * 10_000))


def split_counts(df: DataFrame, in_train: Column) -> DataFrame:
    """Rows on each side of the split, one aggregate."""
    side = F.when(F.coalesce(in_train, F.lit(False)), "train").otherwise("test")
    return df.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class FeatureSet:
    """Fill values learned on training rows and the vector layout built from them."""

    features: tuple[str, ...]
    fills: Mapping[str, float]

    def impute(self, df: DataFrame, *keep: str) -> DataFrame:
        """Features as gap-free doubles, plus the columns in ``keep``."""
        return fill_missing(doubles(df, self.features, *keep), self.fills)

    def assemble(self, df: DataFrame, *keep: str) -> DataFrame:
        """Features as one vector column, plus the columns in ``keep``."""
        assembler = VectorAssembler(inputCols=list(self.features), outputCol="features", handleInvalid="keep")
        return assembler.transform(self.impute(df, *keep)).select(*map(ref, keep), "features")


def fit_features(train: DataFrame, features: Sequence[str], strategy: str = "mean") -> FeatureSet:
    """Learn fill values on ``train``; features without any value are left out."""
    if strategy not in ("mean", "median"):
        raise ValueError(f"unknown fill strategy {strategy!r}")
    learned = (means if strategy == "mean" else medians)(train, features)
    usable = tuple(f for f in features if learned[f] is not None)
    if not usable:
        raise ValueError("no feature column has any value")
    return FeatureSet(usable, {f: learned[f] for f in usable})


def fit_models(assembled: DataFrame, estimators: Mapping[str, Estimator] | None = None) -> dict[str, Model]:
    """Fit every estimator on one assembled (features, label) frame."""
    estimators = estimators or default_estimators()
    with repeated(assembled) as rows:
        return {name: _without_summary(assembled.sparkSession, estimator.fit(rows)) for name, estimator in estimators.items()}


def _without_summary(spark: SparkSession, model: Model) -> Model:
    """``model``, stored and loaded if it has a training summary.

    A summary of two classes holds the session, and goes to the tasks with its model. In a session that has observed a table it cannot
    be serialized, so no row could be scored. A loaded model has no summary.
    """
    if not (getattr(model, "hasSummary", False) and isinstance(model, MLWritable)):
        return model
    path = scratch_dir(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def score(assembled: DataFrame, models: Mapping[str, Model], *keep: str, by: str = "rawPrediction") -> DataFrame:
    """Score each row with every model in one scan: (model, label, prediction, score, keep...).

    ``score`` is class 1 of ``by``; for a single tree the raw prediction is the
    number of training rows of class 1 in the leaf, ``by="probability"`` gives
    its share.
    """

    def add(df: DataFrame, named: tuple[str, Model]) -> DataFrame:
        name, model = named
        return model.transform(df).withColumn(
            f"__{name}",
            F.struct(
                F.lit(name).alias("model"),
                F.col("prediction").alias("prediction"),
                F.element_at(vector_to_array(by), 2).alias("score"),
            ),
        ).drop("rawPrediction", "probability", "prediction")

    kept = ["label", *keep]
    side_by_side = reduce(add, models.items(), assembled.select(*map(ref, kept), "features"))
    each = F.explode(F.array(*[ref(f"__{name}") for name in models])).alias("scored")
    return side_by_side.select(*map(ref, kept), each).select(
        "scored.model", *map(ref, kept), "scored.prediction", "scored.score"
    )


def binned_auc(scored: DataFrame, bins: int = 1000) -> float:
    """ROC AUC of one model's rows by the built-in evaluator, whose curve has at most ``bins`` steps."""
    return BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=bins
    ).evaluate(scored)


def compare_models(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    estimators: Mapping[str, Estimator] | None = None,
    *,
    strategy: str = "mean",
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Fit on ``train``, evaluate on ``test``: one row per model, best first.

    Fill values and vectors are built once and shared by all models; all models
    are scored side by side and measured together in one pass of the test rows.
    Training rows are dealt into ``partitions``, or a multiple that leaves at most ``PART_ROWS`` rows in
    each: the forest depends on that number and on the rows, not on cores.
    """
    layout = fit_features(train, features, strategy)
    # dealt by the raw cells: fill values are sums, whose last digits depend on the order of adding
    rows = dealt(train.select("label", *[ref(f) for f in layout.features if f != "label"]), partitions)
    models = fit_models(layout.assemble(rows, "label"), estimators)
    scored = score(layout.assemble(test, "label"), models)
    rows = rank_models(model_metrics(scored)).collect()  # one row per model
    return train.sparkSession.createDataFrame(rows, METRICS_SCHEMA)
