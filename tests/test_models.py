import json
import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import Observation, functions as F

from tallyframe.operators import metrics, models


THREE = "model string, accuracy double, f1 double, roc_auc double"


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    parts = []
    for model, digits in (("fine", 9), ("coarse", 1), ("flat", 0)):
        label = (rng.random(3000) < 0.3).astype(float)
        score = np.round(0.25 * label + rng.random(3000) * 0.6, digits) if digits else np.zeros(3000)
        parts.append(pd.DataFrame({"model": model, "label": label, "prediction": (score > 0.5).astype(float), "score": score}))
    return spark.createDataFrame(pd.concat(parts)).repartition(5)


def test_metrics_agree_with_evaluators(spark, scored):
    got = {r["model"]: r for r in metrics.model_metrics(scored).collect()}
    full = {r["model"]: r for r in metrics.classification_metrics(scored).collect()}
    assert set(got) == {"fine", "coarse", "flat"}
    for model in got:
        rows = scored.where(F.col("model") == model)

        def multi(name, **more):
            return MulticlassClassificationEvaluator(metricName=name, **more).evaluate(rows)

        assert got[model]["accuracy"] == pytest.approx(multi("accuracy"))
        assert got[model]["f1"] == pytest.approx(multi("f1"))
        exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(rows)
        assert got[model]["roc_auc"] == pytest.approx(exact)
        assert models.binned_auc(rows) == pytest.approx(exact, abs=2e-3)
        assert full[model]["accuracy"] == got[model]["accuracy"] and full[model]["f1"] == got[model]["f1"]
        assert full[model]["recall"] == pytest.approx(multi("recallByLabel", metricLabel=1.0))
        assert full[model]["specificity"] == pytest.approx(multi("recallByLabel", metricLabel=0.0))
        if model != "flat":
            assert full[model]["precision"] == pytest.approx(multi("precisionByLabel", metricLabel=1.0))
    assert full["flat"]["precision"] is None  # nothing predicted positive


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_auc_does_not_depend_on_ranges(spark, scored, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(scored).collect()}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(scored).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == pytest.approx(want)


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_auc_ignores_missing_scores(spark, partitions):
    rng = np.random.default_rng(8)
    rows = [(float(rng.random() < 0.4), float(rng.random())) for _ in range(40)]
    gaps = [(1.0, float("nan"))] * 6 + [(0.0, float("nan"))] * 4 + [(1.0, None)] * 3
    df = spark.createDataFrame([("m", y, 1.0, s) for y, s in rows + gaps], "model string, label double, prediction double, score double")
    up, down = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in up for b in down) / (len(up) * len(down))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        row = metrics.model_metrics(df).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert row["roc_auc"] == pytest.approx(want) and row["recall"] == 1.0


def test_auc_edge_cases(spark):
    rows = [("one", 1.0, 1.0, 0.3), ("one", 1.0, 0.0, 0.4), ("gap", 1.0, 1.0, None), ("gap", 1.0, 1.0, 0.9), ("gap", 0.0, 0.0, 0.1)]
    df = spark.createDataFrame(rows, "model string, label double, prediction double, score double")
    got = {r["model"]: r for r in metrics.model_metrics(df).collect()}
    assert got["one"]["roc_auc"] is None and got["one"]["accuracy"] == 0.5
    assert got["gap"]["roc_auc"] == 1.0 and got["gap"]["accuracy"] == 1.0


def test_ranking_breaks_ties_and_puts_undefined_last(spark):
    rows = [("d", 0.9, None, 0.9), ("b", 0.8, 0.7, 0.6), ("c", 0.9, 0.7, float("nan")), ("a", 0.8, 0.7, 0.7), ("e", 0.9, 0.7, 0.6)]
    df = spark.createDataFrame(rows, THREE)
    assert [r["model"] for r in metrics.rank_models(df).collect()] == ["a", "e", "b", "c", "d"]
    assert metrics.best_model(df).first()["model"] == "a"


def test_bars_and_grades(spark):
    df = spark.createDataFrame([("a", 0.8, 0.75, float("nan")), ("b", 0.7, None, 0.5), ("c", None, 0.1, 0.2)], THREE)
    bars = {(r["model"], r["metric"]): (r["height"], r["label"]) for r in metrics.metric_bars(df, ["accuracy", "f1", "roc_auc"]).collect()}
    assert bars["a", "accuracy"] == (0.8, "0.800") and bars["a", "roc_auc"] == (0.0, "nan") and bars["b", "f1"] == (0.0, "nan")
    grades = {r["model"]: (r["grade"], r["verdict"], r["satisfactory"]) for r in metrics.metric_grade(df).collect()}
    assert grades == {
        "a": ("excellent", "needs improvement", True),
        "b": ("good", "needs improvement", False),
        "c": ("needs improvement", "needs improvement", False),
    }


def test_split_is_stable_under_repartitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    first = {r["key"] for r in models.split(df, "key")[0].collect()}
    again = {r["key"] for r in models.split(df.repartition(7), "key")[0].collect()}
    assert first == again and 3850 < len(first) < 4150
    train, test = models.split(df)
    assert train.count() + test.count() == 5000


def test_features_are_learned_on_training_rows(spark):
    train = spark.createDataFrame([(1.0, None, 0.0), (3.0, None, 1.0)], "a double, empty double, label double")
    test = spark.createDataFrame([(None, 5.0, 1.0)], "a double, empty double, label double")
    layout = models.fit_features(train, ["a", "empty"])
    assert layout.features == ("a",)
    assert layout.assemble(test, "label").first()["features"].toArray().tolist() == [2.0]
    with pytest.raises(ValueError):
        models.fit_features(train, ["empty"])


def test_three_models_are_compared(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 3000).astype(float), rng.normal(0, 1, 3000)
    label = ((a > 2) ^ (rng.random(3000) < 0.1)).astype(float)
    a[::10] = np.nan
    data = spark.createDataFrame(pd.DataFrame({"key": range(3000), "a": a, "b": b, "label": label}))
    train, test = models.split(data, "key")
    table = models.compare_models(train, test, ["a", "b"])
    rows = table.collect()
    assert {r["model"] for r in rows} == {"logistic_regression", "random_forest", "decision_tree"}
    assert all(r["accuracy"] > 0.8 and r["roc_auc"] > 0.8 for r in rows)
    assert [r["f1"] for r in rows] == sorted((r["f1"] for r in rows), reverse=True)

    layout = models.fit_features(train, ["a", "b"])
    tree = models.fit_models(layout.assemble(train, "label"), {"decision_tree": models.default_estimators()["decision_tree"]})
    scored = models.score(layout.assemble(test, "key", "label"), tree, "key")
    assert scored.columns == ["model", "label", "key", "prediction", "score"] and scored.count() == test.count()
    expected = tree["decision_tree"].transform(layout.assemble(test, "label"))
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(expected)
    auc = BinaryClassificationEvaluator(numBins=0).evaluate(expected)
    row = next(r for r in rows if r["model"] == "decision_tree")
    assert (row["accuracy"], row["roc_auc"]) == (pytest.approx(accuracy), pytest.approx(auc))


def test_models_score_in_a_session_that_observed_a_table(spark):
    """A training summary holds the session, which tasks cannot take once it has observed a table."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = spark.range(400).selectExpr("double(id % 7) AS a", "double(id % 7 > 3) AS label")
    few = models.default_estimators() | {"random_forest": models.default_estimators()["random_forest"].setNumTrees(3)}
    assert {r["accuracy"] for r in models.compare_models(rows, rows, ["a"], few).collect()} == {1.0}


CHILD = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master(f"local[{sys.argv[2]}]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
from tallyframe.operators import metrics, models
rows = spark.range(1500).selectExpr("double(id * 37 % 11) AS a", "double(id * 53 % 17) AS b", "id")
rows = rows.withColumn("label", (F.col("a") + F.col("b") > 13).cast("double"))
found = []
for parts in json.loads(sys.argv[3]):
    train, test = models.split(rows.repartition(parts), "id")
    forest = {"random_forest": models.default_estimators()["random_forest"].setNumTrees(5)}
    found.append([round(x, 9) for x in models.compare_models(train, test, ["a", "b"], forest).first()[1:]])
print("FOUND", json.dumps(found))
"""


def test_forest_does_not_depend_on_cores_partitions_or_folder(tmp_path):
    """Run from another folder with only the driver's path set: code reaches the workers, and the layout is the same everywhere."""
    found = []
    for cores, parts in (("4", "[1, 4, 7]"), ("8", "[4]")):
        command = [sys.executable, "-c", CHILD, str(Path(__file__).resolve().parent.parent), cores, parts]
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
        assert "FOUND" in done.stdout, done.stderr[-2000:]
        found += json.loads(done.stdout.split("FOUND")[1])
    assert len(found) == 4 and all(f == found[0] for f in found)
