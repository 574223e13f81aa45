import json
import time

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tallyframe import SurveySpec
from tallyframe.operators.metrics import METRICS_SCHEMA
from tallyframe.plans.prepare import fit_rules, load_survey
from tallyframe.plans.run import run
from tallyframe.sources import kafka, records, results, tables
from tallyframe.sources.scratch import scratch_dir
from tallyframe.streaming import ingest as streaming

SPEC = SurveySpec("y", ("a", "b", "y"))


def test_csv_reads_gaps_and_nan_as_null(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text("a,b,t\n1,,x\nNaN,2.5,y\n3,nan,\n")
    df = tables.load_table(spark, path, "a double, b double, t string")
    assert [tuple(r) for r in df.collect()] == [(1.0, None, "x"), (None, 2.5, "y"), (3.0, None, None)]
    inferred = tables.load_table(spark, path)
    assert dict(inferred.dtypes)["a"] == "double" and inferred.where("a IS NULL").count() == 1


def test_suffix_chooses_the_format(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "y int, a double")
    for name in ("plain", "T.CSV", "x.parquet"):
        path = str(tmp_path / name)
        tables.save_table(df, path)
        tables.save_table(df, path)  # overwrite
        assert sorted(tables.load_table(spark, path).select("y", "a").collect()) == sorted(df.collect())
    assert tables.is_csv("/d/T.CSV") and not tables.is_csv("/d/csv/part.parquet")


def test_records_round_trip_and_bad_text(spark):
    schema = tables.survey_schema(["a", "b"])
    df = spark.createDataFrame([(1.0, None), (2.5, 3.0)], schema)
    sent = records.to_records(df)
    assert sorted(list(json.loads(r["value"]).items()) for r in sent.collect()) == [[("a", 1.0)], [("a", 2.5), ("b", 3.0)]]
    assert sorted(records.parse_records(sent, schema).collect()) == sorted(df.collect())
    text = spark.createDataFrame([('{"b": 1, "other": 2}',), ("{bad",), (None,), ('{"a": NaN}',)], "value string")
    got = records.parse_records(text.withColumn("value", F.col("value").cast("binary")), schema).collect()
    assert [tuple(r) for r in got[:3]] == [(None, 1.0), (None, None), (None, None)]
    flagged = records.parse_records(text, "a double, bad string", corrupt="bad")
    assert flagged.where("bad IS NOT NULL").count() == 1


def test_topic_options(spark):
    options = kafka.topic_options("h:1", "t", failOnDataLoss="false")
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false"
    }
    with pytest.raises(Exception, match="kafka"):  # the connector is not part of this session
        kafka.read_topic(spark, "h:1", "t")
    with pytest.raises(ValueError):
        load_survey(spark, SurveySpec("y"), topic="t", servers="h:1")


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    schema = tables.survey_schema(["a"])

    def add(lo, hi):
        records.to_records(spark.range(lo, hi).select(F.col("id").cast("double").alias("a"))).write.mode("append").text(source)

    def take():
        streaming.ingest(streaming.stream_lines(spark, source), schema, out, checkpoint, available_now=True, timeout_seconds=120)

    add(0, 50)
    take()
    take()  # nothing new
    add(50, 80)
    take()
    assert sorted(r["a"] for r in spark.read.parquet(out).collect()) == [float(i) for i in range(80)]


def test_timeout_is_in_seconds_and_stops_the_query(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = streaming.stream_lines(spark, str(tmp_path / "in"))
    start = time.time()
    with pytest.raises(TimeoutError):
        streaming.ingest(lines, tables.survey_schema(["a"]), str(tmp_path / "o"), str(tmp_path / "c"), timeout_seconds=2)
    assert time.time() - start < 60 and not spark.streams.active


def test_rules_learned_on_a_table_apply_to_a_stream(spark, tmp_path):
    batch = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (1, None, 5.0)], "y int, a double, b double")
    rules = fit_rules(batch, SPEC)
    records.to_records(spark.createDataFrame([(1.0, None), (2.0, 7.0), (9.0, 1.0)], "y double, a double")).write.text(str(tmp_path / "in"))
    rows = records.parse_records(streaming.stream_lines(spark, str(tmp_path / "in")), tables.survey_schema(SPEC.columns))
    query = rules.apply(rows).writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(tuple(r) for r in spark.table("cleaned").collect()) == [(2.0, 1.0), (7.0, 0.0)]


def test_metrics_round_trip(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([("a", 0.5, 0.1, 0.2, 0.4, None, 0.3), ("b", 0.6, 0.1, 0.2, 0.7, 0.8, None)], METRICS_SCHEMA)
    results.save_metrics(df, path)
    assert sorted(results.load_metrics(spark, path).collect()) == sorted(df.collect())
    assert results.load_metrics(spark, results.best_path(path)).first()["model"] == "b"


def test_run_log_keeps_success_and_failure(spark, tmp_path):
    path = str(tmp_path / "log")
    with results.recorded_run(spark, path, {"use_kafka": False}) as record:
        record.skip("publish")
    with pytest.raises(RuntimeError):
        with results.recorded_run(spark, path, {}) as record:
            with record.step("train"):
                raise RuntimeError("no luck")
    with pytest.raises(KeyboardInterrupt):
        with results.recorded_run(spark, path, {"topic": None}):
            raise KeyboardInterrupt
    logged = results.load_run_log(spark, path).collect()
    stopped = next(r for r in logged if r["error_message"] == "KeyboardInterrupt")
    assert stopped["status"] == "failed" and stopped["parameters"] == {"topic": None}
    rows = {r["status"]: r for r in logged if r is not stopped}
    assert rows["success"]["step_durations_seconds"] == {"publish": 0.0} and rows["success"]["error_message"] is None
    assert rows["failed"]["error_message"] == "no luck" and "train" in rows["failed"]["step_durations_seconds"]


@pytest.mark.parametrize("suffix", [".csv", ""])
def test_full_run(spark, tmp_path, suffix):
    data = [(1 + (i * 7 % 10 > 5), float(i * 7 % 10) if i % 9 else None, float(i % 4)) for i in range(600)]
    data += [(7, 1.0, 1.0), (None, 1.0, 1.0)]
    source = str(tmp_path / f"raw{suffix}")
    tables.save_table(spark.createDataFrame(data, "y int, a double, b double"), source)
    out = {n: str(tmp_path / n) for n in ("metrics", "log")}
    metrics = run(
        spark, SPEC, source, str(tmp_path / f"prepared{suffix}"), out["metrics"], out["log"],
        estimators={"tree": DecisionTreeClassifier(maxDepth=3, seed=1)},
    )
    assert metrics.first()["accuracy"] > 0.85
    prepared = tables.load_table(spark, str(tmp_path / f"prepared{suffix}"))
    assert prepared.columns == ["a", "b", "y"] and prepared.count() == 600
    assert prepared.where("a IS NULL OR y NOT IN (0, 1)").count() == 0
    logged = results.load_run_log(spark, out["log"]).first()
    assert logged["status"] == "success" and logged["best_model"]["model"] == "tree"
    assert set(logged["step_durations_seconds"]) == {"prepare", "publish", "train", "save_metrics"}


def test_first_error_survives_an_unwritable_log(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    with pytest.raises(RuntimeError, match="first"):
        with results.recorded_run(spark, str(blocked / "log"), {}):
            raise RuntimeError("first")


def test_run_on_a_table_with_a_key(spark, tmp_path):
    data = [(1 + (i * 7 % 10 > 5), float(i * 7 % 10), float(i % 4) if i % 5 else None, float(i)) for i in range(900)]
    table = spark.createDataFrame(data, "y int, a double, b double, id double")
    spec = SurveySpec(target="y", columns=("a", "b", "id", "y"), recode={2: 0}, unknown=(7, 9))
    paths = [str(tmp_path / n) for n in ("prepared", "metrics", "log")]
    tree = {"tree": DecisionTreeClassifier(maxDepth=3, seed=1)}
    metrics = run(spark, spec, table, *paths, key="id", fit_on_train=True, ranking_path=str(tmp_path / "ranking"), estimators=tree)
    assert metrics.first()["accuracy"] > 0.9 and metrics.columns[1:] == ["accuracy", "precision", "recall", "f1", "roc_auc", "specificity"]
    ranked = [r["feature"] for r in spark.read.parquet(str(tmp_path / "ranking")).collect()]
    assert sorted(ranked) == ["a", "b"]
    again = run(spark, spec, table.repartition(5), *paths, key="id", fit_on_train=True, estimators=tree)
    assert again.collect() == metrics.collect()
    with pytest.raises(ValueError):
        run(spark, spec, table, *paths, key="missing", estimators=tree)


def test_scratch_folder_follows_the_cluster_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared) and scratch_dir(spark, "x") != scratch_dir(spark, "x")
