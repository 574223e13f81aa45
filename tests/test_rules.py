import math

import pytest
from pyspark.sql import functions as F

from tallyframe import HEART_SURVEY, SurveySpec
from tallyframe.operators import columns as rules
from tallyframe.plans.prepare import clean, fit_rules, load_survey, prepare, training_frame

NAN = float("nan")
SPEC = SurveySpec(target="y")


def rows(df):
    return [tuple(r) for r in df.collect()]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_spec_is_checked():
    with pytest.raises(ValueError):
        SurveySpec(target="y", columns=("a", "b"))
    with pytest.raises(ValueError):
        SurveySpec(target="y", recode={7: 0})
    assert len(HEART_SURVEY.columns) == 30 and HEART_SURVEY.columns[-1] == HEART_SURVEY.target


def test_projection_follows_allow_list_order(spark):
    df = frame(spark, [(1, 2, 3)], "b int, y int, a int")
    assert rules.project_columns(df, SurveySpec("y", ("a", "gone", "b", "y"))).columns == ["a", "b", "y"]


def test_missing_target_and_features_are_errors(spark):
    df = frame(spark, [(1,)], "a int")
    with pytest.raises(ValueError):
        rules.project_columns(df, SurveySpec("y", ("a", "y")))
    with pytest.raises(ValueError):
        training_frame(df, SPEC)
    with pytest.raises(ValueError):
        rules.require_features(frame(spark, [(1,)], "y int"), SPEC)


def test_outcome_codes(spark):
    df = frame(spark, [(1.0,), (2.0,), (7.0,), (9.0,), (None,), (NAN,), (3.0,)], "y double")
    assert sorted(r[0] for r in rows(rules.label_filter(df, SPEC))) == [0.0, 1.0, 3.0]
    coded = [r[0] for r in rows(rules.recode_target(df, SPEC))]
    assert coded == [1.0, 0.0, None, None, None, None, 3.0]


def test_recode_replaces_all_codes_at_once(spark):
    df = frame(spark, [(1,), (2,), (3,)], "y int")
    spec = SurveySpec("y", recode={1: 2, 2: 1}, unknown=())
    assert [r[0] for r in rows(rules.label_filter(df, spec))] == [2.0, 1.0, 3.0]


def test_text_outcome_is_cast(spark):
    df = frame(spark, [("1",), ("2",), ("7",), ("refused",), (None,), (" 1 ",), ("NaN",)], "y string")
    assert sorted(r[0] for r in rows(rules.label_filter(df, SPEC))) == [0.0, 1.0, 1.0]


def test_cast_double_never_fails(spark):
    text = ["1", " -2.5 ", "1e3", "bad", "", "NaN", "nope", "Infinity", "-inf", ".5", "+4", "1,5"]
    got = [r[0] for r in rows(rules.cast_double(frame(spark, [(t,) for t in text], "a string")))]
    assert got == [1.0, -2.5, 1000.0, None, None, None, None, math.inf, -math.inf, 0.5, 4.0, None]


def test_non_numeric_columns_go_and_booleans_stay(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS t, true AS b, date'2020-01-01' AS d, 1.5BD AS m")
    assert rules.drop_non_numeric(df).dtypes == [("a", "int"), ("b", "double"), ("m", "decimal(2,1)")]


def test_forty_percent_boundary(spark):
    # at: 2 of 5 missing, above: 3 of 5, empty: all
    data = [(1, 1.0, 1.0, None), (2, 2.0, 2.0, None), (1, 3.0, None, None), (1, None, None, None), (2, None, None, None)]
    df = frame(spark, data, "y int, at double, above double, empty double")
    assert rules.drop_sparse(df, SPEC).columns == ["y", "at"]


def test_constant_columns_count_null_as_a_value(spark):
    data = [(1, 5.0, 5.0, None, NAN, 1.0), (1, 5.0, None, None, 5.0, 2.0)]
    df = frame(spark, data, "y int, same double, gap double, empty double, nan double, varies double")
    # the target is constant too, but always stays
    assert rules.drop_constant(df, SPEC).columns == ["y", "gap", "nan", "varies"]
    decided = {r["column"]: r for r in rules.column_decisions(df, SPEC).collect()}
    assert {c for c, r in decided.items() if r["is_constant"]} == {"y", "same", "empty"}
    assert decided["y"]["kept"] and not decided["gap"]["kept"]


def test_label_rounds_half_to_even(spark):
    df = frame(spark, [(0.5,), (1.5,), (2.5,), (0.4,)], "y double")
    assert [r[0] for r in rows(rules.label_int(df, SPEC))] == [0, 2, 2, 0]


def test_prepare_and_clean(spark):
    data = [
        (1, 1.0, None, "a", 1.0), (2, None, None, "b", 1.0), (1, 3.0, None, "c", 1.0), (2, 8.0, 4.0, "d", 1.0),
        (7, 100.0, 9.0, "e", 2.0), (None, 200.0, 9.0, "f", 3.0), (9, 300.0, 9.0, "g", 4.0),
    ]
    df = frame(spark, data, "y int, a double, sparse double, t string, konst double")
    done = prepare(df, SPEC)
    assert done.table.columns == ["y", "a"]
    assert sorted(rows(done.table)) == [(0.0, 3.0), (0.0, 8.0), (1.0, 1.0), (1.0, 3.0)]
    assert [r["feature"] for r in done.ranking().collect()] == ["a"]
    cleaned = clean(df, SPEC)
    assert cleaned.dtypes == [("y", "int"), ("a", "double"), ("sparse", "double")]
    assert sorted(rows(cleaned)) == [(0, 3.0, 4.0), (0, 8.0, 4.0), (1, 1.0, 4.0), (1, 3.0, 4.0)]


def test_single_class_and_empty_tables(spark):
    schema = "y int, a double"
    with pytest.raises(ValueError, match="single class"):
        prepare(frame(spark, [(1, 1.0), (1, 2.0), (7, 3.0)], schema), SPEC)
    with pytest.raises(ValueError, match="no row"):
        prepare(frame(spark, [], schema), SPEC)
    assert clean(frame(spark, [], schema), SPEC).columns == ["y", "a"]


def test_fit_on_training_rows_only(spark):
    df = frame(spark, [(1, 1.0), (2, 3.0), (1, None), (2, 100.0)], "y int, a double")
    train = df.where("a IS NULL OR a < 50")
    got = prepare(df, SPEC, fit_on=train).table
    assert (1.0, 2.0) in rows(got) and got.count() == 4


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_result_does_not_depend_on_partitions(spark, partitions):
    data = [(1 + i % 2, float(i * 37 % 11) if i % 5 else None, float(i % 3)) for i in range(200)]
    df = frame(spark, data, "y int, a double, b double").repartition(partitions)
    rules_ = fit_rules(df, SPEC)
    assert rules_.fills == {"a": 5.0}
    ranking = [(r["feature"], round(r["mi"], 9)) for r in prepare(df, SPEC).ranking().collect()]
    assert ranking == [(r[0], pytest.approx(r[1])) for r in [("a", ranking[0][1]), ("b", ranking[1][1])]]
    assert ranking[0][1] == pytest.approx(0.0100, abs=0.05)


def test_outcome_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [(1.0, 1.0, "x"), (2.0, 2.0, "y")], "y double, a double, unused string").write.parquet(path)
    from tallyframe.sources.tables import load_table

    df = training_frame(load_table(spark, path, nan_as_null=False), SurveySpec("y", ("a", "y")))
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "In(y, [7.0,9.0])" in pushed
    assert "unused" not in next(line for line in plan.splitlines() if "ReadSchema" in line)


def test_load_survey_needs_a_source(spark):
    with pytest.raises(ValueError):
        load_survey(spark, SPEC)
