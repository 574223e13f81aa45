import math
import random

import numpy as np
import pandas as pd
import pytest

from tallyframe.operators import correlation, distribution, information, profile
from tallyframe.operators import quantiles
from tallyframe.operators.quantiles import exact_quantiles, linear_rank, means, medians, midpoint_rank

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, columns: dict):
    pdf = pd.DataFrame(columns)
    schema = ", ".join(f"{c} double" for c in columns)
    data = [tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(data, schema), pdf


@pytest.fixture(scope="module")
def mixed():
    rng = np.random.default_rng(5)
    n = 4000
    code = rng.integers(1, 6, n).astype(float)
    code[rng.random(n) < 0.1] = np.nan
    heavy = np.exp(rng.normal(0, 6, n))  # spread over many orders of magnitude
    hot = np.where(rng.random(n) < 0.4, 3.25, rng.normal(0, 1, n))  # one value holds 40 %
    return {"code": code, "heavy": heavy, "hot": hot, "neg": -heavy, "konst": np.full(n, 0.1), "gone": np.full(n, np.nan)}


@pytest.mark.parametrize("exact_rows", [100_000, 40])
def test_quantiles_equal_pandas(spark, mixed, exact_rows):
    df, pdf = frame(spark, mixed)
    got = exact_quantiles(df, list(mixed), PROBS, exact_rows=exact_rows)
    for c in mixed:
        want = pdf[c].quantile(PROBS).tolist()
        if pdf[c].notna().any():
            assert got[c] == pytest.approx(want, rel=1e-12), c
        else:
            assert got[c] == [None] * len(PROBS)


def test_quantiles_of_infinite_values(spark):
    values = [-math.inf] * 30 + [float(i) for i in range(100)] + [math.inf] * 30 + [1e308, -1e308]
    random.Random(1).shuffle(values)
    df, _ = frame(spark, {"v": values})
    ordered = sorted(values)
    got = exact_quantiles(df, ["v"], [0.05, 0.5, 0.95], exact_rows=5, rank=lambda n, q: round(q * (n - 1)))
    assert got["v"] == [ordered[round(q * (len(values) - 1))] for q in (0.05, 0.5, 0.95)]


def test_quantiles_take_few_scans(spark, tmp_path, monkeypatch):
    """Values over 300 orders of magnitude: the scans do not depend on the distribution."""
    rng = np.random.default_rng(9)
    values = 10.0 ** rng.uniform(-150, 150, 20_000)
    spark.createDataFrame(pd.DataFrame({"v": values})).write.parquet(f"{tmp_path}/v")
    df = spark.read.parquet(f"{tmp_path}/v")
    scans = []
    for name in ("_narrowed", "_read", "column_stats"):
        inner = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *a, _f=inner, _n=name, **k: (scans.append(_n), _f(*a, **k))[1])
    got = exact_quantiles(df, ["v"], PROBS, exact_rows=500)["v"]
    assert got == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12)
    assert sum(2 if n == "_narrowed" else 1 for n in scans) <= 4


def test_no_task_gathers_values(spark):
    """Only one row of counts or a sketch per group of tasks meets in a single task."""
    df = spark.range(5000).selectExpr("double(id % 97) AS coded", "rand(3) AS free")
    plans = []
    for column, rows in (("coded", 10), ("free", 100_000)):
        stats = quantiles.column_stats(df, [column])
        bracket = quantiles._Bracket(column, (2500,), stats.low[column], stats.high[column], 0, rows)
        collected = []
        frame_collect = type(df).collect
        try:
            type(df).collect = lambda self: (collected.append(self._jdf.queryExecution().executedPlan().toString()), frame_collect(self))[1]
            quantiles._read(df, [bracket])
        finally:
            type(df).collect = frame_collect
        plans += collected
    assert plans and all("SinglePartition" not in p and "hashpartitioning(range" in p for p in plans)


def test_rank_rules():
    assert linear_rank(5, 0.25) == 1.0
    assert midpoint_rank(4, 0.25) == 0.5
    assert midpoint_rank(1, 0.75) == 0.0 and midpoint_rank(3, 0.99) == 2.0


@pytest.mark.parametrize("exact_rows", [100_000, 3])
def test_box_quartiles_use_midpoint_ranks(spark, exact_rows):
    df, _ = frame(spark, {"v": [1, 2, 3, 4, 5, 6, 7, 100]})
    row = distribution.box_stats(df, ["v"], exact_rows=exact_rows).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.5, 4.5, 6.5)
    assert (row["lower_whisker"], row["upper_whisker"], row["outliers"]) == (1.0, 7.0, 1)
    assert [r["v"] for r in distribution.box_outliers(df, "v", exact_rows=exact_rows).collect()] == [100.0]


def test_median_and_mean_of_gappy_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None)], "a double, b double")
    assert medians(df, ["a", "b"]) == {"a": 1.5, "b": None}
    assert means(df, ["a", "b"]) == {"a": 1.5, "b": None}


@pytest.mark.parametrize("exact_rows", [100_000, 50])
def test_describe_equals_pandas(spark, mixed, exact_rows):
    df, pdf = frame(spark, mixed)
    got = profile.describe(df, exact_rows=exact_rows).toPandas().set_index("column")
    want = pdf.describe().T
    for c in ("code", "heavy", "hot"):
        assert got.loc[c].tolist() == pytest.approx(want.loc[c].tolist(), rel=1e-9)
    assert got.loc["gone", "count"] == 0 and pd.isna(got.loc["gone", "q50"])


def test_missing_and_profile(spark):
    df = spark.createDataFrame([(1.0, "x", float("nan")), (None, None, 2.0), (None, "y", 3.0)], "a double, t string, b double")
    assert [tuple(r) for r in profile.missing_stats(df).collect()] == [
        ("a", 2, pytest.approx(66.666667)), ("t", 1, pytest.approx(33.333333)), ("b", 1, pytest.approx(33.333333))
    ]
    assert [tuple(r) for r in profile.missing_report(df).collect()] == [("a", 2, 66.67), ("t", 1, 33.33), ("b", 1, 33.33)]
    assert {r["column"]: (r["type"], r["non_null"], r["nulls"]) for r in profile.column_profile(df).collect()} == {
        "a": ("double", 1, 2), "t": ("string", 2, 1), "b": ("double", 2, 1)
    }
    assert {r["column"]: r["distinct_values"] for r in profile.distinct_with_null(df).collect()} == {"a": 2, "b": 3}
    assert {r["column"]: r["distinct_values"] for r in profile.distinct_with_null(df, approximate=True).collect()} == {"a": 2, "b": 3}
    assert profile.missing_stats(df.limit(0)).collect() == []


def test_overview_without_metrics(spark):
    row = profile.overview(spark.range(3).toDF("a")).first()
    assert (row["records"], row["features"], row["accuracy"], row["models"]) == (3, 1, None, 0)
    assert row["data_available"] and not row["metrics_available"]


def test_correlation_equals_pandas(spark, mixed):
    columns = {k: v for k, v in mixed.items()}
    rng = np.random.default_rng(6)
    columns["far"] = 1e9 + rng.normal(0, 1, 4000)  # needs centring
    columns["near"] = columns["far"] + rng.normal(0, 1, 4000)
    df, pdf = frame(spark, columns)
    got = {(r["feature_1"], r["feature_2"]): r["r"] for r in correlation.corr_matrix(df).collect()}
    want = pdf.corr()
    for a in columns:
        for b in columns:
            expected = want.loc[a, b]
            if "konst" in (a, b) or pd.isna(expected):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(expected, abs=1e-7), (a, b)
    assert correlation.pair_corr(df, "far", "near").first()["r"] == pytest.approx(want.loc["far", "near"], abs=1e-7)
    assert correlation.pair_corr(df, "far", "konst").first()["r"] is None
    top = correlation.top_correlations(df, ["heavy", "neg", "konst", "code"], 2).collect()
    assert (top[0]["feature_1"], top[0]["feature_2"], round(top[0]["r"], 9)) == ("heavy", "neg", -1.0)


def brute_mi(x, y):
    data = pd.DataFrame({"x": x, "y": y}).dropna()
    joint = data.value_counts(normalize=True)
    px, py = data["x"].value_counts(normalize=True), data["y"].value_counts(normalize=True)
    return sum(p * math.log(p / (px[a] * py[b])) for (a, b), p in joint.items())


def test_information_equals_brute_force(spark, mixed):
    label = (np.arange(4000) % 3 == 0).astype(float)
    gappy = np.where(np.arange(4000) % 7 == 0, np.nan, mixed["hot"])
    df, pdf = frame(spark, {"code": mixed["code"], "gappy": gappy, "label": label})
    low, high = pdf["gappy"].min(), pdf["gappy"].max()
    binned = np.minimum(49, np.floor((pdf["gappy"] - low) / (high - low) * 50))
    got = {r["feature"]: r["mi"] for r in information.mutual_information(df, ["code", "gappy"], "label", continuous=["gappy"]).collect()}
    assert got["code"] == pytest.approx(brute_mi(pdf["code"], pdf["label"]), abs=1e-12)
    assert got["gappy"] == pytest.approx(brute_mi(binned, pdf["label"]), abs=1e-12)


def test_information_does_not_depend_on_how_many_values_there_are(spark):
    def mi(codes):
        rows = [(float(i % codes), float((i % codes) * 7919 % 97 < 50)) for i in range(20_000)]
        df = spark.createDataFrame(rows, "code double, label double")
        row = information.mutual_information(df, ["code"], "label").first()
        assert not row["binned"]
        return row["mi"]

    assert mi(256) == pytest.approx(mi(257), abs=0.01) and mi(257) > 0.6


def test_overview_takes_the_best_model(spark):
    rows = [("a", 0.9, float("nan")), ("b", 0.7, 0.5)]
    table = spark.createDataFrame(rows, "model string, accuracy double, f1 double").withColumn("roc_auc", quantiles.F.lit(0.5))
    assert profile.overview(spark.range(3).toDF("a"), table).first()["accuracy"] == 0.7


def test_histogram_keeps_every_value(spark, mixed):
    df, pdf = frame(spark, mixed)
    table = distribution.histogram(df, ["code", "hot", "konst", "gone"], bins=10).toPandas()
    for c in ("code", "hot"):
        counts, edges = np.histogram(pdf[c].dropna(), bins=10)
        part = table[table["column"] == c].set_index("bin")
        assert part["n"].sum() == pdf[c].notna().sum()
        assert part.loc[0, "low"] == pytest.approx(edges[0]) and part.loc[9, "high"] == pytest.approx(edges[-1])
    assert table[table["column"] == "konst"]["n"].tolist() == [4000]
    assert "gone" not in set(table["column"])


def test_density_equals_brute_force(spark, mixed):
    df, pdf = frame(spark, {"code": mixed["code"], "hot": mixed["hot"], "konst": mixed["konst"]})
    table = distribution.kde(df, ["code", "hot", "konst"], points=25).toPandas()
    assert set(table["column"]) == {"code", "hot"}
    for c in ("code", "hot"):
        v = pdf[c].dropna().to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min(), v.max(), 25)
        want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * math.sqrt(2 * math.pi))
        part = table[table["column"] == c].sort_values("point")
        assert part["x"].to_numpy() == pytest.approx(grid)
        assert part["density"].to_numpy() == pytest.approx(want, rel=1e-9)


def test_trend_line(spark):
    df, _ = frame(spark, {"x": [0, 1, 2, np.nan], "y": [1, 3, 5, 9], "c": [2, 2, 2, 2]})
    row = distribution.ols_trend(df, "x", "y").first()
    assert (row["slope"], row["intercept"], row["r2"], row["n"]) == (2.0, 1.0, 1.0, 3)
    assert sorted(r["fitted"] for r in distribution.ols_fitted(df, "x", "y").collect()) == [1.0, 3.0, 5.0]
    assert {r["fitted"] for r in distribution.ols_fitted(df, "c", "y").collect()} == {None}


def test_names_with_punctuation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 7.0)], ["a.b", "c d"])
    assert medians(df, ["a.b", "c d"], exact_rows=1) == {"a.b": 2.0, "c d": 4.5}
    assert profile.describe(df).count() == 2
    assert distribution.histogram(df, bins=2).count() == 4
    assert correlation.corr_matrix(df).count() == 4
