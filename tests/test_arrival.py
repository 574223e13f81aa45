"""Type inference, versions, streams that deliver twice, batch counts, neighbour information, binned density, samples, fits side by side."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from tallyframe import SurveySpec
from tallyframe.functions import layout
from tallyframe.operators import distribution, information, models, neighbours, quantiles
from tallyframe.operators.columns import drop_non_numeric
from tallyframe.plans.prepare import clean
from tallyframe.sources import inference, records, results, tables, versions
from tallyframe.streaming import ingest as streaming

# types of CSV columns ---------------------------------------------------------

MIXED = """whole,signed,decimal,exponent,flag,day,moment,word,few,half,big,nan
1,-5,1.5,1e3,true,2024-01-31,2024-01-31 10:00:00,a,1,,9223372036854775807,nan
2,7,2,2.5E-2,false,1999-12-01,2023-02-28 23:59:59,b,x,3,9223372036854775808,1
,0,.5,7,TRUE,,2024-02-29 00:00:00,c,2,,1,2
"""


def test_csv_types_equal_those_of_duckdb(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MIXED)
    path = str(tmp_path / "m.csv")
    names = {"BIGINT": "bigint", "HUGEINT": "double", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp", "VARCHAR": "string"}
    want = {r[0]: names[r[1]] for r in duckdb.sql(f"DESCRIBE SELECT * FROM read_csv('{path}', sample_size=-1, auto_detect=true)").fetchall()}
    read = tables.read_csv(spark, path)
    assert dict(read.dtypes) == want
    assert read.where("whole IS NULL").count() == 1 and read.agg(F.sum("exponent")).first()[0] == 1007.025


def test_types_of_odd_cells(spark):
    df = spark.createDataFrame([(None, "", "NA", "2024-13-01", "1 ", "12:30", "t"), (None, None, "4", "2024-01-01", "2", "1.2.3", "f")], "a string, b string, c string, d string, e string, f string, g string")
    found = {r["column"]: (r["cells"], r["type"]) for r in inference.type_counts(df).collect()}
    assert found == {"a": (0, "double"), "b": (0, "double"), "c": (1, "bigint"), "d": (2, "string"), "e": (2, "string"), "f": (2, "string"), "g": (2, "string")}
    coded = spark.createDataFrame([("+7", "007"), ("-1", "010")], "a string, b string")  # numbers, however they are written
    assert {r["type"] for r in inference.type_counts(coded).collect()} == {"bigint"}
    assert {r["column"]: r["type"] for r in inference.type_counts(df, missing=()).collect()}["c"] == "string"
    assert inference.type_counts(spark.range(2)).count() == 0
    assert {r["type"] for r in inference.type_counts(df.limit(0)).collect()} == {"double"}


def test_text_with_a_few_numbers_is_not_filled(spark, tmp_path):
    rows = "".join(f"{1 + i % 2},{'4' if i % 10 == 0 else 'yes'},{i % 5 or ''}\n" for i in range(60))
    (tmp_path / "s.csv").write_text("y,said,n\n" + rows)
    raw = tables.load_table(spark, str(tmp_path / "s.csv"))
    assert dict(raw.dtypes) == {"y": "bigint", "said": "string", "n": "bigint"} and drop_non_numeric(raw).columns == ["y", "n"]
    assert clean(raw, SurveySpec("y", ("said", "n", "y"))).columns == ["n", "y"]


# versions ---------------------------------------------------------------------


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path):
    for name in ("t", "t.csv"):
        path = str(tmp_path / name)
        tables.save_table(spark.range(5), path, versioned=True)
        broken = spark.range(9).select(F.expr("CASE WHEN id = 7 THEN raise_error('gone') ELSE id END").cast("long").alias("id"))
        with pytest.raises(Exception, match="gone"):
            tables.save_table(broken, path, versioned=True)
        assert tables.load_table(spark, path).count() == 5
        tables.save_table(spark.range(3), path, versioned=True)
        assert tables.load_table(spark, path).count() == 3
    assert versions.versions(spark, path).count() == 2 and versions.current_folder(spark, str(tmp_path / "none")) is None


def test_old_versions_can_be_forgotten(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        tables.save_table(spark.range(n), path, versioned=True)
    assert versions.forget(spark, path, keep=2) == 2 and versions.forget(spark, path, keep=2) == 0
    assert tables.load_table(spark, path).count() == 4
    with pytest.raises(ValueError):
        versions.forget(spark, path, keep=0)


def test_metrics_and_the_best_switch_together(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    row = lambda name, x: spark.createDataFrame([(name, x, x, x, x, x, x)], results.METRICS_SCHEMA)
    results.save_metrics(row("old", 0.5), path)
    monkeypatch.setattr(results, "best_model", lambda metrics: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        results.save_metrics(row("new", 0.9), path)
    assert {results.load_metrics(spark, p).first()["model"] for p in (path, results.best_path(path))} == {"old"}
    with pytest.raises(FileNotFoundError):
        results.load_metrics(spark, str(tmp_path / "nothing"))


# streams ----------------------------------------------------------------------


def test_records_delivered_again_are_stored_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    schema, once = "id bigint, at timestamp, v double", streaming.Once(["id"], "at", "1 hour")

    def deliver(*rows):
        df = spark.createDataFrame([(i, f"2024-01-01 {h}", v) for i, h, v in rows], "id long, at string, v double")
        records.to_records(df).coalesce(1).write.mode("append").text(source)
        streaming.ingest(streaming.stream_lines(spark, source), schema, out, checkpoint, available_now=True, timeout_seconds=120, once=once)

    deliver((1, "10:00:00", 1.0), (2, "10:01:00", 2.0), (1, "10:00:00", 1.0))
    deliver((2, "10:01:00", 2.0), (3, "10:30:00", 3.0))  # another run of the query
    deliver((3, "10:30:00", 3.0), (1, "10:00:00", 1.0), (4, "10:31:00", 4.0))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    rows, counts, sketches = (str(tmp_path / d) for d in ("rows", "counts", "sketches"))
    write = streaming.batch_writer(rows, counts, "bad", sketches)
    batch = lambda lo, hi: spark.range(lo, hi).select(F.when(F.col("id") % 5 > 0, F.col("id")).cast("double").alias("a"), F.when(F.col("id") % 7 == 0, "{").alias("bad"))
    write(batch(0, 50), 0)
    write(batch(50, 90), 1)
    write(batch(50, 90), 1)
    assert streaming.read_batches(spark, rows).count() == 90 and streaming.read_batches(spark, sketches).count() == 2
    seen = {r["batch"]: r for r in streaming.batch_counts(spark, counts).collect()}
    assert {b: (r["rows"], r["malformed"], r["gaps"]) for b, r in seen.items()} == {0: (50, 8, {"a": 8}), 1: (40, 5, {"a": 7})}
    assert streaming.batch_counts(spark, str(tmp_path / "none")).count() == 0


# information of measured features -----------------------------------------------


def _by_hand(rows, k=3):
    """Ross' estimate over all pairs of rows; nearer means between the k-th neighbours on both sides, where there are such."""
    psi = lambda n: -0.5772156649015329 + sum(1 / i for i in range(1, n))
    rows = [(x, y) for x, y in rows if x is not None and y is not None and math.isfinite(x)]
    classes = {y: [x for x, z in rows if z == y] for _, y in rows}
    classes = {y: xs for y, xs in classes.items() if len(xs) > 1}
    points = [(x, y) for x, y in rows if y in classes]
    total = 0.0
    for x, y in points:
        own = list(classes[y])
        own.remove(x)
        size = min(k, len(own))
        d = sorted(abs(x - z) for z in own)[size - 1]
        low = max([z for z in own if z < x and x - z == d], default=x - d)
        high = min([z for z in own if z > x and z - x == d], default=x + d)
        m = sum(low < z < high for z, _ in points) if d else sum(z == x for z, _ in points)
        total += psi(size) - psi(len(own) + 1) - psi(m)
    return max(psi(len(points)) + total / len(points), 0.0)


@pytest.mark.parametrize("block", [20_000, 7, 4])
def test_neighbour_information_equals_all_pairs(spark, block):
    rng = random.Random(3)
    rows = [(rng.gauss(2 * (i % 2), 1), float(round(rng.gauss(i % 2, 1) * 2)), i % 2) for i in range(160)]
    rows += [(rng.random(), 1.0, 2) for _ in range(3)] + [(9.0, 9.0, 3), (None, 2.0, 1), (math.nan, 1.0, 0), (math.inf, 2.0, 1), (1.0, 1.0, None)]
    rows += [(0.25, 0.5, 0)] * 9 + [(0.25, 0.5, 1)] * 2
    df = spark.createDataFrame(rows, "a double, b double, y int").repartition(3)
    counts = information.value_counts(df, ["a", "b"], "y")
    got = {r["feature"]: r["mi"] for r in neighbours.neighbour_information_from_counts(counts, block=block).collect()}
    clear = [(None if x is None or math.isnan(x) else x, z, y) for x, z, y in rows]
    assert got == {"a": pytest.approx(_by_hand([(x, y) for x, _, y in clear])), "b": pytest.approx(_by_hand([(z, y) for _, z, y in clear]))}
    ranked = information.mutual_information(df, ["a", "b"], "y", measured=["a"])
    assert ranked.columns == ["feature", "mi", "binned"] and {r["feature"]: r["mi"] for r in ranked.collect()}["a"] == pytest.approx(got["a"])


def test_neighbour_information_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, y int")
    assert information.mutual_information(empty, ["a"], "y", measured=["a"]).count() == 0
    with pytest.raises(ValueError):
        neighbours.neighbour_information_from_counts(information.value_counts(empty, ["a"], "y"), neighbours=5, block=5)


def test_digamma(spark):
    want = {n: -0.5772156649015329 + sum(1 / i for i in range(1, n)) for n in (1, 2, 3, 10, 1000)}
    got = spark.createDataFrame([(n,) for n in want], "n long").select("n", neighbours.digamma(F.col("n")).alias("p")).collect()
    assert all(r["p"] == pytest.approx(want[r["n"]], abs=1e-12) for r in got)


def test_running_totals_over_ranges(spark):
    rows = [(i % 2, i, i % 5) for i in range(300)]
    out = neighbours.running_totals(spark.createDataFrame(rows, "k int, x int, w long").repartition(4), ["k"], ["x"], "w", "before").collect()
    for r in out:
        assert r["before"] == sum(w for k, x, w in rows if k == r["k"] and x < r["x"])


# density, samples, quantiles ---------------------------------------------------


def test_binned_density_is_within_its_bound(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(x), float(i % 3), 1.0) for i, x in enumerate(np.concatenate([rng.normal(size=800), rng.exponential(40, 200)]))], "a double, b double, c double").repartition(3)
    exact = {(r["column"], r["point"]): r["density"] for r in distribution.kde(df, ["a", "b", "c"]).collect()}
    for options in ({}, {"tolerance": 1e-7}, {"max_bins": 500}):
        got = distribution.kde_binned(df, ["a", "b", "c"], **options).collect()
        assert {(r["column"], r["point"]) for r in got} == set(exact)
        assert all(abs(r["density"] - exact[r["column"], r["point"]]) <= r["error_bound"] + 1e-12 for r in got)
    assert distribution.kde_binned(df.where("false"), ["a"]).count() == 0


def test_sampled_points_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select("id", (F.col("id") % 97).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("y"))
    first = distribution.scatter_sample(df, "x", "y", 100, by=["id"]).collect()
    assert len(first) == 100 and first == distribution.scatter_sample(df.repartition(7), "x", "y", 100, by=["id"]).collect()
    halves = [distribution.scatter_sample(df.where(F.col("id") % 2 == k), "x", "y", 100, by=["id"]) for k in (0, 1)]
    assert halves[0].union(halves[1]).orderBy("hash", "x", "y").limit(100).collect() == first


def test_quantiles_from_stored_sketches_scan_less(spark):
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            scans.add(len(batch))
            yield batch

    n = 120_000
    base = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7).alias("a"), F.when(F.col("id") % 3 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)).cast("double") / 3).alias("b"))
    source = base.mapInPandas(counted, "a double, b double")
    parts = [quantiles.column_sketches(base.where(F.pmod(F.xxhash64("a"), F.lit(3)) == k), ["a", "b"]) for k in range(3)]
    sketches = spark.createDataFrame(parts[0].union(parts[1]).union(parts[2]).collect(), parts[0].schema)
    plain = quantiles.exact_quantiles(source, ["a", "b"], [0.25, 0.5, 0.9])
    alone, before = scans.value // n, scans.value
    assert quantiles.exact_quantiles(source, ["a", "b"], [0.25, 0.5, 0.9], sketches=sketches) == plain
    assert (scans.value - before) // n == 2 and alone == 4
    values = sorted(r["a"] for r in base.select("a").collect())
    assert plain["a"][1] == pytest.approx((values[n // 2 - 1] + values[n // 2]) / 2)


# fits ---------------------------------------------------------------------------


def test_models_do_not_depend_on_input_partitions(spark):
    rows = [(float(i % 7), float(i % 3), float((i % 7 + i % 3) > 4)) for i in range(700)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    named = {"tree": DecisionTreeClassifier(maxDepth=4, seed=1), "line": LogisticRegression(maxIter=20)}
    first = models.compare_models(df, df, ["a", "b"], named, partitions=5).collect()
    assert models.compare_models(df.repartition(9), df, ["a", "b"], named, partitions=5).collect() == first


def test_equal_rows_are_dealt_round(spark, monkeypatch):
    """A table of a few codes has few different rows, which must not lie in as few parts, nor grow them without bound."""
    df = spark.range(6000).selectExpr("id % 2 AS code", "if(id % 2 = 0, null, 'a') AS word")
    parts = layout.dealt(df, 8)
    sizes = [r["n"] for r in parts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2
    assert parts.groupBy("code", "word").count().collect() and parts.exceptAll(df).count() == df.exceptAll(parts).count() == 0
    again = [list(map(tuple, p)) for p in layout.dealt(df.repartition(5), 8).rdd.glom().collect()]
    assert again == [list(map(tuple, p)) for p in parts.rdd.glom().collect()]
    monkeypatch.setattr(layout, "PART_ROWS", 100)
    monkeypatch.setattr(layout, "SHARE_ROWS", 7)
    many = layout.dealt(df, 8)
    sizes = [r["n"] for r in many.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert many.rdd.getNumPartitions() == len(sizes) == 64 and max(sizes) <= 110 and sum(sizes) == 6000
    assert layout.dealt(df.limit(0), 8).count() == 0
