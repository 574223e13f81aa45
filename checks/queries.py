"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.survey import FEATURES, MIXED, SPEC, labeled, scored, survey
from tallyframe.functions.numbers import numeric_columns as numeric_names
from tallyframe.operators import columns, correlation, distribution, information, metrics, models, profile
from tallyframe.operators.quantiles import exact_quantiles, means, medians
from tallyframe.plans import prepare as plans
from tallyframe.plans.run import run
from tallyframe.sources import inference, records, results, tables
from tallyframe.sources.scratch import scratch_dir
from tallyframe.spec import SurveySpec
from tallyframe.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RAW_COLUMNS = ["row_key", "target", "genhlth", "age", "physhlth", "sparse", "price", "flag"]
RAW_SCHEMA = (
    "row_key bigint, target int, genhlth double, age double, physhlth double, sparse double, price double, flag string"
)
RECORD_COLUMNS = ["target", "genhlth", "age", "physhlth", "sparse", "konst", "price"]
NUMBERS = ["genhlth", "age", "physhlth", "sparse", "price"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def in_train():
    # the label of the fixture depends on the last digits of the key, so the side depends on others
    return F.expr("(row_key DIV 20) % 10 < 8")


# --- sources and sinks -------------------------------------------------------


@query
def parquet_scan(spark, sf_dir):
    return tables.load_table(spark, f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"
    )


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv") + ".csv"
    tables.save_table(survey(spark, sf_dir).select(*RAW_COLUMNS), path)
    return tables.load_table(spark, path, RAW_SCHEMA)


@query
def csv_types(spark, sf_dir):
    """Types of a CSV without schema, from all its cells: some columns have a few cells of another kind."""
    path = scratch_dir(spark, "mixed") + ".csv"
    tables.save_table(tables.load_table(spark, f"{sf_dir}/events.parquet").selectExpr(*[f"{sql} AS {name}" for name, sql in MIXED.items()]), path)
    found = inference.type_counts(spark.read.option("header", True).csv(path))
    read = dict(tables.load_table(spark, path).dtypes)
    return found.withColumn("read_as", F.create_map(*[F.lit(x) for pair in read.items() for x in pair])[F.col("column")])


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "table")
    tables.save_table(survey(spark, sf_dir).select(*RAW_COLUMNS), path)
    return tables.load_table(spark, path)


@query
def records_json(spark, sf_dir):
    return records.to_records(plans.clean(survey(spark, sf_dir), SPEC))


@query
def json_decode(spark, sf_dir):
    messages = records.to_records(survey(spark, sf_dir), RECORD_COLUMNS, "row_key")
    messages = messages.withColumn("value", F.col("value").cast("binary"))
    return records.parse_records(messages, tables.survey_schema(RECORD_COLUMNS), "row_key")


@query
def json_decode_events(spark, sf_dir):
    events = tables.load_table(spark, f"{sf_dir}/events.parquet")
    return records.parse_records(events, "k double", "event_id", value="props")


@query
def load_survey(spark, sf_dir):
    path = scratch_dir(spark, "survey") + ".csv"
    tables.save_table(survey(spark, sf_dir), path)
    return plans.load_survey(spark, SPEC, path=path)


@query
def stream_ingest(spark, sf_dir):
    base = scratch_dir(spark, "ingest")
    lines = records.to_records(survey(spark, sf_dir), RECORD_COLUMNS)
    lines.write.text(f"{base}/lines")
    streaming.ingest(
        streaming.stream_lines(spark, f"{base}/lines"),
        tables.survey_schema(RECORD_COLUMNS),
        f"{base}/rows",
        f"{base}/checkpoint",
        available_now=True,
        timeout_seconds=600,
    )
    return spark.read.parquet(f"{base}/rows")


@query
def stream_malformed(spark, sf_dir):
    """Malformed records are kept as text beside the good ones."""
    base = scratch_dir(spark, "malformed")
    events = tables.load_table(spark, f"{sf_dir}/events.parquet")
    cut = F.when(F.col("event_id") % 9 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    events.select(cut.alias("value")).write.text(f"{base}/lines")
    streaming.ingest(
        streaming.stream_lines(spark, f"{base}/lines"), "k double, bad string", f"{base}/rows", f"{base}/checkpoint",
        available_now=True, timeout_seconds=600, corrupt="bad",
    )
    return spark.read.parquet(f"{base}/rows").agg(F.count("*").alias("n"), F.count("bad").alias("malformed"), F.sum(F.when(F.col("bad").isNull(), F.col("k"))).alias("k"))


@query
def stream_once(spark, sf_dir):
    """Records that come again in later files are stored once, also after a restart between the files."""
    base = scratch_dir(spark, "once")
    events = tables.load_table(spark, f"{sf_dir}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    schema, once = "event_id bigint, ts timestamp, value double", streaming.Once(["event_id"], "ts", "10000 days")
    # every third event twice in the first delivery, and all but every seventh again in the second
    first = events.where("event_id % 2 = 0 OR event_id % 3 = 0").withColumn("again", F.explode(F.expr("sequence(0, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END)"))).drop("again")
    for delivery in (first, events.where("event_id % 7 <> 0 OR event_id % 2 = 1")):
        records.to_records(delivery).write.mode("append").text(f"{base}/lines")
        streaming.ingest(
            streaming.stream_lines(spark, f"{base}/lines"), schema, f"{base}/rows", f"{base}/checkpoint", available_now=True, timeout_seconds=600, once=once
        )
    return spark.read.parquet(f"{base}/rows").select("event_id", "value")


@query
def stream_batches(spark, sf_dir):
    """Batches stored under their numbers, one of them run twice; what they counted on their way."""
    base = scratch_dir(spark, "batches")
    events = tables.load_table(spark, f"{sf_dir}/events.parquet").select("event_id", F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("value"))
    lines = records.to_records(events).select(F.when(F.get_json_object("value", "$.event_id").cast("long") % 9 == 0, "{").otherwise(F.col("value")).alias("value"))
    lines.write.text(f"{base}/lines")
    schema, paths = "event_id bigint, value double, bad string", (f"{base}/rows", f"{base}/counts")
    streaming.ingest_batches(
        streaming.stream_lines(spark, f"{base}/lines"), schema, paths[0], f"{base}/checkpoint", counts_path=paths[1], available_now=True, timeout_seconds=600, corrupt="bad"
    )
    again = records.parse_records(spark.read.text(f"{base}/lines"), schema, corrupt="bad")
    streaming.batch_writer(*paths, corrupt="bad")(again, 0)  # as after a failure before the batch was marked as done
    counts = streaming.batch_counts(spark, paths[1]).agg(F.sum("rows").alias("counted"), F.sum("malformed").alias("malformed"), F.sum(F.col("gaps")["value"]).alias("gaps"))
    stored = streaming.read_batches(spark, paths[0]).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("events"), F.sum("value").alias("total"))
    return rounded(stored.join(counts), 4, "total")


@query
def table_versions(spark, sf_dir):
    """A table that was replaced, and whose next replacement died: readers see the last complete version."""
    path = scratch_dir(spark, "versioned")
    orders = tables.load_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    tables.save_table(orders.where("o_orderkey % 2 = 0"), path, versioned=True)
    tables.save_table(orders.where("o_orderkey % 3 = 0"), path, versioned=True)
    broken = orders.select("o_orderkey", F.expr("CASE WHEN o_orderkey % 5 = 0 THEN raise_error('gone') ELSE o_totalprice END").cast("double").alias("o_totalprice"))
    try:
        tables.save_table(broken, path, versioned=True)
    except Exception as error:
        if "gone" not in str(error):
            raise
    return tables.load_table(spark, path)


@query
def full_run(spark, sf_dir):
    """The whole run over the survey: what its log says, and how well its best model does."""
    base = scratch_dir(spark, "run")
    rows = survey(spark, sf_dir).withColumn("bad", F.when(F.col("row_key") % 97 == 0, "{"))
    spec = SurveySpec("target", ("genhlth", "age", "sparse", "konst", "price", "target"), measured=("price",))
    tree = {"decision_tree": models.default_estimators()["decision_tree"]}
    run(spark, spec, rows, f"{base}/prepared", f"{base}/metrics", f"{base}/log", ranking_path=f"{base}/ranking", corrupt="bad", estimators=tree)
    logged = results.load_run_log(spark, f"{base}/log")
    counts = {name.replace(".", "_"): F.col("counts")[name].alias(name.replace(".", "_")) for name in ("read.rows", "read.malformed", "stored.rows", "gaps.genhlth", "gaps.age", "gaps.price")}
    best = results.load_metrics(spark, results.best_path(f"{base}/metrics"))
    first = tables.load_table(spark, f"{base}/ranking").orderBy(F.desc("mi")).limit(1)
    return logged.select("status", "model_count", F.size("step_durations_seconds").alias("steps"), *counts.values()).join(
        best.select(F.col("model").alias("best_model"), (F.col("accuracy") > 0.7).alias("learned"))
    ).join(first.select(F.col("feature").alias("first_feature")))


@query
def metrics_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "metrics")
    results.save_metrics(metrics.model_metrics(scored(spark, sf_dir)), path)
    return rounded(results.load_metrics(spark, path), 6, *metrics.METRIC_NAMES)


@query
def run_log(spark, sf_dir):
    path = scratch_dir(spark, "runs")
    with results.recorded_run(spark, path, {"use_kafka": False}) as record:
        with record.step("evaluate"):
            record.models_compared(metrics.rank_models(metrics.model_metrics(scored(spark, sf_dir))))
    return results.load_run_log(spark, path).select(
        "status",
        "model_count",
        F.col("best_model.model").alias("best_model"),
        F.round("best_model.f1", 6).alias("best_f1"),
        F.array_join("models", ",").alias("models"),
        F.size("step_durations_seconds").alias("steps"),
        F.col("parameters")["use_kafka"].alias("use_kafka"),
        "error_message",
    )


# --- projections, filters, column rules --------------------------------------


@query
def project_columns(spark, sf_dir):
    return columns.project_columns(survey(spark, sf_dir), SPEC)


@query
def drop_non_numeric(spark, sf_dir):
    orders = tables.load_table(spark, f"{sf_dir}/orders.parquet")
    return columns.drop_non_numeric(orders.withColumn("large", F.col("o_totalprice") > 100000))


@query
def cast_double(spark, sf_dir):
    events = tables.load_table(spark, f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value")
    text = events.withColumn("mixed", F.when(F.col("event_id") % 3 == 0, "bad").otherwise(F.col("user_id").cast("string")))
    return columns.cast_double(text, ["user_id", "event_type", "value", "mixed"])


@query
def recode_target(spark, sf_dir):
    return columns.recode_target(survey(spark, sf_dir).select("row_key", "target"), SPEC)


@query
def label_filter(spark, sf_dir):
    return columns.label_filter(survey(spark, sf_dir).select("row_key", "age", "target"), SPEC)


@query
def column_decisions(spark, sf_dir):
    rows = plans.labelled_numbers(survey(spark, sf_dir), SPEC)
    return rounded(columns.column_decisions(rows, SPEC), 6, "missing_pct")


@query
def drop_sparse(spark, sf_dir):
    return columns.drop_sparse(plans.labelled_numbers(survey(spark, sf_dir), SPEC), SPEC)


@query
def drop_constant(spark, sf_dir):
    return columns.drop_constant(plans.labelled_numbers(survey(spark, sf_dir), SPEC), SPEC)


@query
def label_int(spark, sf_dir):
    return columns.label_int(columns.label_filter(survey(spark, sf_dir).select("row_key", "target"), SPEC), SPEC)


@query
def numeric_columns(spark, sf_dir):
    lineitem = tables.load_table(spark, f"{sf_dir}/lineitem.parquet")
    return lineitem.select(*numeric_names(lineitem)[:4])


@query
def clean(spark, sf_dir):
    return plans.clean(survey(spark, sf_dir), SPEC)


@query
def training_frame(spark, sf_dir):
    return columns.rename_label(plans.training_frame(survey(spark, sf_dir), SPEC), SPEC)


@query
def prepare(spark, sf_dir):
    return plans.prepare(survey(spark, sf_dir), SPEC).table


@query
def feature_ranking(spark, sf_dir):
    return rounded(plans.prepare(survey(spark, sf_dir), SPEC).ranking(), 6, "mi")


# --- aggregates and statistics -----------------------------------------------


@query
def overview(spark, sf_dir):
    rows = survey(spark, sf_dir)
    return rounded(profile.overview(rows, metrics.model_metrics(scored(spark, sf_dir))), 6, "accuracy")


@query
def missing_stats(spark, sf_dir):
    return rounded(profile.missing_stats(labeled(spark, sf_dir)), 6, "missing_pct")


@query
def missing_report(spark, sf_dir):
    return profile.missing_report(survey(spark, sf_dir))


@query
def distinct_with_null(spark, sf_dir):
    return profile.distinct_with_null(survey(spark, sf_dir), ["target", *NUMBERS, "konst"])


@query
def median_fill(spark, sf_dir):
    rows = labeled(spark, sf_dir).select("row_key", "genhlth", "physhlth", "sparse")
    return columns.fill_missing(rows, medians(rows, ["genhlth", "physhlth", "sparse"]))


@query
def mean_impute(spark, sf_dir):
    rows = labeled(spark, sf_dir)
    train, test = models.split_by(rows, in_train())
    names = ["genhlth", "physhlth", "sparse"]
    filled = columns.fill_missing(test.select("row_key", *names), means(train, names))
    return rounded(filled, 6, *names)


@query
def describe(spark, sf_dir):
    table = profile.describe(labeled(spark, sf_dir), ["label", *NUMBERS])
    return rounded(table, 4, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def describe_one(spark, sf_dir):
    table = profile.describe(tables.load_table(spark, f"{sf_dir}/orders.parquet"), ["o_totalprice"])
    return rounded(table, 3, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def column_profile(spark, sf_dir):
    return profile.column_profile(survey(spark, sf_dir))


@query
def mutual_information(spark, sf_dir):
    rows = labeled(spark, sf_dir)
    return rounded(information.mutual_information(rows, FEATURES, "label", continuous=SPEC.continuous), 6, "mi")


@query
def information_many_values(spark, sf_dir):
    """Thousands of values, all of them counted."""
    rows = labeled(spark, sf_dir).withColumn("key_part", F.col("row_key") % 5000)
    return rounded(information.mutual_information(rows, ["price", "key_part", "age"], "label"), 6, "mi")


@query
def information_neighbours(spark, sf_dir):
    """Measured features by nearest neighbours, beside a coded one by its values."""
    rows = labeled(spark, sf_dir).withColumn("drift", F.col("price") + F.col("label") * 20000)
    ranking = information.mutual_information(rows, ["genhlth", "age", "physhlth", "price", "drift"], "label", measured=["age", "physhlth", "price", "drift"])
    return rounded(ranking, 6, "mi")


@query
def top_features(spark, sf_dir):
    ranking = plans.prepare(survey(spark, sf_dir), SPEC).ranking()
    return rounded(information.top_features(ranking, 3), 6, "mi")


@query
def corr_matrix(spark, sf_dir):
    return rounded(correlation.corr_matrix(labeled(spark, sf_dir), ["label", *NUMBERS, "konst"]), 6, "r")


@query
def top_correlations(spark, sf_dir):
    return rounded(correlation.top_correlations(labeled(spark, sf_dir), ["label", *NUMBERS]), 6, "r")


@query
def pair_corr(spark, sf_dir):
    return rounded(correlation.pair_corr(survey(spark, sf_dir), "genhlth", "price"), 6, "r")


@query
def histogram(spark, sf_dir):
    return rounded(distribution.histogram(labeled(spark, sf_dir), ["age", "physhlth", "price"]), 4, "low", "high")


@query
def kde(spark, sf_dir):
    table = distribution.kde(labeled(spark, sf_dir), ["genhlth", "age", "physhlth", "price"])
    return rounded(rounded(table, 4, "x"), 9, "density")


@query
def kde_binned(spark, sf_dir):
    """Density from fine bins, and whether it is as near to the exact one as its bound says."""
    rows, names = labeled(spark, sf_dir), ["age", "physhlth", "price"]
    table = distribution.kde_binned(rows, names)
    exact = distribution.kde(rows, names).select("column", "point", F.col("density").alias("exact"))
    near = table.join(exact, ["column", "point"]).withColumn("within", F.abs(F.col("density") - F.col("exact")) <= F.col("error_bound") * (1 + 1e-9))
    return rounded(rounded(near.drop("exact", "error_bound"), 4, "x"), 9, "density")


@query
def scatter_sample(spark, sf_dir):
    return rounded(distribution.scatter_sample(survey(spark, sf_dir), "physhlth", "price", 500, by=["row_key"]), 2, "y")


@query
def quantiles_as_records_arrive(spark, sf_dir):
    """Exact quartiles of all batches of a stream, which start from the sketches that were stored with each batch."""
    base = scratch_dir(spark, "arriving")
    records.to_records(labeled(spark, sf_dir), ["age", "price", "sparse"]).repartition(3).write.text(f"{base}/lines")
    lines = streaming.stream_lines(spark, f"{base}/lines", maxFilesPerTrigger="1")
    streaming.ingest_batches(
        lines, "age double, price double, sparse double", f"{base}/rows", f"{base}/checkpoint", sketches_path=f"{base}/sketches", available_now=True, timeout_seconds=600
    )
    names = ["age", "price", "sparse"]
    found = exact_quantiles(streaming.read_batches(spark, f"{base}/rows"), names, [0.25, 0.5, 0.75], sketches=streaming.read_batches(spark, f"{base}/sketches"))
    return rounded(spark.createDataFrame([(c, *found[c]) for c in names], "column string, q25 double, q50 double, q75 double"), 4, "q25", "q50", "q75")


@query
def box_stats(spark, sf_dir):
    table = distribution.box_stats(labeled(spark, sf_dir), ["age", "physhlth", "price"])
    return rounded(table, 4, "q1", "median", "q3", "lower_whisker", "upper_whisker")


@query
def box_stats_events(spark, sf_dir):
    table = distribution.box_stats(tables.load_table(spark, f"{sf_dir}/events.parquet"), ["value", "user_id"])
    return rounded(table, 4, "q1", "median", "q3", "lower_whisker", "upper_whisker")


@query
def box_outliers(spark, sf_dir):
    events = tables.load_table(spark, f"{sf_dir}/events.parquet").select("event_id", "value")
    return rounded(distribution.box_outliers(events, "value"), 4, "value")


@query
def ols_trend(spark, sf_dir):
    table = distribution.ols_trend(labeled(spark, sf_dir), "age", "price")
    return rounded(table, 4, "slope", "intercept", "r2")


@query
def ols_fitted(spark, sf_dir):
    return rounded(distribution.ols_fitted(labeled(spark, sf_dir), "age", "price"), 4, "fitted")


@query
def scatter_points(spark, sf_dir):
    return distribution.scatter_points(survey(spark, sf_dir), "physhlth", "price")


@query
def scatter_bins(spark, sf_dir):
    return distribution.scatter_bins(labeled(spark, sf_dir), "age", "price", 20)


# --- sorts, limits, rankings -------------------------------------------------


@query
def preview(spark, sf_dir):
    return profile.preview(survey(spark, sf_dir), ["row_key", "price", "age", "physhlth"])


@query
def rank_models(spark, sf_dir):
    ranked = metrics.rank_models(metrics.model_metrics(scored(spark, sf_dir)))
    return rounded(ranked, 6, *metrics.METRIC_NAMES)


@query
def best_model(spark, sf_dir):
    return rounded(metrics.best_model(metrics.model_metrics(scored(spark, sf_dir))), 6, *metrics.METRIC_NAMES)


# --- metrics -----------------------------------------------------------------


@query
def metric_accuracy(spark, sf_dir):
    return rounded(metrics.classification_metrics(scored(spark, sf_dir)).select("model", "accuracy"), 6, "accuracy")


@query
def metric_f1(spark, sf_dir):
    return rounded(metrics.classification_metrics(scored(spark, sf_dir)).select("model", "f1"), 6, "f1")


@query
def metric_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scored(spark, sf_dir)), 6, "roc_auc")


@query
def metric_auc_distinct_scores(spark, sf_dir):
    rows = labeled(spark, sf_dir).select(
        F.lit("price").alias("model"), "label", (F.col("price") + F.col("row_key") * 1e-6).alias("score")
    )
    return rounded(metrics.roc_auc(rows), 6, "roc_auc")


@query
def metric_auc_gaps(spark, sf_dir):
    """Null and NaN scores rank nowhere."""
    nan, null = F.lit(float("nan")), F.lit(None).cast("double")
    score = F.when(F.col("row_key") % 7 == 0, nan).when(F.col("row_key") % 11 == 0, null).otherwise(F.col("age"))
    return rounded(metrics.roc_auc(labeled(spark, sf_dir).select(F.lit("gaps").alias("model"), "label", score.alias("score"))), 6, "roc_auc")


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir))


@query
def metric_prf(spark, sf_dir):
    names = ["precision", "recall", "specificity", "f1_positive"]
    return rounded(metrics.classification_metrics(scored(spark, sf_dir)).select("model", *names), 6, *names)


@query
def metric_grade(spark, sf_dir):
    return rounded(metrics.metric_grade(metrics.classification_metrics(scored(spark, sf_dir))), 6, "accuracy")


@query
def metric_bars(spark, sf_dir):
    return rounded(metrics.metric_bars(metrics.model_metrics(scored(spark, sf_dir))), 6, "height")


# --- splitting and models ----------------------------------------------------


@query
def split_counts(spark, sf_dir):
    return models.split_counts(labeled(spark, sf_dir), in_train())


@query
def assemble(spark, sf_dir):
    train, test = models.split_by(labeled(spark, sf_dir), in_train())
    layout = models.fit_features(train, FEATURES)
    vector = vector_to_array("features")
    rows = layout.assemble(test, "row_key", "label").select(
        "row_key", "label", *[vector[i].alias(f) for i, f in enumerate(layout.features)]
    )
    return rounded(rows, 6, *layout.features)


@query
def split_by_key(spark, sf_dir):
    """The library's own split by a key: every copy of a key lies on one side."""
    train, test = models.split(labeled(spark, sf_dir).select("row_key"), "row_key")
    sides = train.withColumn("side", F.lit(1)).union(test.withColumn("side", F.lit(0)))
    keys = sides.groupBy("row_key").agg(F.count_distinct("side").alias("sides"), F.count("*").alias("n"), F.avg("side").alias("train"))
    return keys.agg(
        F.sum("n").alias("n"), F.count("*").alias("keys"), F.max("sides").alias("sides"), F.avg("train").between(0.77, 0.83).alias("near_share")
    )


def _coded(spark, sf_dir):
    """Rows with one coded feature; the label follows it but for some noise."""
    return models.split_by(labeled(spark, sf_dir).where("genhlth IS NOT NULL").select("row_key", "genhlth", "label"), in_train())


CODES = ["genhlth", "tenth"]


def _two_codes(spark, sf_dir):
    """Rows with two coded features, of five and about ten codes; the label is a staircase over both."""
    rows = labeled(spark, sf_dir).where("genhlth IS NOT NULL").withColumn("tenth", F.floor(F.col("price") / 10000).cast("double"))
    return models.split_by(rows.withColumn("label", (2 * F.col("genhlth") + F.col("tenth") > 12).cast("double")).select("row_key", *CODES, "label"), in_train())


@query
def model_logistic(spark, sf_dir):
    """Score equations: over the training rows, predicted and true labels agree in sum, and in sum with each feature as weight."""
    train, _ = models.split_by(labeled(spark, sf_dir), in_train())
    layout = models.fit_features(train, FEATURES)
    rows = layout.assemble(train, "row_key", "label")
    fitted = models.fit_models(rows.select("label", "features"), {"logistic_regression": models.default_estimators()["logistic_regression"]})
    scored_rows = fitted["logistic_regression"].transform(rows)
    x, p = vector_to_array("features"), vector_to_array("probability")[1]
    weights = {"intercept": F.lit(1.0), **{f: x[i] for i, f in enumerate(layout.features)}}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), (w * F.col("label")).alias("y"), (w * p).alias("p"), F.abs(w).alias("size")) for n, w in weights.items()]))
    sums = scored_rows.select(each.alias("s")).groupBy("s.feature").agg(F.avg("s.y").alias("y"), F.avg("s.p").alias("p"), F.avg("s.size").alias("size"))
    return sums.select("feature", F.round("y", 4).alias("mean_y"), (F.abs(F.col("y") - F.col("p")) < F.col("size") * 1e-4).alias("agrees"))


@query
def model_tree(spark, sf_dir):
    """A tree over one code whose halves differ: the probability is the share of positives in the half."""
    train, _ = _coded(spark, sf_dir)
    train = train.withColumn("code", F.col("genhlth"))
    rows = models.fit_features(train, ["genhlth"]).assemble(train, "code", "label")
    tree = models.fit_models(rows.select("label", "features"), {"decision_tree": models.default_estimators()["decision_tree"]})
    scored_rows = models.score(rows, tree, "code", by="probability")
    return rounded(scored_rows.groupBy(F.col("code").alias("genhlth")).agg(F.max("prediction").alias("prediction"), F.max("score").alias("score")), 6, "score")


@query
def model_tree_codes(spark, sf_dir):
    """A tree over two codes that only both together explain: each cell has its own share of positives."""
    train, _ = _two_codes(spark, sf_dir)
    train = train.withColumns({f"own_{c}": F.col(c) for c in CODES})
    rows = models.fit_features(train, CODES).assemble(train, *[f"own_{c}" for c in CODES], "label")
    tree = models.fit_models(rows.select("label", "features"), {"decision_tree": models.default_estimators()["decision_tree"]})
    cells = models.score(rows, tree, *[f"own_{c}" for c in CODES], by="probability").groupBy(*[F.col(f"own_{c}").alias(c) for c in CODES])
    return rounded(cells.agg(F.max("prediction").alias("prediction"), F.min("score").alias("least"), F.max("score").alias("most")), 6, "least", "most")


@query
def model_compare_codes(spark, sf_dir):
    """Models of two codes on two numbers of partitions: the same metrics but for the forest's draws of rows."""
    train, test = _two_codes(spark, sf_dir)
    one, other = (models.compare_models(train, test, CODES, partitions=n).select("model", "accuracy") for n in (64, 16))
    both = one.join(other.withColumnRenamed("accuracy", "other"), "model")
    near = F.abs(F.col("accuracy") - F.col("other")) < F.when(F.col("model") == "random_forest", 0.02).otherwise(1e-6)
    return both.select("model", near.alias("near"), (F.col("accuracy") > 0.9).alias("learned")).join(test.agg(F.count("*").alias("tested")))


@query
def model_forest(spark, sf_dir):
    """A label without noise is predicted without error."""
    train, test = (side.withColumn("label", (F.col("genhlth") > 3).cast("double")) for side in _coded(spark, sf_dir))
    layout = models.fit_features(train, ["genhlth"])
    forest = models.fit_models(layout.assemble(train, "label"), {"random_forest": models.default_estimators()["random_forest"]})
    return metrics.confusion_matrix(models.score(layout.assemble(test, "label"), forest))


@query
def model_compare(spark, sf_dir):
    return rounded(models.compare_models(*_coded(spark, sf_dir), ["genhlth"]), 6, *metrics.METRIC_NAMES)


@query
def predictions(spark, sf_dir):
    train, test = _coded(spark, sf_dir)
    layout = models.fit_features(train, ["genhlth"])
    tree = models.fit_models(layout.assemble(train, "label"), {"decision_tree": models.default_estimators()["decision_tree"]})
    return models.score(layout.assemble(test, "row_key", "label"), tree, "row_key")
