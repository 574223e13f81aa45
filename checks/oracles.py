"""SQL with the expected result of each query, for DuckDB on the same tables.

Doubles are rounded like in the query; both engines add in different orders.
"""

from __future__ import annotations

from checks.survey import LABELED_SQL, MIXED, SCORED_SQL, SURVEY_SQL

ORACLES: dict[str, str] = {}

KNOWN = "FROM survey WHERE target IS NOT NULL AND target NOT IN (7,9)"
LABEL = "CASE WHEN target=2 THEN CAST(0 AS DOUBLE) ELSE CAST(target AS DOUBLE) END"
GAP_FREE = (
    LABELED_SQL
    + """, med AS (SELECT quantile_cont(genhlth, 0.5) AS genhlth, quantile_cont(physhlth, 0.5) AS physhlth,
    quantile_cont(sparse, 0.5) AS sparse FROM labeled),
filled AS (SELECT row_key, coalesce(l.genhlth, m.genhlth) AS genhlth, l.age, coalesce(l.physhlth, m.physhlth) AS physhlth,
    coalesce(l.sparse, m.sparse) AS sparse, l.price, l.label FROM labeled l CROSS JOIN med m)"""
)


def long_form(table: str, names: list[str], extra: str = "") -> str:
    """(feature, value) rows of the given columns."""
    return " UNION ALL ".join(
        f"SELECT {i} AS pos, '{c}' AS feature, CAST({c} AS DOUBLE) AS value{extra} FROM {table}"
        for i, c in enumerate(names)
    )


RAW = "row_key, CAST(target AS INTEGER) AS target, genhlth, age, physhlth, sparse, price, flag"
RECORDS = "CAST(target AS DOUBLE) AS target, genhlth, age, physhlth, sparse, konst, price"

ORACLES["parquet_scan"] = (
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag FROM lineitem"
)
ORACLES["csv_roundtrip"] = f"{SURVEY_SQL} SELECT {RAW} FROM survey"
ORACLES["parquet_roundtrip"] = ORACLES["csv_roundtrip"]
ORACLES["records_json"] = (
    GAP_FREE
    + """ SELECT '{"genhlth":' || genhlth || ',"age":' || age || ',"physhlth":' || physhlth || ',"sparse":' || sparse
|| ',"price":' || price || ',"target":' || CAST(label AS INTEGER) || '}' AS value FROM filled"""
)
ORACLES["json_decode"] = f"{SURVEY_SQL} SELECT row_key, {RECORDS} FROM survey"
ORACLES["json_decode_events"] = (
    "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events"
)
ORACLES["stream_ingest"] = f"{SURVEY_SQL} SELECT {RECORDS} FROM survey"
ORACLES["stream_malformed"] = """SELECT count(*) AS n, count(*) FILTER (event_id % 9 = 0) AS malformed,
sum(CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract(props, '$.k') AS DOUBLE) END) AS k FROM events"""
ORACLES["clean"] = GAP_FREE + (
    " SELECT genhlth, age, physhlth, sparse, price, CAST(label AS INTEGER) AS target FROM filled"
)
ORACLES["load_survey"] = ORACLES["clean"]

# --- projections, filters, column rules
ORACLES["project_columns"] = (
    f"{SURVEY_SQL} SELECT genhlth, age, physhlth, sparse, konst, price, flag, CAST(target AS INTEGER) AS target FROM survey"
)
ORACLES["drop_non_numeric"] = (
    "SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_totalprice > 100000 THEN CAST(1 AS DOUBLE) "
    "ELSE CAST(0 AS DOUBLE) END AS large FROM orders"
)
ORACLES["cast_double"] = """SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, TRY_CAST(event_type AS DOUBLE) AS event_type,
value, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS mixed FROM events"""
ORACLES["recode_target"] = (
    f"{SURVEY_SQL} SELECT row_key, CASE WHEN target IN (7,9) THEN NULL ELSE {LABEL} END AS target FROM survey"
)
ORACLES["label_filter"] = f"{SURVEY_SQL} SELECT row_key, age, {LABEL} AS target {KNOWN}"
ORACLES["label_int"] = f"{LABELED_SQL} SELECT row_key, CAST(label AS INTEGER) AS target FROM labeled"
_DECIDED = ["genhlth", "age", "physhlth", "sparse", "konst", "price", "label"]
ORACLES["column_decisions"] = f"""{LABELED_SQL}, cells AS ({long_form("labeled", _DECIDED)}),
facts AS (SELECT feature, count(value) AS non_null, 100.0::DOUBLE * (count(*) - count(value)) / count(*) AS missing_pct,
  count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) = 1 AS is_constant FROM cells GROUP BY feature)
SELECT CASE WHEN feature = 'label' THEN 'target' ELSE feature END AS "column", non_null, round(missing_pct, 6) AS missing_pct,
  is_constant, feature = 'label' OR NOT (missing_pct > 40 OR is_constant) AS kept FROM facts"""
ORACLES["drop_sparse"] = f"{LABELED_SQL} SELECT genhlth, age, physhlth, konst, price, label AS target FROM labeled"
ORACLES["drop_constant"] = f"{LABELED_SQL} SELECT genhlth, age, physhlth, sparse, price, label AS target FROM labeled"
ORACLES["numeric_columns"] = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem"
ORACLES["training_frame"] = (
    f"{LABELED_SQL} SELECT genhlth, age, physhlth, sparse, konst, price, TRY_CAST(flag AS DOUBLE) AS flag, label FROM labeled"
)
ORACLES["prepare"] = GAP_FREE + " SELECT genhlth, age, physhlth, price, label AS target FROM filled"

# --- aggregates and statistics
ORACLES["missing_stats"] = f"""{LABELED_SQL}, cells AS (
{long_form("labeled", ["genhlth", "physhlth", "sparse", "age", "price", "konst", "label"])})
SELECT feature AS "column", count(*) - count(value) AS missing,
  round(100.0::DOUBLE * (count(*) - count(value)) / count(*), 6) AS missing_pct
FROM cells GROUP BY feature HAVING count(*) > count(value) ORDER BY missing DESC"""
ORACLES["missing_report"] = f"""{SURVEY_SQL}, cells AS (
{long_form("survey", ["target", "genhlth", "physhlth", "sparse", "age", "price", "konst"])})
SELECT feature AS "column", count(*) - count(value) AS missing,
  round(100.0::DOUBLE * (count(*) - count(value)) / count(*), 2) AS missing_pct
FROM cells GROUP BY pos, feature HAVING count(*) > count(value) ORDER BY pos"""
ORACLES["distinct_with_null"] = f"""{SURVEY_SQL}, cells AS (
{long_form("survey", ["target", "genhlth", "age", "physhlth", "sparse", "price", "konst"])})
SELECT feature AS "column", count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS distinct_values
FROM cells GROUP BY feature"""
ORACLES["median_fill"] = GAP_FREE + " SELECT row_key, genhlth, physhlth, sparse FROM filled"
ORACLES["mean_impute"] = (
    LABELED_SQL
    + """, m AS (SELECT avg(genhlth) AS genhlth, avg(physhlth) AS physhlth, avg(sparse) AS sparse
  FROM labeled WHERE (row_key // 20) % 10 < 8)
SELECT row_key, round(coalesce(l.genhlth, m.genhlth), 6) AS genhlth, round(coalesce(l.physhlth, m.physhlth), 6) AS physhlth,
  round(coalesce(l.sparse, m.sparse), 6) AS sparse FROM labeled l CROSS JOIN m WHERE (row_key // 20) % 10 >= 8"""
)


def _describe(digits: int) -> str:
    figures = {
        "mean": "avg(value)",
        "std": "stddev_samp(value)",
        "min": "min(value)",
        "q25": "quantile_cont(value, 0.25)",
        "q50": "quantile_cont(value, 0.5)",
        "q75": "quantile_cont(value, 0.75)",
        "max": "max(value)",
    }
    listed = ", ".join(f'round({sql}, {digits}) AS "{name}"' for name, sql in figures.items())
    return f'SELECT feature AS "column", count(value) AS "count", {listed} FROM cells GROUP BY feature'


ORACLES["describe"] = (
    f"{LABELED_SQL}, cells AS ({long_form('labeled', ['label', 'genhlth', 'age', 'physhlth', 'sparse', 'price'])}) "
    + _describe(4)
)
ORACLES["describe_one"] = f"WITH cells AS ({long_form('orders', ['o_totalprice'])}) " + _describe(3)
ORACLES["column_profile"] = SURVEY_SQL + "".join(
    f"{' UNION ALL' if i else ''} SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, "
    f"count(*) - count({c}) AS nulls FROM survey"
    for i, (c, t) in enumerate(
        {
            "row_key": "bigint", "target": "int", "genhlth": "double", "age": "double", "physhlth": "double",
            "sparse": "double", "konst": "double", "price": "double", "flag": "string",
        }.items()
    )
)


def _information(cells: str, tail: str = "") -> str:
    """Plug-in mutual information of (feature, value, label) rows; price is binned unless named otherwise."""
    return f""", cells AS ({cells}),
c AS (SELECT feature, value, label, CAST(count(*) AS DOUBLE) AS n FROM cells WHERE value IS NOT NULL GROUP BY ALL),
w AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, value) AS nv,
  sum(n) OVER (PARTITION BY feature, label) AS ny FROM c)
SELECT feature, round(sum(n / t * ln(n * t / (nv * ny))), 6) AS mi, feature = 'price' AS binned FROM w
GROUP BY feature ORDER BY mi DESC {tail}"""


def _binned_information(table: str, tail: str = "") -> str:
    binned = f""", span AS (SELECT min(price) AS lo, max(price) AS hi FROM {table}),
binned AS (SELECT genhlth, age, physhlth, label,
  CASE WHEN price IS NULL THEN NULL ELSE least(49, floor((price - lo) / (hi - lo) * 50.0::DOUBLE)) END AS price
  FROM {table} CROSS JOIN span)"""
    return binned + _information(long_form("binned", ["genhlth", "age", "physhlth", "price"], ", label"), tail)


ORACLES["mutual_information"] = LABELED_SQL + _binned_information("labeled")
ORACLES["feature_ranking"] = GAP_FREE + _binned_information("filled")
ORACLES["top_features"] = GAP_FREE + _binned_information("filled", "LIMIT 3")
ORACLES["information_many_values"] = (
    f"{LABELED_SQL}, keyed AS (SELECT *, row_key % 5000 AS key_part FROM labeled)"
    + _information(long_form("keyed", ["price", "key_part", "age"], ", label")).replace("feature = 'price'", "FALSE")
)


_NEAR = ["age", "physhlth", "price", "drift"]
_SIDES = [f"lag(value, {i}) OVER w AS l{i}, lead(value, {i}) OVER w AS r{i}" for i in (1, 2, 3)]
_WAYS = ["r3 - value", "greatest(value - l1, r2 - value)", "greatest(value - l2, r1 - value)", "value - l3"]
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, label FROM drifted WHERE {c} IS NOT NULL" for c in _NEAR)
# all classes have more than three rows here; a neighbour that is absent must not count as one at no distance
_ABSENT = ["r3 IS NULL", "l1 IS NULL OR r2 IS NULL", "l2 IS NULL OR r1 IS NULL", "l3 IS NULL"]
ORACLES["information_neighbours"] = f"""{LABELED_SQL}, drifted AS (SELECT *, price + label * 20000 AS drift FROM labeled),
long AS ({_LONG}),
near AS (SELECT *, {", ".join(_SIDES)}, count(*) OVER (PARTITION BY feature, label) AS ny FROM long WINDOW w AS (PARTITION BY feature, label ORDER BY value)),
reach AS (SELECT *, least({", ".join(f"CASE WHEN {a} THEN 'infinity'::DOUBLE ELSE {w} END" for a, w in zip(_ABSENT, _WAYS))}) AS d FROM near),
point AS (
  SELECT feature, label, value, ny, d, count(*) AS n,
    max(coalesce({", ".join(f"CASE WHEN value - l{i} = d THEN l{i} END" for i in (1, 2, 3))}, value - d)) AS low,
    min(coalesce({", ".join(f"CASE WHEN r{i} - value = d THEN r{i} END" for i in (1, 2, 3))}, value + d)) AS high
  FROM reach GROUP BY feature, label, value, ny, d),
whole AS (SELECT feature, value, count(*) AS n FROM long GROUP BY feature, value),
inside AS (
  SELECT p.feature, p.label, p.value, p.n, p.ny, sum(w.n) AS m FROM point p JOIN whole w
    ON p.feature = w.feature AND w.value > p.low AND w.value < p.high WHERE p.d > 0 GROUP BY ALL
  UNION ALL SELECT p.feature, p.label, p.value, p.n, p.ny, w.n FROM point p JOIN whole w ON p.feature = w.feature AND p.value = w.value WHERE p.d = 0),
psi AS (
  SELECT i AS place, sum(CASE WHEN i > 1 THEN 1.0::DOUBLE / (i - 1) ELSE 0 END) OVER (ORDER BY i) - 0.5772156649015329::DOUBLE AS psi
  FROM (SELECT unnest(range(1, (SELECT count(*) + 2 FROM labeled))) AS i)),
terms AS (
  SELECT feature, sum(n) AS n_rows, sum(n * (k.psi - a.psi - b.psi)) AS total
  FROM inside JOIN psi k ON k.place = 3 JOIN psi a ON a.place = ny JOIN psi b ON b.place = m GROUP BY feature),
ranked AS (SELECT feature, greatest(psi + total / n_rows, 0) AS mi FROM terms JOIN psi ON place = n_rows),
coded AS (SELECT genhlth AS value, label, count(*) AS n FROM labeled WHERE genhlth IS NOT NULL GROUP BY ALL),
plain AS (
  SELECT sum(n / t * ln(n * t / (nv * ny))) AS mi FROM (
    SELECT n::DOUBLE AS n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY value) AS nv, sum(n) OVER (PARTITION BY label) AS ny FROM coded))
SELECT feature, round(mi, 6) AS mi, FALSE AS binned FROM ranked UNION ALL SELECT 'genhlth', round(mi, 6), FALSE FROM plain"""


def _pairs(names: list[str], keep) -> str:
    parts = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            if keep(i, j):
                x = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
                y = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
                parts.append(
                    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, count({x}) AS n, round(covar_samp({x}, {y}) / "
                    f"nullif(stddev_samp({x}) * stddev_samp({y}), 0), 6) AS r FROM labeled"
                )
    return " UNION ALL ".join(parts)


ORACLES["corr_matrix"] = (
    f"{LABELED_SQL} {_pairs(['label', 'genhlth', 'age', 'physhlth', 'sparse', 'price', 'konst'], lambda i, j: True)}"
)
ORACLES["top_correlations"] = (
    f"{LABELED_SQL}, pairs AS ({_pairs(['label', 'genhlth', 'age', 'physhlth', 'sparse', 'price'], lambda i, j: i < j)}) "
    "SELECT feature_1, feature_2, r FROM pairs ORDER BY abs(r) DESC LIMIT 10"
)
ORACLES["pair_corr"] = f"{SURVEY_SQL} SELECT round(corr(genhlth, price), 6) AS r FROM survey"
ORACLES["histogram"] = f"""{LABELED_SQL}, cells AS ({long_form("labeled", ["age", "physhlth", "price"])}),
span AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM cells GROUP BY feature),
b AS (SELECT feature, lo, (hi - lo) / 50.0::DOUBLE AS width,
  CAST(least(49, floor((value - lo) / (hi - lo) * 50.0::DOUBLE)) AS INTEGER) AS bin
  FROM cells JOIN span USING (feature) WHERE value IS NOT NULL)
SELECT feature AS "column", bin, round(lo + bin * width, 4) AS low, round(lo + (bin + 1) * width, 4) AS high, count(*) AS n
FROM b GROUP BY feature, bin, lo, width"""
ORACLES["kde"] = f"""{LABELED_SQL}, cells AS ({long_form("labeled", ["genhlth", "age", "physhlth", "price"])}),
f AS (SELECT feature, CAST(count(value) AS DOUBLE) AS n, min(value) AS lo, (max(value) - min(value)) / 199.0::DOUBLE AS step,
  stddev_samp(value) * power(count(value), -0.2::DOUBLE) AS h FROM cells GROUP BY feature),
v AS (SELECT feature, value, CAST(count(*) AS DOUBLE) AS w FROM cells WHERE value IS NOT NULL GROUP BY feature, value),
s AS (SELECT v.feature, g.point, any_value(lo + g.point * step) AS x,
  sum(w * exp(-0.5::DOUBLE * power((lo + g.point * step - value) / h, 2))) / any_value(n * h * sqrt(2 * pi())) AS density
  FROM v JOIN f USING (feature) CROSS JOIN (SELECT CAST(range AS INTEGER) AS point FROM range(200)) g GROUP BY v.feature, g.point)
SELECT feature AS "column", point, round(x, 4) AS x, round(density, 9) AS density FROM s"""
_HAZEN = """, ranked AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS rk,
  count(*) OVER (PARTITION BY feature) AS n FROM cells WHERE value IS NOT NULL),
spots AS (SELECT DISTINCT feature, q, least(greatest(n * q - 0.5::DOUBLE, 0), n - 1) AS spot
  FROM ranked CROSS JOIN (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) AS qs(q)),
points AS (SELECT s.feature, s.q, sum(CASE WHEN rk = floor(spot) AND rk = ceil(spot) THEN value
    WHEN rk = floor(spot) THEN value * (1 - (spot - floor(spot))) ELSE value * (spot - floor(spot)) END) AS x
  FROM spots s JOIN ranked r ON r.feature = s.feature AND (rk = floor(spot) OR rk = ceil(spot)) GROUP BY s.feature, s.q),
box AS (SELECT feature, max(CASE WHEN q = 0.25 THEN x END) AS q1, max(CASE WHEN q = 0.5 THEN x END) AS median,
  max(CASE WHEN q = 0.75 THEN x END) AS q3 FROM points GROUP BY feature),
fence AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM box)"""
ORACLES["box_stats"] = f"""{LABELED_SQL}, cells AS ({long_form("labeled", ["age", "physhlth", "price"])}){_HAZEN}
SELECT feature AS "column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(least(q1, min(CASE WHEN value >= lo THEN value END)), 4) AS lower_whisker,
  round(greatest(q3, max(CASE WHEN value <= hi THEN value END)), 4) AS upper_whisker,
  count(CASE WHEN value < lo OR value > hi THEN 1 END) AS outliers
FROM cells JOIN fence USING (feature) GROUP BY feature, q1, median, q3"""
ORACLES["box_stats_events"] = ORACLES["box_stats"].replace(
    f"{LABELED_SQL}, cells AS ({long_form('labeled', ['age', 'physhlth', 'price'])})",
    f"WITH cells AS ({long_form('events', ['value', 'user_id'])})",
)
ORACLES["box_outliers"] = f"""WITH cells AS (SELECT 'value' AS feature, value FROM events){_HAZEN}
SELECT event_id, round(value, 4) AS value FROM events CROSS JOIN fence WHERE value < lo OR value > hi"""
ORACLES["ols_trend"] = f"""{LABELED_SQL} SELECT round(regr_slope(price, age), 4) AS slope,
round(regr_intercept(price, age), 4) AS intercept, round(regr_r2(price, age), 4) AS r2, count(*) AS n
FROM labeled WHERE age IS NOT NULL AND price IS NOT NULL"""
ORACLES["ols_fitted"] = f"""{LABELED_SQL}, line AS (SELECT regr_slope(price, age) AS slope,
regr_intercept(price, age) AS intercept FROM labeled)
SELECT age AS x, price AS y, round(intercept + slope * age, 4) AS fitted FROM labeled CROSS JOIN line
WHERE age IS NOT NULL AND price IS NOT NULL"""
ORACLES["scatter_points"] = (
    f"{SURVEY_SQL} SELECT physhlth AS x, price AS y FROM survey WHERE physhlth IS NOT NULL AND price IS NOT NULL"
)
ORACLES["scatter_bins"] = f"""{LABELED_SQL}, span AS (SELECT min(age) AS xl, max(age) AS xh, min(price) AS yl,
max(price) AS yh FROM labeled WHERE age IS NOT NULL AND price IS NOT NULL)
SELECT CAST(least(19, floor((age - xl) / (xh - xl) * 20.0::DOUBLE)) AS INTEGER) AS x_bin,
  CAST(least(19, floor((price - yl) / (yh - yl) * 20.0::DOUBLE)) AS INTEGER) AS y_bin, count(*) AS n
FROM labeled CROSS JOIN span WHERE age IS NOT NULL AND price IS NOT NULL GROUP BY 1, 2"""

# --- sorts, limits, rankings
ORACLES["preview"] = f"""{SURVEY_SQL} SELECT row_key, CAST(target AS INTEGER) AS target, genhlth, age, physhlth, sparse, konst,
price, flag FROM survey ORDER BY row_key NULLS FIRST, price NULLS FIRST, age NULLS FIRST, physhlth NULLS FIRST LIMIT 5"""

CELLS = (
    SCORED_SQL
    + """, cm AS (SELECT model, CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
  CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM scored GROUP BY model),
m AS (SELECT model, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
  ((tp + fn) * 2 * tp / (2 * tp + fp + fn) + (tn + fp) * 2 * tn / (2 * tn + fp + fn)) / (tp + tn + fp + fn) AS f1,
  tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, tn / nullif(tn + fp, 0) AS specificity,
  2 * tp / (2 * tp + fp + fn) AS f1_positive FROM cm)"""
)


def _auc(table: str) -> str:
    return f"""by_score AS (SELECT model, score, CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS n
  FROM {table} GROUP BY model, score),
below AS (SELECT model, p, n, sum(n) OVER (PARTITION BY model ORDER BY score) - n AS lower_n FROM by_score),
auc AS (SELECT model, sum(p * (lower_n + n / 2)) / (sum(p) * sum(n)) AS roc_auc FROM below GROUP BY model)"""


METRICS = (
    f"{CELLS}, {_auc('scored')}, metrics AS (SELECT m.*, roc_auc FROM m JOIN auc USING (model))"
)
NAMES = ("accuracy", "precision", "recall", "f1", "roc_auc", "specificity")
ROUNDED = "model, " + ", ".join(f"round({n}, 6) AS {n}" for n in NAMES)
BEST = "ORDER BY metrics.f1 DESC, metrics.roc_auc DESC, metrics.accuracy DESC, model"

ORACLES["rank_models"] = f"{METRICS} SELECT {ROUNDED} FROM metrics {BEST}"
ORACLES["best_model"] = f"{METRICS} SELECT {ROUNDED} FROM metrics {BEST} LIMIT 1"
ORACLES["metrics_roundtrip"] = f"{METRICS} SELECT {ROUNDED} FROM metrics"
ORACLES["run_log"] = f"""{METRICS}, best AS (SELECT * FROM metrics {BEST} LIMIT 1)
SELECT 'success' AS status, CAST(3 AS INTEGER) AS model_count, model AS best_model, round(f1, 6) AS best_f1,
(SELECT string_agg(model, ',' {BEST}) FROM metrics) AS models, CAST(1 AS INTEGER) AS steps, 'False' AS use_kafka,
CAST(NULL AS VARCHAR) AS error_message FROM best"""
ORACLES["overview"] = f"""{METRICS} SELECT (SELECT count(*) FROM survey) AS records, CAST(9 AS INTEGER) AS features,
(SELECT round(accuracy, 6) FROM metrics {BEST} LIMIT 1) AS accuracy, (SELECT count(*) FROM metrics) AS models,
TRUE AS data_available, TRUE AS metrics_available"""

# --- metrics
ORACLES["metric_accuracy"] = f"{CELLS} SELECT model, round(accuracy, 6) AS accuracy FROM m"
ORACLES["metric_f1"] = f"{CELLS} SELECT model, round(f1, 6) AS f1 FROM m"
ORACLES["metric_auc"] = f"{SCORED_SQL}, {_auc('scored')} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc"
ORACLES["metric_auc_distinct_scores"] = f"""{LABELED_SQL}, priced AS (SELECT 'price' AS model, label,
price + row_key * 1e-6::DOUBLE AS score FROM labeled), {_auc('priced')} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc"""
ORACLES["metric_auc_gaps"] = f"""{LABELED_SQL}, gaps AS (SELECT 'gaps' AS model, label, age AS score FROM labeled
WHERE row_key % 7 <> 0 AND row_key % 11 <> 0), {_auc('gaps')} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc"""
ORACLES["confusion_matrix"] = (
    f"{SCORED_SQL} SELECT model, label, prediction, count(*) AS n FROM scored GROUP BY model, label, prediction"
)
ORACLES["metric_prf"] = (
    f"{CELLS} SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(specificity, 6) AS specificity, round(f1_positive, 6) AS f1_positive FROM m"
)
ORACLES["metric_grade"] = f"""{CELLS} SELECT model, round(accuracy, 6) AS accuracy,
CASE WHEN accuracy >= 0.8 THEN 'excellent' WHEN accuracy >= 0.7 THEN 'good' ELSE 'needs improvement' END AS grade,
CASE WHEN accuracy > 0.8 THEN 'good' ELSE 'needs improvement' END AS verdict, accuracy > 0.75 AS satisfactory FROM m"""
ORACLES["metric_bars"] = METRICS + " UNION ALL ".join(
    f" SELECT model, '{name}' AS metric, round({name}, 6) AS height, format('{{:.3f}}', {name}) AS label FROM metrics"
    for name in NAMES
)

# --- splitting and assembly
ORACLES["split_counts"] = (
    f"{LABELED_SQL} SELECT CASE WHEN (row_key // 20) % 10 < 8 THEN 'train' ELSE 'test' END AS side, count(*) AS n "
    "FROM labeled GROUP BY 1"
)
ORACLES["assemble"] = (
    LABELED_SQL
    + """, m AS (SELECT avg(genhlth) AS genhlth, avg(age) AS age, avg(physhlth) AS physhlth, avg(price) AS price
  FROM labeled WHERE (row_key // 20) % 10 < 8)
SELECT row_key, label, round(coalesce(l.genhlth, m.genhlth), 6) AS genhlth, round(coalesce(l.age, m.age), 6) AS age,
  round(coalesce(l.physhlth, m.physhlth), 6) AS physhlth, round(coalesce(l.price, m.price), 6) AS price
FROM labeled l CROSS JOIN m WHERE (row_key // 20) % 10 >= 8"""
)
ORACLES["split_by_key"] = f"""{LABELED_SQL} SELECT count(*) AS n, count(DISTINCT row_key) AS keys, CAST(1 AS BIGINT) AS sides,
TRUE AS near_share FROM labeled"""

# --- models
_TRAIN = "(row_key // 20) % 10 < 8"
_CODED = f"""{LABELED_SQL}, coded AS (SELECT row_key, genhlth, label, {_TRAIN} AS train FROM labeled WHERE genhlth IS NOT NULL)"""
_WEIGHTS = {"intercept": "1.0::DOUBLE", **{f: f"coalesce(l.{f}, m.{f})" for f in ("genhlth", "age", "physhlth", "price")}}
ORACLES["model_logistic"] = (
    f"{LABELED_SQL}, m AS (SELECT avg(genhlth) AS genhlth, avg(age) AS age, avg(physhlth) AS physhlth, avg(price) AS price FROM labeled WHERE {_TRAIN}) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS feature, round(avg({w} * label), 4) AS mean_y, TRUE AS agrees FROM labeled l CROSS JOIN m WHERE {_TRAIN}"
        for name, w in _WEIGHTS.items()
    )
)
ORACLES["model_tree"] = f"""{_CODED}, half AS (SELECT genhlth > 3 AS upper, avg(label) AS score FROM coded WHERE train GROUP BY 1)
SELECT DISTINCT genhlth, CASE WHEN upper THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(score, 6) AS score
FROM coded JOIN half ON (genhlth > 3) = upper WHERE train"""
_TWO_CODES = f"""{LABELED_SQL}, coded AS (SELECT row_key, genhlth, floor(price / 10000) AS tenth, (row_key // 20) % 10 < 8 AS train FROM labeled WHERE genhlth IS NOT NULL),
cells AS (SELECT *, CASE WHEN 2 * genhlth + tenth > 12 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM coded)"""
ORACLES["model_tree_codes"] = f"""{_TWO_CODES} SELECT genhlth, tenth, round(avg(label)) AS prediction, round(avg(label), 6) AS least, round(avg(label), 6) AS most
FROM cells WHERE train GROUP BY genhlth, tenth"""
ORACLES["model_compare_codes"] = f"""{_TWO_CODES} SELECT model, TRUE AS near, TRUE AS learned, count(*) AS tested
FROM cells, (SELECT unnest(['logistic_regression', 'random_forest', 'decision_tree']) AS model) WHERE NOT train GROUP BY model"""
ORACLES["model_forest"] = f"""{_CODED} SELECT 'random_forest' AS model, CASE WHEN genhlth > 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
CASE WHEN genhlth > 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, count(*) AS n FROM coded WHERE NOT train GROUP BY 2"""
ORACLES["predictions"] = f"""{_CODED}, half AS (SELECT genhlth > 3 AS upper, sum(label) AS score FROM coded WHERE train GROUP BY 1)
SELECT 'decision_tree' AS model, label, row_key, CASE WHEN upper THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, score
FROM coded JOIN half ON (genhlth > 3) = upper WHERE NOT train"""
# all three models part the codes in the middle; only the logistic scores differ within a half
_SAME = METRICS.replace(SCORED_SQL, _CODED + ", scored AS (" + " UNION ALL ".join(
    f"SELECT '{model}' AS model, label, CASE WHEN genhlth > 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, {score} AS score FROM coded WHERE NOT train"
    for model, score in {"logistic_regression": "genhlth", "random_forest": "CAST(genhlth > 3 AS DOUBLE)", "decision_tree": "CAST(genhlth > 3 AS DOUBLE)"}.items()
) + ")")
ORACLES["model_compare"] = f"{_SAME} SELECT {ROUNDED} FROM metrics"


_CELL = {
    "longs": "regexp_full_match(cell, '[+-]?[0-9]+') AND try_cast(cell AS BIGINT) IS NOT NULL",
    "doubles": "regexp_full_match(cell, '(?i)[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?|[+-]?nan')",
    "booleans": "lower(cell) IN ('true', 'false')",
    "dates": "length(cell) = 10 AND try_cast(cell AS DATE) IS NOT NULL",
    "timestamps": "length(cell) >= 10 AND try_cast(cell AS TIMESTAMP) IS NOT NULL",
}
_MIXED_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS \"column\", {sql} AS cell FROM events" for i, (name, sql) in enumerate(MIXED.items())
)
_TYPE = (
    "CASE WHEN cells = 0 THEN 'double' WHEN longs = cells THEN 'bigint' WHEN doubles = cells THEN 'double' WHEN booleans = cells THEN 'boolean' "
    "WHEN dates = cells THEN 'date' WHEN timestamps = cells THEN 'timestamp' ELSE 'string' END"
)
ORACLES["csv_types"] = f"""WITH cell AS (SELECT position, "column", CASE WHEN cell <> 'NA' THEN cell END AS cell FROM ({_MIXED_ROWS})),
sums AS (SELECT position, "column", count(cell) AS cells, {", ".join(f"count(*) FILTER ({sql}) AS {name}" for name, sql in _CELL.items())} FROM cell GROUP BY ALL)
SELECT *, {_TYPE} AS type, {_TYPE} AS read_as FROM sums"""

ORACLES["stream_once"] = "SELECT event_id, value FROM events"
ORACLES["stream_batches"] = """SELECT count(*) AS n, count(DISTINCT event_id) FILTER (event_id % 9 <> 0) AS events,
  round(sum(CASE WHEN event_id % 4 > 0 THEN value END) FILTER (event_id % 9 <> 0), 4) AS total, count(*)::HUGEINT::BIGINT AS counted,
  count(*) FILTER (event_id % 9 = 0) AS malformed, count(*) FILTER (event_id % 9 <> 0 AND event_id % 4 = 0) AS gaps FROM events"""
ORACLES["table_versions"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0"
ORACLES["full_run"] = f"""{LABELED_SQL}
SELECT 'success' AS status, 1 AS model_count, 5 AS steps, (SELECT count(*) FROM survey) AS read_rows, (SELECT count(*) FROM survey WHERE row_key % 97 = 0) AS read_malformed,
  count(*) AS stored_rows, count(*) - count(genhlth) AS gaps_genhlth, count(*) - count(age) AS gaps_age, count(*) - count(price) AS gaps_price,
  'decision_tree' AS best_model, TRUE AS learned, 'age' AS first_feature FROM labeled"""

_BINNED = ["age", "physhlth", "price"]
ORACLES["kde_binned"] = f"""{LABELED_SQL}, long AS ({long_form("labeled", _BINNED)}),
figure AS (
  SELECT feature, count(value) AS n, min(value) AS lo, (max(value) - min(value)) / 199 AS step, stddev_samp(value) * power(count(value), -0.2::DOUBLE) AS h FROM long GROUP BY feature),
shape AS (SELECT *, ceil(step / (h * sqrt(8 * 0.0001::DOUBLE))) AS parts, step / ceil(step / (h * sqrt(8 * 0.0001::DOUBLE))) AS width FROM figure),
place AS (
  SELECT feature, (value - lo) / width AS place, greatest(least(floor((value - lo) / width), 199 * parts - 1), 0) AS bin
  FROM long JOIN shape USING (feature) WHERE value IS NOT NULL),
weight AS (
  SELECT feature, bin, sum(w) AS w FROM (
    SELECT feature, bin, 1 - (place - bin) AS w FROM place UNION ALL SELECT feature, bin + 1 AS bin, place - bin AS w FROM place) GROUP BY feature, bin),
dots AS (SELECT unnest(range(0, 200)) AS point),
exact AS (SELECT feature, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY feature, value),
kernel AS (
  SELECT feature, point, sum(e.n * exp(-0.5::DOUBLE * power((lo + point * step - value) / h, 2))) / (any_value(s.n) * any_value(h) * sqrt(2 * pi())) AS density
  FROM exact e JOIN shape s USING (feature), dots GROUP BY feature, point),
binned AS (
  SELECT feature, point, any_value(lo + point * step) AS x, any_value(power(width / h, 2) / 8 / (h * sqrt(2 * pi()))) AS bound,
    sum(w * exp(-0.5::DOUBLE * power((point * parts - bin) * width / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
  FROM weight JOIN shape USING (feature), dots GROUP BY feature, point)
SELECT b.feature AS "column", b.point::INTEGER AS point, round(x, 4) AS x, round(b.density, 9) AS density, abs(b.density - k.density) <= bound AS within
FROM binned b JOIN kernel k ON b.feature = k.feature AND b.point = k.point"""
ORACLES["scatter_sample"] = f"""{SURVEY_SQL} SELECT physhlth AS x, round(price, 2) AS y, md5(row_key::VARCHAR) AS hash FROM survey
WHERE physhlth IS NOT NULL AND price IS NOT NULL ORDER BY hash, x, y LIMIT 500"""
ORACLES["quantiles_as_records_arrive"] = LABELED_SQL + " UNION ALL ".join(
    f" SELECT '{c}' AS \"column\", " + ", ".join(f"round(quantile_cont({c}, {q / 100}), 4) AS q{q}" for q in (25, 50, 75)) + " FROM labeled" for c in ("age", "price", "sparse")
)
