"""Queries of evaluation, results, models, text and constraints (E1-E12, R1-R10, T1-T18, X1-X9, S1-S15) and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import anonymize
from ..operators import evaluate, models, results, temporal
from ..sources import io
from .features import rounded
from .tables import SCORES_SQL, scores, table

# --- evaluation -------------------------------------------------------------------------------------


def eval_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1, E4-E6."""
    return rounded(evaluate.global_metrics(scores(spark, sf_dir)), 9)


_CONFUSION = f"(SELECT count(*)::DOUBLE AS n, sum((pred = 1 AND label = 1)::INT)::DOUBLE AS tp, sum((pred = 1 AND label = 0)::INT)::DOUBLE AS fp, sum((pred = 0 AND label = 1)::INT)::DOUBLE AS fn, sum((pred = 0 AND label = 0)::INT)::DOUBLE AS tn FROM {SCORES_SQL})"


def _metric(name: str, parameter: str, value: str, source: str = _CONFUSION) -> str:
    return f"SELECT '{name}' AS metric, '{parameter}' AS parameter, round({value}, 9) AS value FROM {source}"


def _fbeta(b: float) -> str:
    return f"coalesce({1 + b * b}::DOUBLE * tp / nullif({1 + b * b}::DOUBLE * tp + {b * b}::DOUBLE * fn + fp, 0), 0)"


EVAL_GLOBAL = " UNION ALL ".join([
    _metric("accuracy", "", "(tp + tn) / n"), _metric("f1", "", _fbeta(1.0)), *(_metric("fbeta@", f"{b} beta", _fbeta(b)) for b in evaluate.BETAS),
    _metric("precision@", "default", "coalesce(tp / nullif(tp + fp, 0), 0)"), _metric("recall@", "default", "coalesce(tp / nullif(tp + fn, 0), 0)"),
])


def eval_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2, E3, E10."""
    s = scores(spark, sf_dir)
    return rounded(evaluate.curve_metrics(s).unionByName(evaluate.mean_rates(s)), 9)


EVAL_CURVES = f"""
WITH s AS {SCORES_SQL}, t AS (SELECT sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n FROM s),
g AS (SELECT score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM s GROUP BY 1),
r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (ORDER BY score DESC))
SELECT 'auc' AS metric, 'roc' AS parameter, round(sum(pos * (n - fp + neg / 2)) / any_value(p * n), 9) AS value FROM r, t
UNION ALL SELECT 'average precision score', '', round(sum(pos * tp / (tp + fp)) / any_value(p), 9) FROM r, t
UNION ALL SELECT 'mean false positive rate', '', round(sum(fp) / (any_value(n) * (count(*) + 1)), 9) FROM r, t
UNION ALL SELECT 'mean true positive rate', '', round(sum(tp) / (any_value(p) * (count(*) + 1)), 9) FROM r, t
"""


def eval_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7-E9, E11."""
    return rounded(evaluate.cut_metrics(scores(spark, sf_dir)), 9)


_CUTS = [(f"{p}_pct", f"floor(n * ({p}::DOUBLE / 100.0::DOUBLE))") for p in evaluate.PERCENTS] + [(f"{k}_abs", str(k)) for k in evaluate.COUNTS]
EVAL_AT_K = f"""
WITH s AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS number FROM {SCORES_SQL}),
t AS (SELECT count(*)::DOUBLE AS n, sum(label)::DOUBLE AS p FROM s),
c AS ({" UNION ALL ".join(f"SELECT '{k}' AS parameter, ({v})::DOUBLE AS k FROM t" for k, v in _CUTS)}),
x AS (SELECT parameter, any_value(n) AS n, any_value(p) AS p, least(any_value(k), any_value(n)) AS k, coalesce(sum(label) FILTER (WHERE number <= k), 0)::DOUBLE AS tp FROM s, t, c GROUP BY parameter)
SELECT unnest(['precision@', 'recall@', 'true positives@', 'true negatives@', 'false positives@', 'false negatives@']) AS metric, parameter,
  unnest([round(coalesce(tp / nullif(k, 0), 0), 9), round(coalesce(tp / nullif(p, 0), 0), 9), tp, n - k - (p - tp), k - tp, p - tp]) AS value FROM x
"""


def eval_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 for the 100 largest scores, ties by id."""
    return evaluate.binary_at(scores(spark, sf_dir), 100).select("id", "pred")


EVAL_BINARY = f"SELECT id, (row_number() OVER (ORDER BY score DESC, id) <= 100)::INT AS pred FROM {SCORES_SQL}"


def eval_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E11 of each model and date at once: values of events as scores of errors."""
    e = table(spark, sf_dir, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("as_of_date")
    sets = e.select((F.col("user_id") % 3).cast("int").alias("model_id"), day, F.col("event_id").alias("id"), F.round("value", 0).alias("score"), (F.col("value") > 60).cast("int").alias("pred"), (F.col("event_type") == "error").cast("int").alias("label"))
    return rounded(evaluate.all_metrics(sets), 9)


def _sets_sql() -> str:
    ratio = lambda a, b: f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0)"
    whole = [("accuracy", "", ratio("tp + tn", "n")), ("f1", "", ratio("2 * tp", "2 * tp + fn + fp")), *(("fbeta@", f"{b} beta", ratio(f"{1 + b * b}::DOUBLE * tp", f"{1 + b * b}::DOUBLE * tp + {b * b}::DOUBLE * fn + fp")) for b in evaluate.BETAS)]
    whole += [("precision@", "default", ratio("tp", "tp + fp")), ("recall@", "default", ratio("tp", "tp + fn"))]
    curves = [("auc", "roc", "won / nullif(p * m, 0)"), ("average precision score", "", "steps / nullif(p, 0)"), ("mean false positive rate", "", "fps / nullif(m * (k + 1), 0)"), ("mean true positive rate", "", "tps / nullif(p * (k + 1), 0)")]
    parts = [f"SELECT model_id, as_of_date, '{m}' AS metric, '{p}' AS parameter, round({v}, 9) AS value FROM {t}" for t, some in (("c", whole), ("v", curves)) for m, p, v in some]
    for name, k in _CUTS:
        x = f"(SELECT model_id, as_of_date, any_value(n) AS n, any_value(p) AS p, least(any_value({k}), any_value(n))::DOUBLE AS k, coalesce(sum(label) FILTER (WHERE number <= {k}), 0)::DOUBLE AS tp FROM o GROUP BY 1, 2)"
        values = [("precision@", ratio("tp", "k")), ("recall@", ratio("tp", "p")), ("true positives@", "tp"), ("true negatives@", "n - k - (p - tp)"), ("false positives@", "k - tp"), ("false negatives@", "p - tp")]
        parts += [f"SELECT model_id, as_of_date, '{m}', '{name}', round({v}, 9) FROM {x}" for m, v in values]
    return f"""WITH s AS (SELECT (user_id % 3)::INT AS model_id, date_trunc('day', ts)::TIMESTAMP AS as_of_date, event_id AS id, round(value, 0) AS score, (value > 60)::INT AS pred, (event_type = 'error')::INT AS label FROM events),
c AS (SELECT model_id, as_of_date, count(*) AS n, count(*) FILTER (WHERE pred = 1 AND label = 1) AS tp, count(*) FILTER (WHERE pred = 1 AND label = 0) AS fp, count(*) FILTER (WHERE pred = 0 AND label = 1) AS fn, count(*) FILTER (WHERE pred = 0 AND label = 0) AS tn FROM s GROUP BY 1, 2),
g AS (SELECT model_id, as_of_date, score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM s GROUP BY ALL),
r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER a AS p, sum(neg) OVER a AS m FROM g WINDOW w AS (PARTITION BY model_id, as_of_date ORDER BY score DESC), a AS (PARTITION BY model_id, as_of_date)),
v AS (SELECT model_id, as_of_date, sum(pos * (m - fp + neg / 2)) AS won, sum(pos * tp / (tp + fp)) AS steps, sum(fp) AS fps, sum(tp) AS tps, count(*) AS k, any_value(p) AS p, any_value(m) AS m FROM r GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY model_id, as_of_date ORDER BY score DESC, id) AS number, count(*) OVER (PARTITION BY model_id, as_of_date)::DOUBLE AS n, sum(label) OVER (PARTITION BY model_id, as_of_date)::DOUBLE AS p FROM s)
{" UNION ALL ".join(parts)}"""


def evaluation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics named metric|parameter|comment, split and rounded to 10 digits."""
    counts = evaluate.confusion(scores(spark, sf_dir))
    named = counts.select(F.inline(F.array(*[F.struct(F.lit(f"{k}|at default|count").alias("name"), (F.col(k) / F.col("n")).alias("value")) for k in ("tp", "fp", "fn", "tn")])))
    return evaluate.evaluation_rows(named)


EVALUATION_ROWS = " UNION ALL ".join(f"SELECT '{k}' AS metric, 'at default' AS parameter, 'count' AS comment, round({k} / n, 10) AS value FROM {_CONFUSION}" for k in ("tp", "fp", "fn", "tn"))

# --- results ----------------------------------------------------------------------------------------
# A clerk of orders stands for a model: each nation is one, a year's mean price is its value, the last order its run.


def _models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    run = rows.groupBy(F.col("c_nationkey").alias("model_id")).agg(F.max("o_orderdate").alias("run_time"))
    value = F.round(F.avg("o_totalprice"), 4).alias("value")
    values = rows.groupBy(F.col("c_nationkey").alias("model_id"), F.lit("price").alias("metric"), F.year("o_orderdate").cast("string").alias("parameter")).agg(value)
    return values, run


_MODELS = """o AS (SELECT c_nationkey AS model_id, o_totalprice, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT model_id, max(o_orderdate) AS run_time FROM o GROUP BY 1),
e AS (SELECT model_id, 'price' AS metric, year(o_orderdate)::VARCHAR AS parameter, round(avg(o_totalprice), 4) AS value FROM o GROUP BY ALL)"""


def top_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best values of a metric; the limit is what is asked."""
    values, run = _models(spark, sf_dir)
    return results.top_models(values, run, "1996-01-01", "price", "1999", 10)


TOP_MODELS = f"WITH {_MODELS} SELECT model_id, metric, parameter, value, run_time FROM e JOIN m USING (model_id) WHERE parameter = '1999' AND run_time >= TIMESTAMP '1996-01-01' ORDER BY value DESC, model_id LIMIT 10"


def top_with_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best with their nation's name."""
    values, run = _models(spark, sf_dir)
    return results.top_with_artifacts(values, run, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("model_id"), "n_name"), "1996-01-01", "price", 20)


TOP_WITH = f"WITH {_MODELS}, t AS (SELECT * FROM e JOIN m USING (model_id) WHERE run_time >= TIMESTAMP '1996-01-01' ORDER BY value DESC, model_id LIMIT 20) SELECT model_id, metric, parameter, value, run_time, n_name FROM t JOIN nation ON n_nationkey = model_id"


def models_run_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of the latest run."""
    _, run = _models(spark, sf_dir)
    return results.models_run_at(run, str(run.agg(F.max("run_time")).first()[0]))


MODELS_RUN_AT = f"WITH {_MODELS} SELECT model_id FROM m WHERE run_time = (SELECT max(run_time) FROM m)"


def group_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of an event's JSON."""
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("model_id"), F.col("user_id").alias("model_group_id"), F.col("props").alias("config"))
    return results.group_config(events, events.select("model_group_id").distinct(), 8, {"k": "$.k"})


GROUP_CONFIG = "SELECT user_id AS model_group_id, json_extract_string(props, '$.k') AS k FROM events WHERE user_id = 8 ORDER BY event_id LIMIT 1"


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' daily sums of value as scores."""
    return table(spark, sf_dir, "events").groupBy(F.lit(1).alias("model_id"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("as_of_date"), F.col("user_id").alias("entity_id")).agg(F.round(F.sum("value"), 2).alias("score"))


_PREDICTIONS = "p AS (SELECT 1 AS model_id, date_trunc('day', ts)::TIMESTAMP AS as_of_date, user_id AS entity_id, round(sum(value), 2) AS score FROM events GROUP BY ALL), r AS (SELECT *, dense_rank() OVER (PARTITION BY as_of_date ORDER BY score DESC)::INT AS rank_abs, count(*) OVER (PARTITION BY as_of_date) AS n FROM p)"


def prediction_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T18."""
    return rounded(models.prediction_ranks(_predictions(spark, sf_dir)), 9)


PREDICTION_RANKS = f"WITH {_PREDICTIONS} SELECT model_id, as_of_date, entity_id, score, rank_abs, round(rank_abs / n, 9) AS rank_pct FROM r"


def rank_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of users with an error."""
    hub = table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("user_id").alias("entity_id"))
    ranked = models.prediction_ranks(_predictions(spark, sf_dir)).select("entity_id", "as_of_date", "rank_pct")
    return rounded(results.rank_movement(ranked, hub), 9)


RANK_MOVEMENT = (
    f"WITH {_PREDICTIONS}, q AS (SELECT entity_id, as_of_date, rank_abs / n AS rank_pct FROM r) SELECT entity_id, as_of_date, round(rank_pct, 9) AS rank_pct, "
    + ", ".join(f"round(rank_pct - lag(rank_pct, {n}) OVER w, 9) AS {k}" for k, n in results.LAGS.items())
    + " FROM q WHERE entity_id IN (SELECT user_id FROM events WHERE event_type = 'error') WINDOW w AS (PARTITION BY entity_id ORDER BY as_of_date)"
)


def model_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users grouped by the kinds of their events."""
    users = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("model_id")).agg(F.collect_set("event_type").alias("features"))
    rows = users.select("model_id", F.lit("t").alias("model_type"), F.lit("{}").alias("model_parameters"), F.lit("1y").alias("prediction_window"), "features")
    return results.model_groups(rows).select("model_id", F.col("model_group_id").cast("int"))


MODEL_GROUPS = "SELECT model_id, dense_rank() OVER (ORDER BY f)::INT AS model_group_id FROM (SELECT user_id AS model_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS f FROM events GROUP BY 1)"


def class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return results.class_histograms(lines, ["l_quantity", "l_extendedprice"], "label").withColumnRenamed("count", "n")


CLASS_HISTOGRAM = """
WITH l AS (SELECT (l_returnflag = 'R')::INT AS label, unnest(['l_quantity', 'l_extendedprice']) AS feature, unnest([l_quantity, l_extendedprice]) AS v FROM lineitem),
b AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM l GROUP BY 1)
SELECT feature, label, least(floor((v - lo) * 30 / (hi - lo)) + 1, 30)::INT AS bin, count(*) AS n FROM l JOIN b USING (feature) GROUP BY ALL
"""

# --- models -----------------------------------------------------------------------------------------
FEATURES = ("o_totalprice", "month", "weekday", "n_lines")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each order; the outcome is whether it is urgent or a large one."""
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    orders = table(spark, sf_dir, "orders").join(n, "o_orderkey")
    return orders.select("o_orderkey", "o_totalprice", F.month("o_orderdate").cast("double").alias("month"), F.dayofweek("o_orderdate").cast("double").alias("weekday"), "n_lines", ((F.col("quantity") > 110) | (F.col("o_totalprice") > 400_000)).cast("int").alias("outcome"))


def _scored(kind: str, parameters: dict | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = models.vectors(_rows(spark, sf_dir), FEATURES)
        train = rows.filter("o_orderkey % 4 != 0")
        return models.fit(kind, train, parameters).score(rows).select("o_orderkey", "outcome", "score", "pred")

    run.__doc__ = f"Scores of every order by {kind}."
    return run


MODELS = {
    "model_random_forest": _scored("random_forest", {"n_estimators": 20, "max_depth": 6}),
    "model_bagging": _scored("bagging", {"n_bags": 3, "n_estimators": 5, "max_depth": 4}),
    "model_boosted_forest": _scored("boosted_forest", {"n_estimators": 3, "trees": 5, "max_depth": 3}),
    "model_svm": _scored("svm"),
    "model_logistic_regression": _scored("logistic_regression", {"C": 1.0, "penalty": "l2"}),
    "model_adaboost": _scored("adaboost", {"n_estimators": 5}),
    "model_gradient_boosting": _scored("gradient_boosting", {"n_estimators": 5}),
    "model_decision_tree": _scored("decision_tree", {"max_depth": 5}),
    "model_sgd": _scored("sgd"),
}


def model_gaussian_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores to six digits."""
    return rounded(_scored("gaussian_nb")(spark, sf_dir), 6)


def _gaussian_sql() -> str:
    """Class priors, means and variances in closed form; variances are raised by a billionth of the largest feature's."""
    train = "SELECT * FROM r WHERE o_orderkey % 4 <> 0"
    stats = ", ".join(f'avg("{c}") AS m_{c}, var_pop("{c}") + (SELECT 1e-9 * greatest({", ".join(f"var_pop(\"{d}\")" for d in FEATURES)}) FROM t) AS v_{c}' for c in FEATURES)
    log = " + ".join(f'-0.5 * (ln(2 * pi() * v_{c}) + ("{c}" - m_{c}) * ("{c}" - m_{c}) / v_{c})' for c in FEATURES)
    return f"""WITH r AS {_ROWS}, t AS ({train}), s AS (SELECT outcome AS class, ln(count(*) / (SELECT count(*) FROM t)) AS prior, {stats} FROM t GROUP BY 1),
l AS (SELECT o_orderkey, any_value(outcome) AS outcome, max(prior + {log}) FILTER (WHERE class = 1) AS l1, max(prior + {log}) FILTER (WHERE class = 0) AS l0 FROM r, s GROUP BY 1)
SELECT o_orderkey, outcome, round(1 / (1 + exp(l0 - l1)), 6) AS score, (l1 > l0)::INT AS pred FROM l"""


def model_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by those of one nation, which is the bounded training matrix."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"), (F.col("c_mktsegment") == "BUILDING").cast("int").alias("outcome"))
    return rounded(models.nearest_neighbours(rows.filter("nation = 3"), rows, "c_custkey", ["c_acctbal"], 5), 9)


NEAREST = """WITH r AS (SELECT c_custkey, c_acctbal, c_nationkey, (c_mktsegment = 'BUILDING')::INT AS outcome FROM customer),
p AS (SELECT a.c_custkey, b.outcome, row_number() OVER (PARTITION BY a.c_custkey ORDER BY (a.c_acctbal - b.c_acctbal) * (a.c_acctbal - b.c_acctbal), b.c_custkey) AS k FROM r a JOIN r b ON b.c_nationkey = 3)
SELECT c_custkey, round(avg(outcome), 9) AS score FROM p WHERE k <= 5 GROUP BY 1"""


def model_nearest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by three quarters of all customers, in two features."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", (F.col("c_custkey") * 37 % 1000).cast("double").alias("place"), (F.col("c_mktsegment") == "BUILDING").cast("int").alias("outcome"))
    return rounded(models.nearest_neighbours(rows.filter("c_custkey % 4 != 0"), rows, "c_custkey", ["c_acctbal", "place"], 5), 9)


NEAREST_ALL = """WITH r AS (SELECT c_custkey, c_acctbal, (c_custkey * 37 % 1000)::DOUBLE AS place, (c_mktsegment = 'BUILDING')::INT AS outcome FROM customer),
p AS (SELECT a.c_custkey, b.outcome, row_number() OVER (PARTITION BY a.c_custkey ORDER BY (a.c_acctbal - b.c_acctbal) * (a.c_acctbal - b.c_acctbal) + (a.place - b.place) * (a.place - b.place), b.c_custkey) AS k FROM r a JOIN r b ON b.c_custkey % 4 <> 0)
SELECT c_custkey, round(avg(outcome), 9) AS score FROM p WHERE k <= 5 GROUP BY 1"""


def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of models of every kind, for each subset of features that leaves one out."""
    found = None
    subsets = temporal.block_subsets(FEATURES, 1)
    kinds = {"random_forest": {"n_estimators": [5], "max_depth": [3]}, "adaboost": {"n_estimators": [2]}, "bagging": {"n_bags": [2], "n_estimators": [2], "max_depth": [2]}, "gaussian_nb": {}, "svm": {}}
    for features, kind, _, model in models.fit_grid(_rows(spark, sf_dir), subsets, kinds):
        rows = models.feature_importances(model, features, spark).withColumn("subset", F.lit(",".join(features))).withColumn("kind", F.lit(kind))
        found = rows if found is None else found.unionByName(rows)
    return found


_COEFFICIENTS = {"o_totalprice": 0.00001, "month": -0.05, "weekday": 0.0, "n_lines": 0.7}


def signed_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T15 and T16."""
    rows = _rows(spark, sf_dir)
    return models.signed_top(models.linear_contributions(rows, rows, "o_orderkey", _COEFFICIENTS), "o_orderkey", 3)


_ROWS = "(SELECT o_orderkey, o_totalprice, month(o_orderdate)::DOUBLE AS \"month\", (dayofweek(o_orderdate) + 1)::DOUBLE AS weekday, n_lines, (quantity > 110 OR o_totalprice > 400000)::INT AS outcome FROM orders JOIN (SELECT l_orderkey AS o_orderkey, count(*)::DOUBLE AS n_lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) USING (o_orderkey))"
SIGNED_TOP5 = f"""WITH r AS {_ROWS}, s AS (SELECT {', '.join(f'stddev_samp("{c}") AS s_{c}' for c in _COEFFICIENTS)} FROM r),
x AS (SELECT o_orderkey, unnest([{', '.join(f"'{c}'" for c in _COEFFICIENTS)}]) AS name, unnest([{', '.join(f's_{c} * ({w})::DOUBLE * "{c}"' for c, w in _COEFFICIENTS.items())}]) AS v FROM r, s),
k AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY -abs(v), name) AS k FROM x)
SELECT o_orderkey, {', '.join(f"max(CASE WHEN k = {i} THEN CASE WHEN v > 0 THEN name WHEN v < 0 THEN '-' || name END END) AS risk_{i}" for i in (1, 2, 3))} FROM k GROUP BY 1"""


def rank_distance_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T17."""
    return models.rank_distance(_rows(spark, sf_dir), "o_orderkey", {"o_totalprice": 0.5, "n_lines": 0.3, "month": 0.2, "dummy_a": 0.9, "weekday": 0.0}, n=3)


RANK_DISTANCE = f"""WITH r AS {_ROWS}, x AS (SELECT o_orderkey, unnest(['o_totalprice', 'n_lines', 'month']) AS feature, unnest([o_totalprice, n_lines, "month"]) AS v, unnest([0, 1, 2]) AS place FROM r),
k AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0::DOUBLE AS rk FROM x),
m AS (SELECT feature, quantile_cont(v, 0.5) AS med FROM x GROUP BY 1),
c AS (SELECT feature, first(rk ORDER BY abs(v - med), o_orderkey) AS mid FROM k JOIN m USING (feature) GROUP BY 1),
d AS (SELECT o_orderkey, feature, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(rk - mid) DESC, place) AS n FROM k JOIN c USING (feature))
SELECT o_orderkey, {', '.join(f"max(CASE WHEN n = {i} THEN feature END) AS risk_{i}" for i in (1, 2, 3))} FROM d GROUP BY 1"""

# --- text -------------------------------------------------------------------------------------------


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of the normalised texts, whole ones."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(anonymize.normalize_report(F.col("text"))).alias("report"), F.md5(anonymize.normalize_name(F.col("text"))).alias("name"))


_REPORT = r"trim(regexp_replace(lower(text), '[ \t\n\x0B\f\r]+', ' ', 'g'))"
NORMALIZE = f"SELECT doc_id, md5({_REPORT}) AS report, md5(translate({_REPORT}, '{anonymize.PUNCTUATION.replace(chr(39), chr(39) * 2)}', '')) AS name FROM documents"


def badge_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(anonymize.scrub_badges(F.lower("text"))).alias("scrubbed"), F.size(F.split(anonymize.scrub_badges(F.col("text")), anonymize.BADGE)).alias("parts"))


def _scrub(text: str) -> str:
    for p in anonymize.BADGE_PATTERNS:
        text = f"regexp_replace({text}, '{p}', '{anonymize.BADGE}', 'g')"
    return text


BADGE_SCRUB = f"SELECT doc_id, md5({_scrub('lower(text)')}) AS scrubbed, len(string_split({_scrub('text')}, '{anonymize.BADGE}'))::INT AS parts FROM documents"


#: Words of a bucket, on average, that are dealt to people.
BUCKET = 48


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People named by all longer words of the documents, three to a person by hash; the last one of a bucket may have fewer."""
    w = io.stored(table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(anonymize.normalize_name(F.col("text")), F.lit("[^ ]{6,}"), F.lit(0))).alias("w")).distinct(), "words")
    buckets = max(1, w.count() // BUCKET)
    dealt = w.withColumn("bucket", F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("long") % buckets)
    n = dealt.withColumn("n", F.row_number().over(Window.partitionBy("bucket").orderBy("w")) - 1)
    part = lambda k: F.max(F.when(F.col("n") % 3 == k, F.col("w")))
    person = (F.floor(F.col("n") / 3) * buckets + F.col("bucket")).alias("person")
    people = n.groupBy(person).agg(part(0).alias("last"), part(1).alias("first"), part(2).alias("middle"))
    return people.select("person", F.concat(F.lit("ID"), 10000 + F.col("person")).alias("id"), "first", F.when(F.col("person") % 2 == 0, F.col("middle")).alias("middle"), "last")


def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3."""
    return anonymize.name_forms(_names(spark, sf_dir), "person")


_CLEAN = rf"translate({_REPORT}, '{anonymize.PUNCTUATION.replace(chr(39), chr(39) * 2)}', '')"
_FORMS = [
    ("true", "last", "id"),
    ("first <> '' AND middle <> ''", "first[1] || middle[1] || ' ' || last", "id"),
    ("first <> ''", "first || ' ' || last", "id"),
    ("first <> ''", "first[1] || ' ' || last", "id"),
    ("middle <> ''", "first || ' ' || middle[1] || ' ' || last", "id"),
    *(("middle = ''", f"first || ' {chr(97 + k)} ' || last", "id || '?'") for k in range(26)),
]
NAME_FORMS = (
    f"WITH w AS (SELECT DISTINCT w FROM (SELECT unnest(string_split({_CLEAN}, ' ')) AS w FROM documents) WHERE length(w) > 5), "
    f"b AS (SELECT w, ('0x' || substr(md5(w), 1, 8))::UBIGINT::BIGINT % greatest(1, (SELECT count(*) FROM w) // {BUCKET}) AS bucket, greatest(1, (SELECT count(*) FROM w) // {BUCKET}) AS buckets FROM w), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY w) - 1 AS n FROM b), "
    "p AS (SELECT n // 3 * buckets + bucket AS person, max(w) FILTER (WHERE n % 3 = 0) AS last, coalesce(max(w) FILTER (WHERE n % 3 = 1), '') AS first, coalesce(max(w) FILTER (WHERE n % 3 = 2), '') AS mid FROM n GROUP BY ALL), "
    "q AS (SELECT person, 'ID' || (10000 + person) AS id, first, CASE WHEN person % 2 = 0 THEN mid ELSE '' END AS middle, last FROM p), "
    "f AS (" + " UNION ALL ".join(f"SELECT person, trim({form}) AS pattern, {i} AS id FROM q WHERE {when}" for when, form, i in _FORMS) + ") SELECT pattern, arg_max(id, person) AS id FROM f WHERE pattern <> '' GROUP BY 1"
)


#: Every so many words of a text a role word goes before one, in turn a singular and a plural.
ROLE_EVERY, ROLE_WORDS = 9, ("officer", "sergeants")


def _with_roles(text: Column) -> Column:
    place = lambda w, k, n: (k % (ROLE_EVERY * len(ROLE_WORDS)) == n * ROLE_EVERY, F.concat(F.lit(ROLE_WORDS[n] + " "), w))
    return F.array_join(F.transform(F.split(text, " "), lambda w, k: F.when(*place(w, k, 0)).when(*place(w, k, 1)).otherwise(w)), " ")


def anonymized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text with role words put in, so that names are found all over it."""
    d = table(spark, sf_dir, "documents").select("doc_id", _with_roles(F.col("text")).alias("text"))
    return anonymize.anonymize(d, _names(spark, sf_dir), "doc_id", "text", "person")


# --- constraints ------------------------------------------------------------------------------------


def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S15."""
    lines = io.scan(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_shipdate"])
    orders, suppliers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier").filter("s_suppkey % 7 != 0")
    return io.audit(lines, "lineitem", ["l_orderkey", "l_linenumber"], [["l_orderkey", "l_partkey"]], ["l_shipdate"], {"l_orderkey": (orders, "o_orderkey"), "l_suppkey": (suppliers, "s_suppkey")}, {"quantity": "l_quantity > 0", "small discount": "l_discount < 0.05"})


def _violations(label: str, sql: str) -> str:
    return f"SELECT 'lineitem' AS table_name, '{label}' AS \"constraint\", ({sql})::BIGINT AS violations"


AUDIT = " UNION ALL ".join([
    _violations("primary key (l_orderkey, l_linenumber)", "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"),
    _violations("unique (l_orderkey, l_partkey)", "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)"),
    *(_violations(f"not null ({c})", f"SELECT count(*) FROM lineitem WHERE {c} IS NULL") for c in ("l_shipdate", "l_orderkey", "l_linenumber")),
    _violations("check (quantity)", "SELECT count(*) FROM lineitem WHERE NOT l_quantity > 0"), _violations("check (small discount)", "SELECT count(*) FROM lineitem WHERE NOT l_discount < 0.05"),
    _violations("foreign key (l_orderkey)", "SELECT count(*) FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey"), _violations("foreign key (l_suppkey)", "SELECT count(*) FROM lineitem ANTI JOIN (SELECT * FROM supplier WHERE s_suppkey % 7 <> 0) ON l_suppkey = s_suppkey"),
])

QUERIES = {
    f.__name__: f
    for f in (
        eval_global, eval_curves, eval_at_k, eval_binary, eval_sets, evaluation_rows, top_models, top_with_artifacts, models_run_at, group_config, prediction_ranks, rank_movement, model_groups, class_histogram, model_gaussian_nb, model_nearest_neighbours, model_nearest_all, feature_importances,
        signed_top5, rank_distance_explain, normalize_text, badge_scrub, name_forms, anonymized, constraint_audit,
    )
} | MODELS
SQL = {
    "eval_global": EVAL_GLOBAL, "eval_curves": EVAL_CURVES, "eval_at_k": EVAL_AT_K, "eval_binary": EVAL_BINARY, "eval_sets": _sets_sql(), "evaluation_rows": EVALUATION_ROWS, "top_models": TOP_MODELS, "top_with_artifacts": TOP_WITH, "models_run_at": MODELS_RUN_AT, "group_config": GROUP_CONFIG,
    "name_forms": NAME_FORMS, "model_gaussian_nb": _gaussian_sql(), "prediction_ranks": PREDICTION_RANKS, "rank_movement": RANK_MOVEMENT, "model_groups": MODEL_GROUPS, "class_histogram": CLASS_HISTOGRAM, "model_nearest_neighbours": NEAREST, "model_nearest_all": NEAREST_ALL, "signed_top5": SIGNED_TOP5,
    "rank_distance_explain": RANK_DISTANCE, "normalize_text": NORMALIZE, "badge_scrub": BADGE_SCRUB, "constraint_audit": AUDIT,
}
