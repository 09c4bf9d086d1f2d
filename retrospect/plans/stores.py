"""Queries that write what the library stores and read it again, score one date, and run experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models, results
from ..operators.blocks import Block, Quantity, lookback
from ..sources import io
from . import reports
from .features import rounded
from .tables import DATES_SQL, STATUS, dates, table


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookback(table(spark, sf_dir, "orders"), dates(spark), Block("ord", "o_custkey", "o_orderdate", [Quantity("orders", "o_orderkey", ("count", "max"))], {"P1Y": (12, 0)}))


_FEATURES = f"SELECT o_custkey, as_of_date, count(o_orderkey) AS ord_id_p1y_orders_count, max(o_orderkey) AS ord_id_p1y_orders_max FROM orders JOIN {DATES_SQL} ON o_orderdate < as_of_date AND o_orderdate >= as_of_date - INTERVAL 12 MONTH GROUP BY 1, 2"


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features in a folder for each date, of which two are read."""
    path = io.scratch(spark, "features")
    io.write_features(_features(spark, sf_dir), path)
    return io.scan(spark, path, ["o_custkey", "as_of_date", "ord_id_p1y_orders_count", "ord_id_p1y_orders_max"], "as_of_date", "1998-06-01", "2000-01-02", "o_custkey bigint, ord_id_p1y_orders_count bigint, ord_id_p1y_orders_max bigint, as_of_date timestamp_ntz")


STORED_FEATURES = f"SELECT * FROM ({_FEATURES}) WHERE as_of_date >= TIMESTAMP '1998-06-01' AND as_of_date < TIMESTAMP '2000-01-02'"


def stored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second table of labels replaces the first."""
    path, orders = io.scratch(spark, "labels"), table(spark, sf_dir, "orders")
    for status in ("F", "O"):
        io.write_labels(orders.filter(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest")), path)
    return spark.read.parquet(path)


STORED_LABELS = "SELECT o_custkey, max(o_orderdate) AS latest FROM orders WHERE o_orderstatus = 'O' GROUP BY 1"


def stored_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matrix that is built once, and found by its metadata whatever their order."""
    root, built = io.scratch(spark, "matrices"), []

    def build() -> DataFrame:
        built.append(1)
        return _features(spark, sf_dir)

    io.archived(spark, root, {"window": "P1Y", "dates": 3}, build)
    found = io.archived(spark, root, {"dates": 3, "window": "P1Y"}, build)
    return found.withColumn("times_built", F.lit(len(built)))


STORED_MATRIX = f"SELECT *, 1 AS times_built FROM ({_FEATURES})"


def stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup from its seed rows names the codes of orders; the named counts go through a mapping file."""
    path, mapping = io.scratch(spark, "lookup"), io.scratch(spark, "mapping")
    io.write_lookup(spark, path, ["code", "value"], STATUS)
    named = table(spark, sf_dir, "orders").join(F.broadcast(spark.read.parquet(path)), F.col("o_orderstatus") == F.col("code")).groupBy("code", F.concat(F.lit("orders, "), F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    io.export_mapping(named, mapping)
    return spark.read.option("header", True).option("quote", "|").schema("code string, value string, n bigint").csv(mapping)


STORED_LOOKUP = "SELECT o_orderstatus AS code, 'orders, ' || v AS value, count(*) AS n FROM orders JOIN (VALUES " + ", ".join(f"('{c}', '{v}')" for c, v in STATUS) + ") s(c, v) ON c = o_orderstatus GROUP BY 1, 2"


def stored_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of many lines and quotes through a CSV file, as hashes."""
    path = io.scratch(spark, "narratives") + ".csv"
    text = F.concat_ws("\n", "o_orderpriority", F.concat(F.lit('said "'), F.col("o_orderkey").cast("string"), F.lit('", and so on')))
    io.write_narratives(table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 5 > 0, text).alias("narrative")), path)
    return io.read_narratives(spark, path).groupBy(F.md5("narrative").alias("narrative")).agg(F.count(F.lit(1)).alias("n"))


STORED_NARRATIVES = "SELECT md5(o_orderpriority || chr(10) || 'said \"' || o_orderkey || '\", and so on') AS narrative, count(*) AS n FROM orders WHERE o_orderkey % 5 > 0 GROUP BY 1"


def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions are added to; evaluations of a model and date replace those of the same ones."""
    root = io.scratch(spark, "results")
    scored = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 3).cast("int").alias("model_id"), F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("as_of_date"), F.col("o_orderkey").alias("entity_id"), F.col("o_custkey").alias("value"))
    for part in (0, 1):
        io.append(scored.filter(F.col("entity_id") % 2 == part), f"{root}/predictions")
    keys = ["model_id", "as_of_date"]
    read = lambda name, kinds: spark.read.schema(kinds).parquet(f"{root}/{name}")
    io.replace(scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("value")), f"{root}/evaluations")
    io.replace(scored.filter("model_id = 1").groupBy(*keys).agg(F.max("value").alias("value")), f"{root}/evaluations")
    kinds = "value bigint, model_id int, as_of_date timestamp_ntz"
    predicted = read("predictions", f"entity_id bigint, {kinds}").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("entity_id").alias("entities"))
    return predicted.join(read("evaluations", kinds), keys)


STORED_RESULTS = "SELECT (o_custkey % 3)::INT AS model_id, date_trunc('year', o_orderdate)::TIMESTAMP AS as_of_date, count(*) AS n, sum(o_orderkey)::BIGINT AS entities, CASE WHEN (o_custkey % 3) = 1 THEN max(o_custkey) ELSE count(*) END AS value FROM orders GROUP BY 1, 2, o_custkey % 3"

#: Sums of these are exact, so that equal ones tie.
_WEIGHTS, _INTERCEPT, _DAY = {"n_events": 0.25, "n_errors": -0.5}, -1.0, "2024-01-20"


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("as_of_date")
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("entity_id"), day).agg(F.count(F.lit(1)).cast("double").alias("n_events"), F.count_if(F.col("event_type") == "error").cast("double").alias("n_errors"))


def scored_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R9 with T13, T18 and R6: one day's users scored by a fixed rule, ranked, and compared with their days before."""
    rows, model = _daily(spark, sf_dir), models.LinearScore(_WEIGHTS, _INTERCEPT)
    before = model.score(rows.filter(F.col("as_of_date") < F.lit(_DAY).cast("timestamp_ntz"))).select(F.lit(1).alias("model_id"), "as_of_date", "entity_id", "score")
    today = rows.filter(F.col("as_of_date") == F.lit(_DAY).cast("timestamp_ntz"))
    moved = models.score_date(model, today, list(_WEIGHTS), "entity_id", 1, _DAY, models.prediction_ranks(before), today.select("entity_id"))
    return rounded(moved, 6)


SCORED_DATE = f"""WITH d AS (SELECT user_id AS entity_id, date_trunc('day', ts)::TIMESTAMP AS as_of_date, count(*) AS a, count(*) FILTER (WHERE event_type = 'error') AS b FROM events GROUP BY ALL),
s AS (SELECT entity_id, as_of_date, 1 / (1 + exp(-({_INTERCEPT}::DOUBLE + a * 0.25::DOUBLE + b * -0.5::DOUBLE))) AS score FROM d WHERE as_of_date <= TIMESTAMP '{_DAY}'),
q AS (SELECT *, dense_rank() OVER (PARTITION BY as_of_date ORDER BY score DESC)::INT AS rank_abs, count(*) OVER (PARTITION BY as_of_date) AS n FROM s),
m AS (SELECT 1 AS model_id, as_of_date, entity_id, round(score, 6) AS score, rank_abs, round(rank_abs / n, 6) AS rank_pct, {', '.join(f"round(rank_abs / n - lag(rank_abs / n, {k}) OVER w, 6) AS {name}" for name, k in results.LAGS.items())} FROM q WINDOW w AS (PARTITION BY entity_id ORDER BY as_of_date))
SELECT * FROM m WHERE as_of_date = TIMESTAMP '{_DAY}'"""


def experiment_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two periods, two subsets of features and two kinds of models; what each stored."""
    rows, root = reports._rows(spark, sf_dir), io.scratch(spark, "experiments")
    early, late = rows.filter("month <= 6"), rows.filter("month > 6")
    periods = {"early": (early, late, "1999-01-01"), "late": (late, early, "2000-01-01")}
    models.run_experiments(periods, "o_orderkey", [["n_lines", "month"], list(reports.FEATURES)], {"decision_tree": {"max_depth": [2, 3]}, "gaussian_nb": {}}, root, {"name": "experiment", "seed": 42})
    registry = io.scan(spark, f"{root}/models")
    sizes = spark.read.parquet(f"{root}/predictions").groupBy("model_id").agg(F.count(F.lit(1)).alias("n_predictions"))
    judged = spark.read.parquet(f"{root}/evaluations").filter("metric = 'auc'").select("model_id", F.round("value", 6).alias("auc"))
    known = spark.read.parquet(f"{root}/feature_importances").groupBy("model_id").agg(F.count(F.lit(1)).alias("n_importances"))
    return registry.select("model_id", "experiment_hash", "model_type", "model_parameters", "prediction_window", F.size("features").alias("n_features")).join(sizes, "model_id").join(judged, "model_id").join(known, "model_id", "left")


_GRID = {"decision_tree": {"max_depth": [2, 3]}, "gaussian_nb": {}}
_SUBSETS = (["n_lines", "month"], ["o_totalprice", "n_lines"])


def experiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs over one store leave, of which the first fits one kind of models alone; nothing is stored twice."""
    rows, root = reports._rows(spark, sf_dir), io.scratch(spark, "experiments")
    early, late = rows.filter("month <= 6"), rows.filter("month > 6")
    periods = {"early": (early, late, "1999-01-01"), "late": (late, early, "2000-01-01")}
    for kinds in ({"gaussian_nb": {}}, _GRID):
        models.run_experiments(periods, "o_orderkey", _SUBSETS, kinds, root, {"name": "experiment", "seed": 42})
    predictions = spark.read.parquet(f"{root}/predictions").groupBy("model_id").agg(F.count(F.lit(1)).alias("n_predictions"), F.sum("entity_id").alias("entities"), F.sum("label_value").cast("long").alias("positives"))
    judged = spark.read.parquet(f"{root}/evaluations").groupBy("model_id").agg(F.count(F.lit(1)).alias("n_evaluations"), F.max(F.when((F.col("metric") == "true positives@") & (F.col("parameter") == "100.0_pct"), F.col("value"))).alias("all_positives"))
    known = spark.read.parquet(f"{root}/feature_importances").groupBy("model_id").agg(F.count(F.lit(1)).alias("n_importances"))
    registry = spark.read.schema(io.RESULT_SCHEMAS["models"]).parquet(f"{root}/models").select("model_id", "model_type", "prediction_window", F.array_join("features", ",").alias("subset"))
    return registry.join(predictions, "model_id").join(judged, "model_id").join(known, "model_id", "left")


EXPERIMENT_COUNTS = f"""WITH r AS {reports._ROWS}, p AS (SELECT CASE WHEN "month" > 6 THEN 'early' ELSE 'late' END AS prediction_window, count(*) AS n, sum(o_orderkey)::BIGINT AS e, sum(outcome)::BIGINT AS y FROM r GROUP BY 1),
g AS (SELECT * FROM (VALUES (1, 'gaussian_nb', 'early', 'n_lines,month', NULL), (2, 'gaussian_nb', 'early', 'o_totalprice,n_lines', NULL), (3, 'gaussian_nb', 'late', 'n_lines,month', NULL), (4, 'gaussian_nb', 'late', 'o_totalprice,n_lines', NULL),
  (5, 'decision_tree', 'early', 'n_lines,month', 2), (6, 'decision_tree', 'early', 'n_lines,month', 2), (7, 'decision_tree', 'early', 'o_totalprice,n_lines', 2), (8, 'decision_tree', 'early', 'o_totalprice,n_lines', 2),
  (9, 'decision_tree', 'late', 'n_lines,month', 2), (10, 'decision_tree', 'late', 'n_lines,month', 2), (11, 'decision_tree', 'late', 'o_totalprice,n_lines', 2), (12, 'decision_tree', 'late', 'o_totalprice,n_lines', 2)) AS t(model_id, model_type, prediction_window, subset, i))
SELECT model_id::INT AS model_id, model_type, prediction_window, subset, n AS n_predictions, e AS entities, y AS positives, 112::BIGINT AS n_evaluations, y::DOUBLE AS all_positives, i::BIGINT AS n_importances FROM g JOIN p USING (prediction_window)"""


QUERIES = {f.__name__: f for f in (stored_features, stored_labels, stored_matrix, stored_lookup, stored_narratives, stored_results, scored_date, experiment_results, experiment_counts)}
SQL = {
    "stored_features": STORED_FEATURES, "stored_labels": STORED_LABELS, "stored_matrix": STORED_MATRIX, "stored_lookup": STORED_LOOKUP, "stored_narratives": STORED_NARRATIVES, "stored_results": STORED_RESULTS,
    "scored_date": SCORED_DATE, "experiment_counts": EXPERIMENT_COUNTS,
}
