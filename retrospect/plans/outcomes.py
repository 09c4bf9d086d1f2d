"""Queries of labels, populations, matrices and event features (L2-L13, M1-M11, D1-D16) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import banding, event_features, labels, matrix
from ..operators.blocks import lookback
from ..sources import io
from .features import PRICE, _window_sql, rounded
from .tables import DATES_SQL, RESPONDERS_SQL, dates, lines_and_orders, placed_orders, responders, table, task_parts

YEAR = (12, 0)

# --- labels -----------------------------------------------------------------------------------------


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = lines_and_orders(spark, sf_dir)
    lines = lines.join(orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey").withColumnRenamed("o_orderkey", "l_orderkey")
    return labels.unpivot_attributes(lines, "o_custkey", "l_orderkey", {"l_returnflag": "l_shipdate", "l_linestatus": "o_orderdate"})


def unpivot_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2."""
    return _attributes(spark, sf_dir)


ATTRIBUTES = """SELECT o_custkey, l_orderkey, l_shipdate AS event_datetime, 'l_returnflag' AS event_type, l_returnflag AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag IS NOT NULL AND l_shipdate IS NOT NULL
UNION SELECT o_custkey, l_orderkey, o_orderdate, 'l_linestatus', l_linestatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus IS NOT NULL AND o_orderdate IS NOT NULL"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.collapse_events(_attributes(spark, sf_dir), "o_custkey", "l_orderkey", ["l_returnflag"])


def event_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5."""
    return _events(spark, sf_dir).withColumn("pairs", F.array_join("pairs", ","))


_COLLAPSED = f"""SELECT o_custkey, l_orderkey, list_sort(list_distinct(list(event_type || ':' || value))) AS pairs, min(event_datetime) AS min_date, max(event_datetime) FILTER (WHERE event_type IN ('l_returnflag')) AS max_date FROM ({ATTRIBUTES}) GROUP BY 1, 2"""
EVENT_COLLAPSE = f"SELECT o_custkey, l_orderkey, array_to_string(pairs, ',') AS pairs, min_date, max_date FROM ({_COLLAPSED})"


def forward_window_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6."""
    return labels.forward_window(_events(spark, sf_dir), dates(spark), YEAR).drop("pairs")


_FORWARD = f"SELECT o_custkey, l_orderkey, pairs, min_date, max_date, as_of_date FROM ({_COLLAPSED}) JOIN {DATES_SQL} ON min_date > as_of_date AND max_date < as_of_date + INTERVAL 12 MONTH"


def forward_window_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6b."""
    return labels.forward_window(_events(spark, sf_dir), dates(spark), YEAR, closed=True).groupBy("as_of_date").agg(F.count(F.lit(1)).alias("n_events"))


CONDITIONS = [[["l_returnflag:R"]], [["l_linestatus:F"], ["l_linestatus:O", "l_returnflag:A"]]]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.positive_labels(labels.forward_window(_events(spark, sf_dir), dates(spark), YEAR), "o_custkey", CONDITIONS)


def and_or_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 and L8."""
    return _labels(spark, sf_dir)


AND_OR = f"SELECT DISTINCT o_custkey, as_of_date, 1 AS outcome FROM ({_FORWARD}) WHERE list_has_all(pairs, ['l_returnflag:R']) AND (list_has_all(pairs, ['l_linestatus:F']) OR list_has_all(pairs, ['l_linestatus:O', 'l_returnflag:A']))"


def _population(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return labels.active_population(dates(spark), customers, table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", YEAR)


def active_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9."""
    return _population(spark, sf_dir)


ACTIVE = f"SELECT c_custkey AS o_custkey, as_of_date FROM customer, {DATES_SQL} WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate <= as_of_date AND o_orderdate + INTERVAL 12 MONTH > as_of_date)"


def sworn_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the active, those with an urgent order by the date."""
    roles = table(spark, sf_dir, "orders").withColumn("flag", (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    return labels.sworn_population(_population(spark, sf_dir), roles, "o_custkey", "o_orderdate", "flag")


SWORN = f"SELECT * FROM ({ACTIVE}) p WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = p.o_custkey AND o_orderpriority = '1-URGENT' AND o_orderdate <= as_of_date)"


def master_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L11."""
    return labels.master_labels(_population(spark, sf_dir), _labels(spark, sf_dir), "o_custkey")


MASTER = f"SELECT o_custkey, as_of_date, coalesce(outcome, 0) AS outcome FROM ({ACTIVE}) LEFT JOIN ({AND_OR}) USING (o_custkey, as_of_date)"


def flagged_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L12."""
    errors = table(spark, sf_dir, "events").filter("event_type = 'error'")
    return labels.flagged_baseline(errors, "user_id", "ts", "2024-01-05", "2024-01-12")


FLAGGED = "SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12' AND user_id IS NOT NULL"


def intervention_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L13."""
    events = table(spark, sf_dir, "events")
    return labels.interventions(events, events.filter("value > 1"), "user_id", "ts", "event_type", "error", "2024-01-05", "2024-01-12")


INTERVENTION = """WITH e AS (SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12' AND user_id IN (SELECT user_id FROM events WHERE value > 1))
SELECT user_id, max((event_type <> 'error')::INT) AS intervention FROM e GROUP BY 1 HAVING bool_or(event_type = 'error')"""

# --- matrices ---------------------------------------------------------------------------------------


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    static = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    population = labels.master_labels(_population(spark, sf_dir), _labels(spark, sf_dir), "o_custkey")
    return matrix.assemble(population, [lookback(table(spark, sf_dir, "orders"), dates(spark), PRICE)], [static], "o_custkey")


def training_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 and M2."""
    return rounded(_matrix(spark, sf_dir))


_PRICE_COLUMNS = [f"ord_id_{w}_price_{f}" for w in ("p1m", "p1y", "p5y") for f in ("sum", "avg", "count", "min", "max")]
_PRICES = _window_sql("round(sum(o_totalprice) {f}, 7) AS ord_id_{w}_price_sum, round(avg(o_totalprice) {f}, 7) AS ord_id_{w}_price_avg, count(o_totalprice) {f} AS ord_id_{w}_price_count, min(o_totalprice) {f} AS ord_id_{w}_price_min, max(o_totalprice) {f} AS ord_id_{w}_price_max")
TRAINING = f"SELECT o_custkey, as_of_date, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _PRICE_COLUMNS)}, coalesce(c_acctbal, 0) AS c_acctbal, outcome FROM ({MASTER}) LEFT JOIN ({_PRICES}) USING (o_custkey, as_of_date) LEFT JOIN customer ON c_custkey = o_custkey"


def single_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3."""
    features = lookback(table(spark, sf_dir, "orders"), dates(spark), PRICE).select("o_custkey", "as_of_date", "ord_id_p1y_price_count")
    return matrix.single_table(features, _labels(spark, sf_dir), _population(spark, sf_dir), "o_custkey")


SINGLE = f"SELECT o_custkey, as_of_date, ord_id_p1y_price_count, coalesce(outcome, 0) AS outcome FROM ({_PRICES}) LEFT JOIN ({AND_OR}) USING (o_custkey, as_of_date) SEMI JOIN ({ACTIVE}) USING (o_custkey, as_of_date)"


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"))


def mean_impute_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4."""
    return rounded(matrix.impute_mean(_gaps(spark, sf_dir).drop("segment"), ["balance"]), 4)


_GAPS = "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer"
MEAN_IMPUTE = f"SELECT c_custkey, round(coalesce(balance, avg(balance) OVER ()), 4) AS balance, (balance IS NULL)::INT AS imputation_balance FROM ({_GAPS})"


def zero_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: orders of each customer, 0 where there are none."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return matrix.impute_zero(n, table(spark, sf_dir, "customer").select("c_custkey", F.lit(0).cast("long").alias("n")), "c_custkey", "n")


ZERO_IMPUTE = "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1"


def aligned_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two periods with one set of columns."""
    train, test = matrix.temporal_split(table(spark, sf_dir, "orders"), "o_orderdate", "1999-01-01", F.expr("INTERVAL '2' YEAR"), F.expr("INTERVAL '1' YEAR"))
    train = train.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("highest"))
    test = test.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("lowest"))
    a, b = matrix.align(train, test, ["o_custkey"])
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))


ALIGNED = """SELECT o_custkey, max(o_totalprice) AS highest, 0 AS lowest, count(*) AS n, 'train' AS part FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-01-01' GROUP BY 1
UNION ALL SELECT o_custkey, 0, min(o_totalprice), count(*), 'test' FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-01-01' GROUP BY 1"""


def undersampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: the share of positives is a third; the negatives of the least hashes stay."""
    rows = _matrix(spark, sf_dir).select("o_custkey", F.year("as_of_date").alias("year"), "as_of_date", "outcome")
    return matrix.undersample(rows, "outcome", 1 / 3, ["o_custkey", "year"]).select("o_custkey", "as_of_date", "outcome")


UNDERSAMPLED = f"WITH m AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY md5(o_custkey || '|' || year(as_of_date))) AS k, sum(outcome) OVER () AS p FROM ({MASTER})) SELECT o_custkey, as_of_date, outcome FROM m WHERE outcome = 1 OR k <= p * 2"


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: scaled by customers of the first regions' balances."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    scaled = matrix.scale(customers.filter("c_nationkey < 12"), [customers], ["c_acctbal"])[1]
    return rounded(scaled.select("c_custkey", "c_acctbal"), 6)


SCALE = "SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer WHERE c_nationkey < 12)) / (SELECT stddev_pop(c_acctbal) FROM customer WHERE c_nationkey < 12), 6) AS c_acctbal FROM customer"


def dummies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9."""
    return matrix.dummies(_gaps(spark, sf_dir).drop("balance"), "segment")


DUMMIES = "SELECT c_custkey, " + ", ".join(f"coalesce((segment = '{s}')::INT, 0) AS \"is_{s}\"" for s in ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + f" FROM ({_GAPS})"

# --- events -----------------------------------------------------------------------------------------
START, END = "1997-01-01", "1998-12-31"
_PERIOD = f"o_orderdate BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


def _hub(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The orders of the period, and all lines with o_orderkey, in parts of the same orders."""
    lines, orders = lines_and_orders(spark, sf_dir)
    return event_features.in_period(orders, "o_orderdate", START, END), lines


def event_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order with a returned line."""
    hub, lines = _hub(spark, sf_dir)
    returned = lines.select("o_orderkey", F.when(F.col("l_returnflag") == "R", 1).alias("returned"))
    return event_features.outcome_label(hub, returned, "o_orderkey", "o_orderkey", "returned", "label")


EVENT_LABEL = f"SELECT o_orderkey, (coalesce(sum((l_returnflag = 'R')::INT), 0) > 0)::INT AS label FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE {_PERIOD} GROUP BY 1"


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2."""
    return event_features.calendar_parts(table(spark, sf_dir, "events"), "event_id", "ts")


CALENDAR = 'SELECT event_id, minute(ts)::INT AS "minute", hour(ts)::INT AS "hour", dayofweek(ts)::INT AS day_of_week, quarter(ts)::INT AS "quarter", month(ts)::INT AS "month", year(ts)::INT AS "year" FROM events'


def event_attribute_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 and D5."""
    return event_features.attribute(*_hub(spark, sf_dir), "o_orderkey", "o_orderkey", {"top_quantity": "max(l_quantity)", "n_lines": "count(1)", "first_flag": "min(l_returnflag)"})


ATTRIBUTE_MAX = f"SELECT o_orderkey, max(l_quantity) AS top_quantity, count(*) AS n_lines, min(l_returnflag) AS first_flag FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE {_PERIOD} GROUP BY 1"


def capped_travel_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from order to shipment, under 60."""
    hub, lines = _hub(spark, sf_dir)
    lines = lines.join(hub.select("o_orderkey", "o_orderdate"), "o_orderkey").withColumn("days", F.datediff("l_shipdate", "o_orderdate"))
    return rounded(event_features.attribute(hub, lines, "o_orderkey", "o_orderkey", {"avg_days": "avg(days)", "min_days": "min(days)", "max_days": "max(days)"}, F.col("days") < 60))


TRAVEL = f"SELECT o_orderkey, round(avg(d), 7) AS avg_days, min(d)::INT AS min_days, max(d)::INT AS max_days FROM (SELECT o_orderkey, date_diff('day', o_orderdate, l_shipdate) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE {_PERIOD}) WHERE d < 60 GROUP BY 1"

_HOURS = {"in_1h": 3600, "in_6h": 21600, "in_12h": 43200}


def band_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors in the hours before each purchase."""
    events = table(spark, sf_dir, "events")
    return banding.band_counts(events.filter("event_type = 'purchase'"), events.filter("event_type = 'error'"), "event_id", "ts", "ts", _HOURS, keep_empty=True)


def _band_sql(extra: str = "") -> str:
    counts = ", ".join(f"count(b.ts) FILTER (WHERE b.ts >= a.ts - INTERVAL {s} SECOND) AS {k}" for k, s in _HOURS.items())
    return f"SELECT a.event_id, {counts} FROM (SELECT * FROM events WHERE event_type = 'purchase') a LEFT JOIN (SELECT * FROM events WHERE event_type = 'error'{extra}) b ON b.ts <= a.ts AND b.ts >= a.ts - INTERVAL 43200 SECOND GROUP BY 1"


def band_count_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of errors of some worth."""
    events = table(spark, sf_dir, "events")
    return banding.band_counts(events.filter("event_type = 'purchase'"), events.filter("event_type = 'error' and value > 10"), "event_id", "ts", "ts", _HOURS, keep_empty=True)


_DAYS = 86400
_BANDS = {"near_week": (7 * _DAYS, 40.0), "near_day": (_DAYS, 40.0), "close_week": (7 * _DAYS, 15.0)}


def _urgent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_orders(spark, sf_dir).join(table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey"), "o_orderkey", "left_semi")


def radius_band_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders near each order in time and place."""
    return banding.radius_counts(placed_orders(spark, sf_dir), _urgent(spark, sf_dir), "o_orderkey", "o_orderdate", "o_orderdate", _BANDS)


def radius_band_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders near each order in time and place."""
    placed = placed_orders(spark, sf_dir)
    return banding.radius_counts(placed, placed, "o_orderkey", "o_orderdate", "o_orderdate", _BANDS)


_PLACED = "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, ((o_custkey * 37) % 1000)::DOUBLE AS lon, ((o_custkey * 91) % 1000)::DOUBLE AS lat FROM orders"


def _radius_sql(test: str) -> str:
    inside = "(a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat) <= {r} AND b.o_orderdate >= a.o_orderdate - INTERVAL {s} SECOND"
    counts = ", ".join(f"count(*) FILTER (WHERE {inside.format(r=r * r, s=s)}) AS {k}" for k, (s, r) in _BANDS.items())
    return f"WITH p AS ({_PLACED}) SELECT a.o_orderkey, {counts} FROM p a JOIN p b ON b.o_orderdate < a.o_orderdate AND {inside.format(r=1600, s=7 * _DAYS)} WHERE {test} GROUP BY 1"


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each order and supplier, placed where the customer is."""
    return responders(spark, sf_dir).join(placed_orders(spark, sf_dir).select("o_orderkey", "lon", "lat"), "o_orderkey")


_ENTITY_BANDS = {"near_year": (365 * _DAYS, 200.0), "near_quarter": (91 * _DAYS, 200.0)}


def entity_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each responder's own earlier dispatches nearby; average and maximum over responders."""
    sites = io.stored(_sites(spark, sf_dir), "sites")
    return rounded(banding.entity_radius_counts(sites, sites, "o_orderkey", "s_suppkey", "t", "t", _ENTITY_BANDS, {"avg": "avg", "max": "max"}))


ENTITY_RADIUS = f"""WITH s AS (SELECT r.*, lon, lat FROM {RESPONDERS_SQL} r JOIN ({_PLACED}) USING (o_orderkey)),
c AS (SELECT a.o_orderkey, a.s_suppkey, count(*) AS y, count(*) FILTER (WHERE b.t >= a.t - INTERVAL 91 DAY) AS q FROM s a JOIN s b ON a.s_suppkey = b.s_suppkey AND b.t < a.t AND b.t >= a.t - INTERVAL 365 DAY
  AND (a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat) <= 40000 GROUP BY ALL)
SELECT o_orderkey, round(avg(y), 7) AS avg_near_year, max(y) AS max_near_year, round(avg(nullif(q, 0)), 7) AS avg_near_quarter, max(nullif(q, 0)) AS max_near_quarter FROM c GROUP BY 1"""


def entity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned and urgent lines of each responder before the order."""
    lines, windows = table(spark, sf_dir, "lineitem"), {"3y": (36, 0), "1y": (12, 0)}
    past = lines.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").alias("past"), (F.col("l_returnflag") == "R").cast("int").alias("returned"), F.col("l_quantity").cast("int").alias("quantity"))
    return rounded(event_features.responder_history(responders(spark, sf_dir), past, "o_orderkey", "s_suppkey", "t", "past", {"returned": "returned", "quantity": "quantity"}, windows, parts=task_parts(lines, len(windows) + 2)))


ENTITY_HISTORY = (
    f"WITH c AS (SELECT o_orderkey, s_suppkey, sum((l_returnflag = 'R')::INT)::BIGINT AS returned_3y, sum(l_quantity::INT)::BIGINT AS quantity_3y, (sum((l_returnflag = 'R')::INT) FILTER (WHERE l_shipdate >= t - INTERVAL 12 MONTH))::BIGINT AS returned_1y, (sum(l_quantity::INT) FILTER (WHERE l_shipdate >= t - INTERVAL 12 MONTH))::BIGINT AS quantity_1y FROM {RESPONDERS_SQL} JOIN lineitem ON l_suppkey = s_suppkey AND l_shipdate < t AND l_shipdate >= t - INTERVAL 36 MONTH GROUP BY ALL) SELECT o_orderkey, "
    + ", ".join(f"{'round(' if f == 'avg' else ''}{f}({n}){', 7)' if f == 'avg' else ''} AS {f}_{n}" for f in ("avg", "min", "max") for n in ("returned_3y", "quantity_3y", "returned_1y", "quantity_1y"))
    + " FROM c GROUP BY 1"
)


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.min("l_shipdate").alias("born"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(first, "s_suppkey")


def responder_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time since each responder's first shipment, and the nation codes."""
    r, s = responders(spark, sf_dir), _suppliers(spark, sf_dir)
    return rounded(event_features.responder_age(r, s, "o_orderkey", "s_suppkey", "t", "born", "s_nationkey", task_parts(table(spark, sf_dir, "lineitem"))))


RESPONDER_AGE = f"""WITH b AS (SELECT l_suppkey AS s_suppkey, min(l_shipdate) AS born FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(avg(a), 7) AS avg_age, max(a) AS max_age, min(a) AS min_age, max(s_nationkey) AS highest_s_nationkey, min(s_nationkey) AS lowest_s_nationkey
FROM (SELECT o_orderkey, s_nationkey, round_even(date_diff('day', born, t) / 365.0, 0)::DOUBLE AS a FROM {RESPONDERS_SQL} JOIN b USING (s_suppkey) JOIN supplier USING (s_suppkey)) GROUP BY 1"""


def responder_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11."""
    shares = event_features.responder_proportion(responders(spark, sf_dir), table(spark, sf_dir, "supplier"), "o_orderkey", "s_suppkey", "s_nationkey", {"low_nation": "s_nationkey < 8", "two_nations": "s_nationkey in (3, 4)"}, task_parts(table(spark, sf_dir, "lineitem")))
    return rounded(shares, 6)


PROPORTION = f"SELECT o_orderkey, round(sum((s_nationkey < 8)::INT) / (count(s_nationkey) + 0.00001::DOUBLE), 6) AS low_nation, round(sum((s_nationkey IN (3, 4))::INT) / (count(s_nationkey) + 0.00001::DOUBLE), 6) AS two_nations FROM {RESPONDERS_SQL} JOIN supplier USING (s_suppkey) GROUP BY 1"


def tract_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of the nation that an order comes from."""
    areas = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("people"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"))
    return rounded(event_features.area_attributes(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), areas, "o_orderkey", "o_custkey", "c_nationkey", {"people": "people", "debt_share": "in_debt / (people + 0.00001D)"}), 6)


TRACT = "WITH a AS (SELECT c_nationkey, count(*) AS people, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt FROM customer GROUP BY 1) SELECT o_orderkey, people, round(in_debt / (people + 0.00001::DOUBLE), 6) AS debt_share FROM orders JOIN customer ON o_custkey = c_custkey JOIN a USING (c_nationkey)"


def event_wide_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D16."""
    return rounded(event_features.event_table(_hub(spark, sf_dir)[0], [event_label(spark, sf_dir), event_attribute_max(spark, sf_dir), capped_travel_time(spark, sf_dir), responder_proportion(spark, sf_dir)], "o_orderkey"))


EVENT_WIDE = f"SELECT * FROM (SELECT o_orderkey FROM orders WHERE {_PERIOD}) LEFT JOIN ({EVENT_LABEL}) USING (o_orderkey) LEFT JOIN ({ATTRIBUTE_MAX}) USING (o_orderkey) LEFT JOIN ({TRAVEL}) USING (o_orderkey) LEFT JOIN ({PROPORTION}) USING (o_orderkey)"

QUERIES = {
    f.__name__: f
    for f in (
        unpivot_attributes, event_collapse, forward_window_label, forward_window_closed, and_or_label, active_population, sworn_population, master_labels, flagged_baseline, intervention_lookup, training_matrix, single_table,
        mean_impute_flag, zero_impute, aligned_matrices, undersampled, standard_scale, dummies, event_label, calendar_parts, event_attribute_max, capped_travel_time, band_count, band_count_flagged, radius_band_count,
        radius_band_self, entity_radius, entity_history, responder_age, responder_proportion, tract_ratio, event_wide_join,
    )
}
SQL = {
    "unpivot_attributes": ATTRIBUTES, "event_collapse": EVENT_COLLAPSE, "forward_window_label": f"SELECT * EXCLUDE (pairs) FROM ({_FORWARD})",
    "forward_window_closed": f"SELECT as_of_date, count(*) AS n_events FROM ({_COLLAPSED}) JOIN {DATES_SQL} ON min_date > as_of_date AND max_date <= as_of_date + INTERVAL 12 MONTH GROUP BY 1",
    "and_or_label": AND_OR, "active_population": ACTIVE, "sworn_population": SWORN, "master_labels": MASTER, "flagged_baseline": FLAGGED, "intervention_lookup": INTERVENTION, "training_matrix": TRAINING, "single_table": SINGLE,
    "undersampled": UNDERSAMPLED, "mean_impute_flag": MEAN_IMPUTE, "zero_impute": ZERO_IMPUTE, "aligned_matrices": ALIGNED, "standard_scale": SCALE, "dummies": DUMMIES, "event_label": EVENT_LABEL, "calendar_parts": CALENDAR, "event_attribute_max": ATTRIBUTE_MAX,
    "capped_travel_time": TRAVEL, "band_count": _band_sql(), "band_count_flagged": _band_sql(" AND value > 10"), "radius_band_count": _radius_sql("b.o_orderpriority = '1-URGENT'"), "radius_band_self": _radius_sql("true"),
    "entity_radius": ENTITY_RADIUS, "entity_history": ENTITY_HISTORY, "responder_age": RESPONDER_AGE, "responder_proportion": PROPORTION, "tract_ratio": TRACT, "event_wide_join": EVENT_WIDE,
}
