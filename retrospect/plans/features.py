"""Queries of entity-level features (G2-G6, O1-O14) and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks, catalog, temporal
from ..operators.blocks import Block, Quantity
from .tables import DATES_SQL, EVENT_DATES, EVENT_DATES_SQL, EVENT_WINDOWS, STATUS, WINDOWS, dates, table

# --- dates ------------------------------------------------------------------------------------------


def as_of_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly dates back from the last order, and the orders of each month before."""
    orders = table(spark, sf_dir, "orders")
    bounds = orders.agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    days = bounds.select(F.explode(temporal.walk_back(F.col("s"), F.col("e"), F.lit(1), F.lit(0))).alias("as_of_date"))
    at = F.col("as_of_date").cast("timestamp_ntz")
    hit = orders.join(F.broadcast(days), (F.col("o_orderdate") < at) & (F.col("o_orderdate") >= at - F.expr("INTERVAL '1' MONTH")))
    return days.join(hit.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("n")), "as_of_date", "left").select("as_of_date", F.coalesce("n", F.lit(0)).alias("n_orders"))


AS_OF_DATES = """
WITH RECURSIVE d(as_of_date) AS (
  SELECT max(o_orderdate)::DATE FROM orders
  UNION ALL SELECT (as_of_date - INTERVAL 1 MONTH)::DATE FROM d WHERE (as_of_date - INTERVAL 1 MONTH)::DATE >= (SELECT min(o_orderdate)::DATE FROM orders))
SELECT as_of_date, (SELECT count(*) FROM orders WHERE o_orderdate < as_of_date AND o_orderdate >= as_of_date - INTERVAL 1 MONTH) AS n_orders FROM d
"""


def _splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    years = lambda *n: [(12 * k, 0) for k in n]
    return temporal.temporal_splits(spark, str(first.date()), str(last.date()), years(1), [(6, 0)], years(1, 2), [(6, 0)], [(3, 0)], [(0, 0)], years(1))


def temporal_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounds of each split over the span of orders, and the orders that each trains on."""
    splits = _splits(spark, sf_dir).select("test_end", "train_size_months", "train_start", "train_end", F.size("train_dates").alias("n_train_dates"))
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).groupBy("d").count()
    hit = orders.join(F.broadcast(splits), (F.col("d") >= F.col("train_start")) & (F.col("d") <= F.col("train_end")))
    sums = hit.groupBy("test_end", "train_size_months").agg(F.sum("count").alias("n"))
    return splits.join(sums, ["test_end", "train_size_months"], "left").withColumn("n_orders", F.coalesce("n", F.lit(0))).drop("n")


TEMPORAL_SPLITS = """
WITH RECURSIVE b AS (SELECT min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e FROM orders),
w(test_end) AS (SELECT e FROM b UNION ALL SELECT (test_end - INTERVAL 6 MONTH)::DATE FROM w, b WHERE (test_end - INTERVAL 6 MONTH)::DATE >= s),
x AS (SELECT test_end, m AS train_size_months, (test_end - INTERVAL 12 MONTH)::DATE AS train_end FROM w, b, (SELECT unnest([12, 24]) AS m) WHERE (test_end - INTERVAL 6 MONTH)::DATE >= s),
y AS (SELECT *, (train_end - to_months(train_size_months))::DATE AS train_start FROM x),
z(test_end, train_size_months, d, train_start) AS (
  SELECT test_end, train_size_months, train_end, train_start FROM y
  UNION ALL SELECT test_end, train_size_months, (d - INTERVAL 6 MONTH)::DATE, train_start FROM z WHERE (d - INTERVAL 6 MONTH)::DATE >= train_start),
k AS (SELECT test_end, train_size_months, count(*)::INT AS n_train_dates FROM z GROUP BY ALL)
SELECT test_end, train_size_months::INT AS train_size_months, train_start, train_end, n_train_dates,
  (SELECT count(*) FROM orders WHERE o_orderdate::DATE BETWEEN train_start AND train_end) AS n_orders
FROM y JOIN k USING (test_end, train_size_months)
"""


def feature_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date of training or test, and the customers with an order before it."""
    days = temporal.feature_dates(_splits(spark, sf_dir))
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("d")).groupBy("d").count()
    sums = first.join(F.broadcast(days), F.col("d") < F.col("as_of_date")).groupBy("as_of_date").agg(F.sum("count").alias("n"))
    return days.join(sums, "as_of_date", "left").select("as_of_date", F.coalesce("n", F.lit(0)).alias("n_customers"))


def train_test_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds by the older rule, and the orders of each test period."""
    first, last = table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    sets = temporal.train_test_sets(spark, str(first.date()), str(last.date()), [(6, 0)], [(3, 0)], [(12, 0)], [(12, 0)]).select("test_end", "test_start", "train_end", "train_start")
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).groupBy("d").count()
    sums = orders.join(F.broadcast(sets), (F.col("d") >= F.col("test_start")) & (F.col("d") < F.col("test_end"))).groupBy("test_end").agg(F.sum("count").alias("n"))
    return sets.join(sums, "test_end", "left").withColumn("n_orders", F.coalesce("n", F.lit(0))).drop("n")


TRAIN_TEST_SETS = """
WITH RECURSIVE b AS (SELECT min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e FROM orders),
w(test_end) AS (SELECT e FROM b UNION ALL SELECT (test_end - INTERVAL 3 MONTH)::DATE FROM w, b WHERE (test_end - INTERVAL 3 MONTH)::DATE > s),
x AS (SELECT test_end, (test_end - INTERVAL 6 MONTH)::DATE AS test_start FROM w, b WHERE (test_end - INTERVAL 12 MONTH)::DATE > s)
SELECT test_end, test_start, test_start AS train_end, (test_start - INTERVAL 12 MONTH)::DATE AS train_start,
  (SELECT count(*) FROM orders WHERE o_orderdate::DATE >= test_start AND o_orderdate::DATE < test_end) AS n_orders FROM x
"""


def nested_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older feature dates, with an inner walk from each outer date, and the events of the day."""
    first, last = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    days = temporal.nested_as_of_dates(spark, str(first.date()), str(last.date()), (0, 5), (0, 3))
    n = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("as_of_date")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(n, "as_of_date", "left").select("as_of_date", F.coalesce("n", F.lit(0)).alias("n_events"))


NESTED_DATES = """
WITH RECURSIVE b AS (SELECT min(ts)::DATE AS s, max(ts)::DATE AS e FROM events),
w(d) AS (SELECT e FROM b WHERE e > s UNION ALL SELECT (d - INTERVAL 5 DAY)::DATE FROM w, b WHERE (d - INTERVAL 5 DAY)::DATE > s),
i(d) AS (SELECT d FROM w UNION ALL SELECT (d - INTERVAL 3 DAY)::DATE FROM i, b WHERE (d - INTERVAL 3 DAY)::DATE > s)
SELECT DISTINCT d AS as_of_date, (SELECT count(*) FROM events WHERE ts::DATE = d) AS n_events FROM i
"""

# --- windows ----------------------------------------------------------------------------------------

PRICE = Block("ord", "o_custkey", "o_orderdate", [Quantity("price", "o_totalprice", ("sum", "avg", "count", "min", "max"))], WINDOWS)
_MONTHS = {"p1m": 1, "p1y": 12, "p5y": 60}


def _window_sql(columns: str, source: str = "orders", entity: str = "o_custkey", time: str = "o_orderdate", days: str = DATES_SQL, months: dict | None = None, unit: str = "MONTH") -> str:
    """columns: a template with {w} for the window's name and {f} for its filter."""
    months = months or _MONTHS
    parts = ", ".join(columns.format(w=w, f=f"FILTER (WHERE {time} >= as_of_date - INTERVAL {m} {unit})") for w, m in months.items())
    return f"SELECT {entity}, as_of_date, {parts} FROM {source} JOIN {days} ON {time} < as_of_date AND {time} >= as_of_date - INTERVAL {max(months.values())} {unit} GROUP BY {entity}, as_of_date"


def rounded(df: DataFrame, digits: int = 7) -> DataFrame:
    """Floating sums depend on the order of addition in their last digits."""
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


def lookback_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 and O5."""
    return rounded(blocks.lookback(table(spark, sf_dir, "orders"), dates(spark), PRICE))


LOOKBACK_EXPR = _window_sql("round(sum(o_totalprice) {f}, 7) AS ord_id_{w}_price_sum, round(avg(o_totalprice) {f}, 7) AS ord_id_{w}_price_avg, count(o_totalprice) {f} AS ord_id_{w}_price_count, min(o_totalprice) {f} AS ord_id_{w}_price_min, max(o_totalprice) {f} AS ord_id_{w}_price_max")


def _status_block(prefix: str = "st", weight: str | None = None) -> Block:
    return Block(prefix, "o_custkey", "o_orderdate", blocks.lookup_quantities("status", "o_orderstatus", STATUS, weight=weight), WINDOWS)


def lookback_lookup_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2."""
    return rounded(blocks.lookback(table(spark, sf_dir, "orders"), dates(spark), _status_block()))


def _pivot_sql(prefix: str, weight: str = "") -> str:
    cols = ", ".join(f"{'round(' if weight else ''}sum((o_orderstatus = '{c}')::INT{weight}) {{f}}{', 7)' if weight else '::BIGINT'} AS {prefix}_id_{{w}}_status_{v}_sum, round(avg((o_orderstatus = '{c}')::INT{weight}) {{f}}, 7) AS {prefix}_id_{{w}}_status_{v}_avg" for c, v in STATUS)
    # a cast goes after the filter
    return _window_sql(cols)


def lookback_weighted_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3."""
    return rounded(blocks.lookback(table(spark, sf_dir, "orders"), dates(spark), _status_block("wt", "o_totalprice")))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def lookback_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 and O5 as rows: the parts that each supplier has shipped, each part a value of its own."""
    return blocks.lookback_long(table(spark, sf_dir, "lineitem"), dates(spark), "l_suppkey", "l_shipdate", "l_partkey", WINDOWS)


LOOKBACK_LONG = f"""WITH j AS (SELECT l_suppkey, as_of_date, w AS "window", l_partkey AS level, count(*)::BIGINT AS "sum" FROM lineitem JOIN {DATES_SQL} ON l_shipdate < as_of_date JOIN (VALUES {', '.join(f"('{w}', INTERVAL {m} MONTH)" for w, (m, _) in WINDOWS.items())}) v(w, d) ON l_shipdate >= as_of_date - d WHERE l_partkey IS NOT NULL GROUP BY ALL)
SELECT *, "sum" / (sum("sum") OVER (PARTITION BY l_suppkey, as_of_date, "window"))::DOUBLE AS "avg" FROM j"""


def lookback_distinct_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4."""
    orders = table(spark, sf_dir, "orders")
    block = Block("pr", "o_custkey", "o_orderdate", blocks.distinct_quantities("priority", orders, "o_orderpriority", ("sum",)), WINDOWS)
    return blocks.lookback(orders, dates(spark), block)


LOOKBACK_DISTINCT = _window_sql(", ".join(f"sum((o_orderpriority = '{p}')::INT) {{f}}::BIGINT AS pr_id_{{w}}_priority_{blocks.column_name(p)}_sum" for p in PRIORITIES))


def all_history_days_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6."""
    block = Block("ag", "o_custkey", "o_orderdate", [Quantity("dayssincelastorder", "datediff(as_of_date, o_orderdate)", ("min",)), Quantity("orderage", "floor(datediff(as_of_date, o_orderdate) / 365)", ("max",))])
    return blocks.history(table(spark, sf_dir, "orders"), dates(spark), block)


ALL_HISTORY = f"""
SELECT o_custkey, as_of_date, min(date_diff('day', o_orderdate, as_of_date))::INT AS ag_id_all_dayssincelastorder_min,
  max(floor(date_diff('day', o_orderdate, as_of_date) / 365.0))::BIGINT AS ag_id_all_orderage_max
FROM orders JOIN {DATES_SQL} ON o_orderdate < as_of_date GROUP BY ALL
"""

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def static_dummies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O7."""
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey", "left")
    quantities = [*blocks.lookup_quantities("segment", "c_mktsegment", [(s, s) for s in SEGMENTS], ("max",)), Quantity("region", "n_regionkey", ("max",)), Quantity("balance", "c_acctbal", ("max",))]
    return blocks.static(customers, Block("ocND", "c_custkey", "", quantities))


STATIC_DUMMIES = "SELECT c_custkey, " + ", ".join(f"max((c_mktsegment = '{s}')::INT) AS ocnd_id_segment_{s.lower()}_max" for s in SEGMENTS) + ", max(n_regionkey) AS ocnd_id_region_max, max(c_acctbal) AS ocnd_id_balance_max FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"


def monthly_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variance and coefficient of variation of monthly counts."""
    months = blocks.monthly(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", {"n": "count(1)", "n_priorities": "count(distinct o_orderpriority)"})
    block = Block("stat", "o_custkey", "month", [Quantity("count", "n", ("variance", "cv")), Quantity("priorities", "n_priorities", ("variance",))], {"P1Y": (12, 0), "P5Y": (60, 0)})
    return rounded(blocks.lookback(months, dates(spark), block))


MONTHLY_VARIANCE = _window_sql(
    "round(var_samp(n) {f}, 7) AS stat_id_{w}_count_variance, round(stddev_samp(n) {f} / avg(n) {f}, 7) AS stat_id_{w}_count_cv, round(var_samp(p) {f}, 7) AS stat_id_{w}_priorities_variance",
    "(SELECT o_custkey, date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(*) AS n, count(DISTINCT o_orderpriority) AS p FROM orders GROUP BY ALL)", time="month", months={"p1y": 12, "p5y": 60}
)


def mode_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest hour of a user's events, as its distance from noon."""
    block = Block("fi", "user_id", "ts", [Quantity("hour", "hour(ts) - 12", ("avg", "mode"))], EVENT_WINDOWS)
    return rounded(blocks.lookback(table(spark, sf_dir, "events"), dates(spark, EVENT_DATES), block))


MODE_HOUR = f"""
WITH e AS (SELECT user_id, as_of_date, (hour(ts) - 12)::INT AS h, ts >= as_of_date - INTERVAL 1 DAY AS d FROM events JOIN {EVENT_DATES_SQL} ON ts < as_of_date AND ts >= as_of_date - INTERVAL 7 DAY),
c AS (SELECT user_id, as_of_date, h, count(*) AS n7, count(*) FILTER (WHERE d) AS n1 FROM e GROUP BY ALL)
SELECT user_id, as_of_date, round(sum(h * n1) / nullif(sum(n1), 0), 7) AS fi_id_p1d_hour_avg,
  first(h ORDER BY n1 DESC, h) FILTER (WHERE n1 > 0) AS fi_id_p1d_hour_mode,
  round(sum(h * n7) / sum(n7), 7) AS fi_id_p7d_hour_avg, first(h ORDER BY n7 DESC, h) AS fi_id_p7d_hour_mode
FROM c GROUP BY ALL
"""


def shifted_year_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order meets its nation's totals of the year before; averages by customer."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").withColumn("year", F.year("o_orderdate"))
    area = orders.groupBy("c_nationkey", "year").agg(F.avg("o_totalprice").alias("area_price")).withColumn("year", F.col("year") + 1)
    block = Block("dem", "o_custkey", "o_orderdate", [Quantity("area_price", "area_price", ("avg",))], WINDOWS)
    return rounded(blocks.lookback(orders.join(area, ["c_nationkey", "year"]), dates(spark), block), 4)


SHIFTED_YEAR = "WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey), a AS (SELECT c_nationkey, y + 1 AS y, avg(o_totalprice) AS area_price FROM o GROUP BY ALL) " + _window_sql("round(avg(area_price) {f}, 4) AS dem_id_{w}_area_price_avg", "(SELECT o_custkey, o_orderdate, area_price FROM o JOIN a USING (c_nationkey, y))")


def movement_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O9."""
    features = blocks.lookback(table(spark, sf_dir, "orders"), dates(spark), Block("st", "o_custkey", "o_orderdate", blocks.lookup_quantities("status", "o_orderstatus", STATUS, ("sum",)), {"P5Y": (60, 0)}))
    columns = [f"st_id_p5y_status_{v}_sum" for _, v in STATUS]
    return blocks.movement_rate(features, columns, "movement").select("o_custkey", "as_of_date", "movement")


MOVEMENT = f"""
WITH c AS (SELECT o_custkey, as_of_date, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p
  FROM orders JOIN {DATES_SQL} ON o_orderdate < as_of_date AND o_orderdate >= as_of_date - INTERVAL 60 MONTH GROUP BY ALL)
SELECT o_custkey, as_of_date, coalesce(round((f + o + p - greatest(f, o, p))::DOUBLE / nullif(greatest(f, o, p), 0), 3), 0) AS movement FROM c
"""


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, days = table(spark, sf_dir, "orders"), dates(spark)
    price = blocks.lookback(orders, days, Block("ord", "o_custkey", "o_orderdate", [Quantity("price", "o_totalprice", ("sum",))], WINDOWS))
    status = blocks.lookback(orders, days, Block("st", "o_custkey", "o_orderdate", blocks.lookup_quantities("status", "o_orderstatus", STATUS, ("sum",)), {"P1Y": (12, 0)}))
    static = blocks.static(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), Block("ocND", "o_custkey", "", [Quantity("balance", "c_acctbal", ("max",))]))
    return rounded(catalog.wide_join([price, status], [static], "o_custkey"))


def wide_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O11."""
    return _wide(spark, sf_dir)


WIDE = (
    "WITH p AS ("
    + _window_sql("round(sum(o_totalprice) {f}, 7) AS ord_id_{w}_price_sum")
    + "), s AS ("
    + _window_sql(", ".join(f"sum((o_orderstatus = '{c}')::INT) {{f}}::BIGINT AS st_id_{{w}}_status_{v}_sum" for c, v in STATUS), months={"p1y": 12})
    + "), n AS (SELECT c_custkey AS o_custkey, round(max(c_acctbal), 7) AS ocnd_id_balance_max FROM customer GROUP BY 1) SELECT * FROM p FULL JOIN s USING (o_custkey, as_of_date) FULL JOIN n USING (o_custkey)"
)


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """column_name, n_known: how many rows of the wide table have a value."""
    wide = _wide(spark, sf_dir)
    columns = [c for c in wide.columns if "_id_" in c]
    return wide.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "value").groupBy("column_name").agg(F.count("value").alias("n_known"))


def catalog_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table's columns that serve two of three requests, and how many values they have."""
    known = _coverage(spark, sf_dir)
    wanted, windows = spark.createDataFrame([("price",), ("balance",), ("shifts",)], "feature string"), spark.createDataFrame([("P1Y",), ("P9Y",)], "window string")
    return catalog.resolve(wanted, windows, known)[0].join(known, "column_name")


_N_KNOWN = "SELECT '{c}' AS column_name, count({c}) AS n_known FROM x"
CATALOG_AVAILABLE = f"WITH x AS ({WIDE}) " + " UNION ALL ".join(_N_KNOWN.format(c=c) for c in ("ord_id_p1y_price_sum", "ocnd_id_balance_max"))


def catalog_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that no column with values serves."""
    known = _coverage(spark, sf_dir).filter("n_known > 0")
    wanted, windows = spark.createDataFrame([("price",), ("balance",), ("shifts",)], "feature string"), spark.createDataFrame([("P1Y",), ("P9Y",)], "window string")
    return catalog.resolve(wanted, windows, known)[1]


CATALOG_MISSING = f"""
WITH x AS ({WIDE}), k AS ({" UNION ALL ".join(_N_KNOWN.format(c=c) for c in ("ord_id_p1m_price_sum", "ord_id_p1y_price_sum", "ord_id_p5y_price_sum", "ocnd_id_balance_max"))}),
w AS (SELECT * FROM (SELECT unnest(['price', 'balance', 'shifts']) AS feature), (SELECT unnest(['P1Y', 'P9Y']) AS "window"))
SELECT feature, "window" FROM w WHERE NOT EXISTS (SELECT 1 FROM k WHERE n_known > 0 AND contains(column_name, '_' || feature || '_') AND (contains(column_name, '_' || lower("window") || '_') OR column_name NOT LIKE '%\\_id\\_p%' ESCAPE '\\'))
"""


def columns_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and known values of each window."""
    known = _coverage(spark, sf_dir)
    sums = catalog.parse_names(known).join(known, "column_name").groupBy("window").agg(F.sum("n_known").alias("n_known"))
    return catalog.by_window(known).join(sums, "window").select("window", F.array_join("columns", ",").alias("columns"), "n_known")


_ALL_WIDE = [f"ord_id_{w}_price_sum" for w in _MONTHS] + [f"st_id_p1y_status_{v}_sum" for _, v in STATUS] + ["ocnd_id_balance_max"]
COLUMNS_BY_WINDOW = f"""
WITH x AS ({WIDE}), k AS ({" UNION ALL ".join(_N_KNOWN.format(c=c) for c in _ALL_WIDE)})
SELECT CASE WHEN column_name LIKE 'ocnd%' THEN '' ELSE upper(split_part(column_name, '_', 3)) END AS "window", string_agg(column_name, ',' ORDER BY column_name) AS columns, sum(n_known)::BIGINT AS n_known FROM k GROUP BY 1
"""


def feature_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sentence and the known values of each column."""
    known = _coverage(spark, sf_dir)
    words = lambda *rows: spark.createDataFrame(list(rows), "name string, description string")
    said = catalog.describe(known, words(("ORD", "orders"), ("ST", "orders by status")), words(("Price", "total price")), words(("SUM", "the sum")))
    return said.join(known, "column_name").select("column_name", "description", "n_known")


def _description(c: str) -> str:
    block, rest = c.split("_id_")
    window = rest.split("_")[0] if rest.startswith("p") else ""
    feature, metric = (rest[len(window) + 1 :] if window else rest).rsplit("_", 1)
    named = {"ord": "orders", "st": "orders by status", "price": "total price", "sum": "the sum"}
    feature, _, kind = feature.partition("_")
    return f"{named.get(metric, metric)} of {named.get(feature, feature)}{' ' + kind if kind else ''} ({named.get(block, block)})" + (f" over {window.upper()}" if window else "")


FEATURE_DESCRIPTION = f"WITH x AS ({WIDE}) " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{_description(c)}' AS description, count({c}) AS n_known FROM x" for c in _ALL_WIDE)


def feature_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the wide table by how many of their features are known."""
    wide = _wide(spark, sf_dir)
    known = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in wide.columns if "_id_" in c])
    return wide.groupBy(known.alias("n_features")).agg(F.count(F.lit(1)).alias("n_rows"))


FEATURE_SET = f"WITH x AS ({WIDE}) SELECT ({' + '.join(f'({c} IS NOT NULL)::INT' for c in _ALL_WIDE)}) AS n_features, count(*) AS n_rows FROM x GROUP BY 1"

FEATURE_DATES = """
WITH RECURSIVE b AS (SELECT min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e FROM orders),
w(test_end) AS (SELECT e FROM b UNION ALL SELECT (test_end - INTERVAL 6 MONTH)::DATE FROM w, b WHERE (test_end - INTERVAL 6 MONTH)::DATE >= s),
x AS (SELECT test_end, m, (test_end - INTERVAL 12 MONTH)::DATE AS e2, ((test_end - INTERVAL 12 MONTH)::DATE - to_months(m))::DATE AS s2 FROM w, b, (SELECT unnest([12, 24]) AS m) WHERE (test_end - INTERVAL 6 MONTH)::DATE >= s),
z(d, s2) AS (SELECT e2, s2 FROM x UNION ALL SELECT (d - INTERVAL 6 MONTH)::DATE, s2 FROM z WHERE (d - INTERVAL 6 MONTH)::DATE >= s2),
f AS (SELECT o_custkey, min(o_orderdate)::DATE AS first FROM orders GROUP BY 1)
SELECT as_of_date, (SELECT count(*) FROM f WHERE first < as_of_date) AS n_customers FROM (SELECT d AS as_of_date FROM z UNION SELECT test_end FROM x)
"""

QUERIES = {
    f.__name__: f
    for f in (
        lookback_long, as_of_dates, temporal_splits, feature_dates, train_test_sets, nested_dates, lookback_expr, lookback_lookup_pivot, lookback_weighted_pivot, lookback_distinct_pivot, all_history_days_since, static_dummies,
        monthly_variance, mode_hour, shifted_year_join, movement_rate, wide_outer_join, catalog_available, catalog_missing, columns_by_window, feature_description, feature_set,
    )
}
SQL = {
    "as_of_dates": AS_OF_DATES, "temporal_splits": TEMPORAL_SPLITS, "feature_dates": FEATURE_DATES, "train_test_sets": TRAIN_TEST_SETS, "nested_dates": NESTED_DATES, "lookback_expr": LOOKBACK_EXPR,
    "lookback_lookup_pivot": _pivot_sql("st"), "lookback_weighted_pivot": _pivot_sql("wt", " * o_totalprice"), "lookback_distinct_pivot": LOOKBACK_DISTINCT, "lookback_long": LOOKBACK_LONG, "all_history_days_since": ALL_HISTORY, "static_dummies": STATIC_DUMMIES,
    "monthly_variance": MONTHLY_VARIANCE, "mode_hour": MODE_HOUR, "shifted_year_join": SHIFTED_YEAR, "movement_rate": MOVEMENT, "wide_outer_join": WIDE, "catalog_available": CATALOG_AVAILABLE,
    "catalog_missing": CATALOG_MISSING, "columns_by_window": COLUMNS_BY_WINDOW, "feature_description": FEATURE_DESCRIPTION, "feature_set": FEATURE_SET,
}
