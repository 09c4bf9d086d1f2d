"""The test tables in the roles of the surveyed data model: customers and users as entities, orders and events as event hubs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: As-of dates and trailing windows of the feature queries.
DATES = ("1998-01-01", "1999-01-01", "2000-01-01")
WINDOWS = {"P1M": (1, 0), "P1Y": (12, 0), "P5Y": (60, 0)}
EVENT_DATES = ("2024-01-10", "2024-01-20", "2024-01-30")
EVENT_WINDOWS = {"P1D": (0, 1), "P7D": (0, 7)}
#: Codes and values of lookups that the tables imply.
STATUS = (("F", "finished"), ("O", "open"), ("P", "pending"))
DATES_SQL = "(SELECT unnest([" + ", ".join(f"TIMESTAMP '{d}'" for d in DATES) + "]) AS as_of_date)"
EVENT_DATES_SQL = "(SELECT unnest([" + ", ".join(f"TIMESTAMP '{d}'" for d in EVENT_DATES) + "]) AS as_of_date)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dates(spark: SparkSession, values=DATES) -> DataFrame:
    return spark.createDataFrame([(d,) for d in values], "d string").select(F.col("d").cast("timestamp_ntz").alias("as_of_date"))


#: Places of customers: planar coordinates in whole thousandths, made from the key.
LON, LAT = "((o_custkey * 37) % 1000) / 1000.0", "((o_custkey * 91) % 1000) / 1000.0"


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", ((F.col("o_custkey") * 37) % 1000).cast("double").alias("lon"), ((F.col("o_custkey") * 91) % 1000).cast("double").alias("lat"))


#: Lines of a task that joins them to their orders, about.
TASK_LINES = 250_000


def task_parts(lines: DataFrame, copies: int = 1) -> int:
    """Tasks of TASK_LINES rows each for so many rows a line."""
    return max(4, -(-lines.count() * copies // TASK_LINES))  # Parquet knows its number of rows


def lines_and_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """lineitem and orders with o_orderkey, in parts of the same orders: as many as keep TASK_LINES, so a task's memory stays as tables grow."""
    lines, orders = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), table(spark, sf_dir, "orders")
    parts = task_parts(lines)
    return lines.repartition(parts, "o_orderkey"), orders.repartition(parts, "o_orderkey")


def responders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, supplier, time: an order is a dispatch, the suppliers of its lines respond to it."""
    lines, orders = lines_and_orders(spark, sf_dir)
    lines = lines.select("o_orderkey", F.col("l_suppkey").alias("s_suppkey"))
    return lines.join(orders.select("o_orderkey", F.col("o_orderdate").alias("t")), "o_orderkey").distinct()


RESPONDERS_SQL = "(SELECT DISTINCT l_orderkey AS o_orderkey, l_suppkey AS s_suppkey, o_orderdate AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, score, pred, label: length of a document as the score of its quality label."""
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")  # noqa: E741
    s = F.col("n_chars").cast("double")
    return d.join(l, "doc_id").select(F.col("doc_id").alias("id"), s.alias("score"), (s > 1000).cast("int").alias("pred"), F.col("quality").alias("label"))


SCORES_SQL = "(SELECT doc_id AS id, n_chars::DOUBLE AS score, (n_chars > 1000)::INT AS pred, quality AS label FROM documents JOIN labels USING (doc_id))"
