"""As-of dates and temporal cross-validation grids. Steps are (months, days); month ends clamp, step after step."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Step = tuple[int, int]


def walk_back(start: Column, end: Column, months: Column, days: Column, inclusive: bool = True) -> Column:
    """The dates from end back to start by a step of months and days, in ascending order.

    Each date is the one before less the step, so the clamping at month ends accumulates. With inclusive=False the
    start is left out. A step of nothing gives the end alone.
    """
    reach = F.greatest(F.lit(0), F.datediff(end, start))
    shortest = F.greatest(months * 28 + days, F.lit(1))
    count = F.when(months + days > 0, F.floor(reach / shortest).cast("int") + 1).otherwise(F.lit(0))
    steps = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    all_dates = F.aggregate(steps, F.array(end), lambda dates, _: F.concat(dates, F.array(F.date_sub(F.add_months(F.element_at(dates, -1), -months), days))))
    kept = F.filter(all_dates, (lambda d: d >= start) if inclusive else (lambda d: d > start))
    return F.array_sort(F.array_distinct(kept))


def as_of_dates(spark: SparkSession, start: str, end: str, step: Step, inclusive: bool = True) -> DataFrame:
    """as_of_date (G2; G5 with the start left out)."""
    one = spark.range(1).select(F.to_date(F.lit(start)).alias("s"), F.to_date(F.lit(end)).alias("e"))
    return one.select(F.explode(walk_back(F.col("s"), F.col("e"), F.lit(step[0]), F.lit(step[1]), inclusive)).alias("as_of_date"))


def nested_as_of_dates(spark: SparkSession, start: str, end: str, update: Step, inner: Step) -> DataFrame:
    """as_of_date (G5): from each date of the outer walk an inner one, both with the start left out."""
    outer = as_of_dates(spark, start, end, update, inclusive=False)
    dates = walk_back(F.to_date(F.lit(start)), F.col("as_of_date"), F.lit(inner[0]), F.lit(inner[1]), inclusive=False)
    return outer.select(F.explode(dates).alias("as_of_date")).distinct()


def _grid(spark: SparkSession, options: dict[str, Sequence[Step]]) -> DataFrame:
    """A row for each combination of the parameters: {name}_months, {name}_days."""
    rows = [tuple(x for step in combination for x in step) for combination in product(*options.values())]
    return spark.createDataFrame(rows, ", ".join(f"{k}_months int, {k}_days int" for k in options)).coalesce(1)


def _minus(date: Column, name: str) -> Column:
    return F.date_sub(F.add_months(date, -F.col(f"{name}_months")), F.col(f"{name}_days"))


def temporal_splits(
    spark: SparkSession, start: str, end: str, prediction: Sequence[Step], update: Sequence[Step], train_size: Sequence[Step], train_frequency: Sequence[Step], test_frequency: Sequence[Step], test_ahead: Sequence[Step], activity: Sequence[Step]
) -> DataFrame:
    """A row for each combination of windows and each test end date (G3): bounds, and the dates of training and test.

    Test end dates walk back from `end` by the update window while start <= test end - update window.
    """
    names = {"prediction": prediction, "update": update, "train_size": train_size, "train_frequency": train_frequency, "test_frequency": test_frequency, "test_ahead": test_ahead, "activity": activity}
    grid = _grid(spark, names)
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    ends = grid.withColumn("test_end", F.explode(walk_back(first, last, F.col("update_months"), F.col("update_days")))).filter(_minus(F.col("test_end"), "update") >= first)
    bounds = ends.withColumn("test_start", _minus(F.col("test_end"), "test_ahead")).withColumn("train_end", _minus(F.col("test_start"), "prediction")).withColumn("train_start", _minus(F.col("train_end"), "train_size"))
    return bounds.withColumn("test_dates", walk_back(F.col("test_start"), F.col("test_end"), F.col("test_frequency_months"), F.col("test_frequency_days"))).withColumn(
        "train_dates", walk_back(F.col("train_start"), F.col("train_end"), F.col("train_frequency_months"), F.col("train_frequency_days"))
    )


def feature_dates(splits: DataFrame) -> DataFrame:
    """as_of_date: every date of training or test."""
    return splits.select(F.explode(F.concat("train_dates", "test_dates")).alias("as_of_date")).distinct()


def train_test_sets(spark: SparkSession, start: str, end: str, prediction: Sequence[Step], update: Sequence[Step], training: Sequence[Step], activity: Sequence[Step]) -> DataFrame:
    """Bounds by the older rule (G6): test end dates walk back while start < test end - 2 x prediction window."""
    names = {"prediction": prediction, "update": update, "training": training, "activity": activity}
    grid = _grid(spark, names)
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    ends = grid.withColumn("test_end", F.explode(walk_back(first, last, F.col("update_months"), F.col("update_days"), False)))
    twice = F.date_sub(F.add_months("test_end", -2 * F.col("prediction_months")), 2 * F.col("prediction_days"))
    kept = ends.filter(twice > first).withColumn("test_start", _minus(F.col("test_end"), "prediction"))
    return kept.withColumn("train_end", F.col("test_start")).withColumn("train_start", _minus(F.col("train_end"), "training"))


def block_subsets(blocks: Sequence[str], leave_out: int = 0) -> list[list[str]]:
    """All subsets of the feature blocks without `leave_out` of them."""
    if leave_out >= len(blocks):
        raise ValueError("no block is left")
    return [list(x) for x in combinations(blocks, len(blocks) - leave_out)]
