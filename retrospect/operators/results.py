"""Queries over stored results: top models, rank movement, model groups, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_models(evaluations: DataFrame, models: DataFrame, since: str, metric: str, parameter: str | None = None, n: int = 25, columns: Sequence[str] = ("model_id", "metric", "parameter", "value", "run_time")) -> DataFrame:
    """The n best values of a metric among models run since a time (R1-R3); ties by model_id."""
    wanted = (F.col("metric") == metric) & ((F.col("parameter") == parameter) if parameter is not None else F.lit(True))
    recent = models.filter(F.col("run_time") >= F.lit(since).cast("timestamp_ntz"))
    return evaluations.filter(wanted).join(recent, "model_id").orderBy(F.desc("value"), "model_id").limit(n).select(*columns)


def top_with_artifacts(evaluations: DataFrame, models: DataFrame, artifacts: DataFrame, since: str, metric: str, n: int = 25) -> DataFrame:
    """The top models that have a stored artifact, with it."""
    return top_models(evaluations, models, since, metric, n=n).join(artifacts, "model_id")


def group_config(models: DataFrame, groups: DataFrame, group: int, paths: dict[str, str]) -> DataFrame:
    """Parts of a model group's configuration, by JSON path; one row, of the least model_id."""
    joined = models.join(groups.filter(F.col("model_group_id") == group), "model_group_id")
    return joined.orderBy("model_id").limit(1).select("model_group_id", *[F.get_json_object("config", p).alias(k) for k, p in paths.items()])


#: Names and rows of the look-backs in rank movement.
LAGS = {"last_day": 1, "last_week": 7, "last_month": 30, "last_quarter": 91, "last_year": 365}


def rank_movement(predictions: DataFrame, hub: DataFrame, entity: str = "entity_id", by_model: bool = False) -> DataFrame:
    """rank_pct less that of so many rows before, for each entity of the hub by date (R6); by_model keeps models apart."""
    w = Window.partitionBy(*(["model_id"] if by_model else []), entity).orderBy("as_of_date")
    moves = {k: F.col("rank_pct") - F.lag("rank_pct", n).over(w) for k, n in LAGS.items()}
    return predictions.join(hub.select(entity).distinct(), entity).withColumns(moves)


def model_groups(models: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """model_id and the id of its group: same type, parameters (canonical JSON), window and set of features.

    Groups in `known` keep their ids; new ones get the next, in the order of their keys.
    """
    key = ["model_type", "model_parameters", "prediction_window", "features"]
    named = models.withColumn("features", F.array_sort("features"))
    groups = named.select(*key).distinct()
    top = 0
    if known is not None:
        top = known.agg(F.coalesce(F.max("model_group_id"), F.lit(0))).first()[0]
        old = known.withColumn("features", F.array_sort("features"))
        fresh = groups.join(old, key, "left_anti")
    else:
        fresh = groups
    # groups of models are few beside predictions: one window numbers them
    fresh = fresh.withColumn("model_group_id", F.dense_rank().over(Window.orderBy("model_type", "model_parameters", "prediction_window", F.concat_ws(",", "features"))) + top)
    everything = fresh if known is None else fresh.unionByName(old.select(*key, "model_group_id"))
    return named.join(everything, key).select("model_id", "model_group_id")


def models_run_at(models: DataFrame, time: str) -> DataFrame:
    """model_id of the models of one run."""
    return models.filter(F.col("run_time") == F.lit(time).cast("timestamp_ntz")).select("model_id")


def class_histograms(matrix: DataFrame, features: Sequence[str], label: str, bins: int = 30) -> DataFrame:
    """feature, label, bin (1 to bins), count: equal bins between each feature's least and greatest value."""
    long = matrix.unpivot([label], list(features), "feature", "value").withColumn("value", F.col("value").cast("double")).filter("value is not null")
    range_of = long.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    joined = long.join(F.broadcast(range_of), "feature")
    place = F.floor((F.col("value") - F.col("_lo")) * bins / F.when(F.col("_hi") > F.col("_lo"), F.col("_hi") - F.col("_lo")).otherwise(F.lit(1.0))) + 1
    return joined.withColumn("bin", F.least(place, F.lit(bins)).cast("int")).groupBy("feature", label, "bin").count()
