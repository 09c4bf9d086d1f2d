"""Ranges of scores by approximate quantiles, whose values change each time that they are made."""

import random

import pytest
from pyspark.sql import functions as F

from retrospect.operators import evaluate, models


@pytest.fixture
def unsteady(spark, monkeypatch):
    """Quantiles that differ at each evaluation, as those of many rows do where executors send their parts in any order; nothing is broadcast."""
    real = F.percentile_approx

    def other(column, shares, accuracy):
        moved = F.udf(lambda bounds: sorted(b + random.SystemRandom().uniform(-40, 40) for b in bounds or []), "array<double>").asNondeterministic()
        return moved(real(F.col(column).cast("double"), shares, accuracy))

    monkeypatch.setattr(F, "percentile_approx", other)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_counts_of_all_ranges_use_the_same_bounds(spark, unsteady):
    rows = spark.range(0, 1_000, 1, 4).select(F.lit(1).alias("model_id"), "id", (F.col("id") * 7919 % 997).cast("double").alias("score"), F.lit(0).alias("pred"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    got = sorted((r["place"], r["score"], r["upto"], r["tp"], r["total"]) for r in evaluate.running_counts(rows, ["model_id"]).collect())
    of, want, upto, tp = {}, [], 0, 0
    for i in range(1_000):
        of.setdefault(float(i * 7919 % 997), []).append(i % 3 == 0)
    for place, score in enumerate(sorted(of, reverse=True), 1):
        upto, tp = upto + len(of[score]), tp + sum(of[score])
        want.append((place, score, upto, tp, 1_000))
    assert got == want
    metrics = {(r["metric"], r["parameter"]): r["value"] for r in evaluate.all_metrics(rows, ["model_id"]).collect()}
    assert len(metrics) == 112 and metrics["true positives@", "100.0_pct"] == 334.0
    assert metrics["true positives@", "500_abs"] == sum(y for _, _, y in sorted((-(i * 7919 % 997), i, i % 3 == 0) for i in range(1_000))[:500])


def test_numbers_of_all_ranges_use_the_same_bounds(spark, unsteady):
    rows = spark.range(0, 1_000, 1, 4).select("id", (F.col("id") % 2).alias("key"))
    numbers = {r["id"]: r["number"] for r in evaluate.numbered_in_ranges(rows, ["key"], "id").collect()}
    assert numbers == {i: i // 2 + 1 for i in range(1_000)}
    long = spark.range(0, 1_000, 1, 4).select(F.lit("x").alias("feature"), F.col("id").cast("double").alias("value"))
    assert {r["value"]: (r["rank"], r["n"]) for r in models._ranks(long).collect()} == {float(i): (i + 1.0, 1_000) for i in range(1_000)}
