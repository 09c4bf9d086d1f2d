"""Findings on larger tables: the same results without work that grows faster than the input."""

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from retrospect.operators import banding, event_features, models
from retrospect.operators.blocks import Block, Quantity, lookback
from retrospect.plans import catalogue, dispatches, outcomes, tables


def _dates(spark):
    return spark.createDataFrame([("2020-07-01",), ("2021-01-01",)], "d string").select(F.col("d").cast("timestamp_ntz").alias("as_of_date"))


def test_events_that_meet_rows_equal_their_pairs(spark):
    events = spark.range(400).select((F.col("id") % 7).alias("who"), F.expr("timestamp_ntz'2020-01-03 10:00:00' + make_interval(0, 0, 0, id % 300)").alias("at"), F.when(F.col("id") % 11 > 0, F.col("id") % 3).alias("area"))
    areas = spark.range(60).select((F.col("id") % 4).alias("area"), F.when(F.col("id") % 5 > 0, F.col("id") * 1.5).alias("x"))
    block = Block("b", "who", "at", [Quantity("x", "x", ("sum", "avg", "count", "min", "max", "variance", "cv"))], {"P1M": (1, 0), "P1Y": (12, 0)})
    numbers = lambda t: {(r[0], r[1]): [None if x is None else round(float(x), 6) for x in r[2:]] for r in t.collect()}
    got = numbers(lookback(events, _dates(spark), block, (areas, ["area"])))
    assert got and got == numbers(lookback(events.join(areas, "area"), _dates(spark), block))


def test_events_that_meet_many_rows_of_one_key(spark):
    """Forty billion pairs, which are never made."""
    events = spark.range(200_000).select(F.lit(1).alias("who"), F.expr("timestamp_ntz'2020-06-01 00:00:00'").alias("at"), F.lit(3).alias("area"))
    areas = spark.range(200_000).select(F.lit(3).alias("area"), F.col("id").cast("double").alias("x"))
    rows = lookback(events, _dates(spark), Block("b", "who", "at", [Quantity("x", "x", ("avg", "count"))], {"P1Y": (12, 0)}), (areas, ["area"])).collect()
    assert [tuple(r)[2:] for r in rows] == [(99_999.5, 200_000**2)] * 2


def _counted(spark, n):
    """Rows of a training matrix, and a number of those made so far, made again included."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for rows in batches:
            made.add(len(rows))
            yield rows

    rows = spark.range(0, n, 1, 4).select("id", (F.col("id") * 7919 % 1000 / 100).alias("x"), (F.col("id") * 104729 % 997 / 100).alias("y"))
    rows = rows.withColumn("outcome", (F.col("x") + F.col("y") / 4 > 6).cast("int"))
    return rows.mapInPandas(count, rows.schema), made


def test_fits_make_their_rows_once(spark):
    for kind, parameters in (("svm", {}), ("bagging", {"n_bags": 3, "n_estimators": 2, "max_depth": 2})):
        rows, made = _counted(spark, 2_000)
        assert models.fit(kind, models.vectors(rows, ["x", "y"]), parameters)
        assert made.value == 2_000, kind


def test_machines_learn_probabilities_when_asked_for_scores(spark):
    rows, made = _counted(spark, 2_000)
    model = models.fit("svm", models.vectors(rows, ["x", "y"]))
    assert model.calibration is None and len(models.importances(model, 2)) == 2
    scored = model.score(models.vectors(rows, ["x", "y"]))
    assert model.calibration is not None and made.value == 4_000
    assert scored.filter("score < 0 or score > 1 or (score > 0.5) <> (pred = 1)").isEmpty()


def test_experiments_make_their_matrices_once(spark, tmp_path):
    (train, trained), (test, tested) = _counted(spark, 1_000), _counted(spark, 1_200)
    assert models.run_experiments({"a": (train, test, "1999-01-01"), "b": (test, train, "2000-01-01")}, "id", [["x"], ["x", "y"]], {"gaussian_nb": {}}, f"{tmp_path}/root", {}) == 4
    assert (trained.value, tested.value) == (1_000, 1_200)


def test_cells_of_neighbours_grow_in_number(spark):
    """Cells hold fewer rows than a fixed number of them would; a batch of any size takes the memory of a piece of it."""
    assert models.pivots_of(10_000) == 256 and models.pivots_of(1_000_000) == 2_000 and models.pivots_of(10**9) == models.MOST_PIVOTS
    rng = np.random.default_rng(1)
    pivots, rows = rng.random((700, 2)), pd.DataFrame({"y": list(rng.random((3_000, 2)))})
    (got,) = models._assigned(pivots)(iter([rows]))
    whole = models._distances(np.stack(rows["y"]), pivots)
    assert (got["cell"] == whole.argmin(axis=1)).all() and np.allclose(got["away"], np.sqrt(whole.min(axis=1)))
    tracemalloc.start()
    (asked,) = models._cells_to_ask(pivots, np.full(700, 3), np.full(700, 0.1), 5, True)(iter([pd.DataFrame({"row": range(3_000), "x": rows["y"]})]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(len(c) == 2 for c in asked["cells"]) and peak < 3_000 * 700 * 8


def test_tasks_that_join_lines_to_orders_grow_in_number(spark, small, monkeypatch):
    n = tables.table(spark, small, "lineitem").count()
    want = sorted(map(tuple, tables.responders(spark, small).collect()))
    monkeypatch.setattr(tables, "TASK_LINES", n // 40)
    lines, orders = tables.lines_and_orders(spark, small)
    assert lines.rdd.getNumPartitions() == orders.rdd.getNumPartitions() >= 40
    assert sorted(map(tuple, tables.responders(spark, small).collect())) == want


def test_only_responders_with_a_past_lay_out_their_windows(spark, monkeypatch):
    """Of 300 responders one has a past, of 200 events at two times: three points of each of its 10 rows, and two of the past."""
    points, real = [], banding.running_sums
    monkeypatch.setattr(banding, "running_sums", lambda rows, *args: points.append(rows.count()) or real(rows, *args))
    responders = spark.range(3_000).select((F.col("id") % 10).alias("event"), F.floor(F.col("id") / 10).alias("who"), F.expr("timestamp_ntz'2020-03-01 00:00:00'").alias("t"))
    past = spark.range(200).select(F.when(F.col("id") % 4 > 0, 7).cast("long").alias("who"), F.expr("timestamp_ntz'2020-02-01 00:00:00' + make_interval(0, 0, 0, id % 2)").alias("at"), F.lit(2).alias("x"))
    rows = event_features.responder_history(responders, past, "event", "who", "t", "at", {"x": "x"}, {"m": (1, 0), "y": (12, 0)}, ["avg", "max"]).collect()
    assert sorted(r["event"] for r in rows) == list(range(10)) and {(r["avg_x_m"], r["max_x_y"]) for r in rows} == {(300.0, 300)}
    assert points == [3 * 10 + 2]


def test_bands_of_all_flags_ask_for_each_time_once(spark, monkeypatch):
    """500 events at 5 times and 300 rows at 10: three points of each time, and the rows' times, for two flags."""
    points, real = [], banding.running_sums
    monkeypatch.setattr(banding, "running_sums", lambda rows, *args: points.append(rows.count()) or real(rows, *args))
    at = lambda c: F.expr(f"timestamp_ntz'2020-02-01 00:00:00' + make_interval(0, 0, 0, 0, {c})")
    left = spark.range(500).select("id", at("id % 5").alias("t"))
    right = spark.range(300).select(at("id % 10").alias("past"), (F.col("id") % 10 == 2).alias("odd"))
    bands = {"h": (None, 3_600), "d": (None, 86_400), "odd_h": ("odd", 3_600)}
    got = {r["id"]: tuple(r)[1:] for r in banding.flagged_band_counts(left, right, "id", "t", "past", bands).collect()}
    assert points == [3 * 5 + 10]
    assert got == {i: (30 * min(i % 5 + 1, 2), 30 * (i % 5 + 1), 30 if i % 5 in (2, 3) else None) for i in range(500)}


def test_labels_come_from_one_join_in_tasks_that_grow_in_number(spark, monkeypatch):
    events = spark.range(400).select((F.col("id") % 100).alias("event_id"), F.col("id").alias("x"))
    incidents = spark.range(90).select((F.col("id") % 45).alias("event_id"), (F.col("id") % 2).alias("number_of_sustained_allegations"), F.when(F.col("id") % 3 > 0, F.col("id") % 3 - 1).alias("number_of_unjustified_allegations"))
    chosen = {n: p for n, (family, p) in dispatches.catalogue().items() if family == "outcome_label" and n != "LabelPreventable"}
    monkeypatch.setattr(dispatches, "TASK_EVENTS", 10)
    (made,) = dispatches._family("outcome_label", chosen, events, {"incidents": incidents})
    monkeypatch.setattr(dispatches, "TASK_EVENTS", 400)
    (whole,) = dispatches._family("outcome_label", chosen, events, {"incidents": incidents})
    assert made.rdd.getNumPartitions() == 40 and whole.rdd.getNumPartitions() == 4
    want = {(e, int(e < 45), int(e < 45 and any(k % 3 == 2 for k in (e, e + 45)))) for e in range(100)}
    assert {(r["event_id"], r["LabelSustained"], r["LabelUnjustified"]) for r in made.collect()} == want == {(r["event_id"], r["LabelSustained"], r["LabelUnjustified"]) for r in whole.collect()}


def test_tasks_of_event_features_grow_in_number(spark, small, monkeypatch):
    want = {f: sorted(map(tuple, f(spark, small).collect())) for f in (outcomes.event_label, outcomes.event_attribute_max, outcomes.capped_travel_time)}
    monkeypatch.setattr(tables, "TASK_LINES", tables.table(spark, small, "lineitem").count() // 40)
    for f, rows in want.items():
        made = f(spark, small)
        assert made.rdd.getNumPartitions() >= 40 and sorted(map(tuple, made.collect())) == rows


def test_tasks_of_windows_grow_in_number(spark):
    responders = spark.range(300).select((F.col("id") % 50).alias("event"), (F.col("id") % 7).alias("who"), F.expr("timestamp_ntz'2020-03-01 00:00:00'").alias("t"))
    past = spark.range(200).select((F.col("id") % 5).alias("who"), F.expr("timestamp_ntz'2020-02-01 00:00:00' + make_interval(0, 0, 0, id % 20)").alias("at"), F.lit(2).alias("x"))
    made = {n: event_features.responder_history(responders, past, "event", "who", "t", "at", {"x": "x"}, {"m": (1, 0), "y": (12, 0)}, ["avg", "max"], n) for n in (None, 13)}
    assert made[13].rdd.getNumPartitions() == 13
    assert sorted(map(tuple, made[13].collect())) == sorted(map(tuple, made[None].collect())) != []


def test_tasks_of_responders_grow_in_number_without_broadcasts(spark, small, monkeypatch):
    """Where entities are too many to be broadcast, rows are dealt by entity and again by event, into as many parts as the lines ask for."""
    queries = [outcomes.responder_age, outcomes.responder_proportion, *map(catalogue.dispatch_query, ("dispatch_responder_ages", "dispatch_responder_education"))]
    want = [sorted(map(str, f(spark, small).collect())) for f in queries]
    monkeypatch.setattr(tables, "TASK_LINES", tables.table(spark, small, "lineitem").count() // 40)
    monkeypatch.setattr(dispatches, "TASK_EVENTS", tables.table(spark, small, "lineitem").count() // 40)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert all(f(spark, small).rdd.getNumPartitions() >= 40 for f in queries[:2])
        assert [sorted(map(str, f(spark, small).collect())) for f in queries] == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
