"""Trailing windows from states by entity and day against all events, with bounds at any time of day."""

import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from retrospect.operators import blocks
from retrospect.operators.blocks import Block, Quantity, lookback

FUNCTIONS = ("sum", "avg", "count", "min", "max", "variance", "cv", "mode")
WINDOWS = {"p1d": (0, 1), "p1m": (1, 0), "p1y": (12, 0)}


def back(t, step):
    months, days = step
    month = t.month - 1 - months
    return t.replace(year=t.year + month // 12, month=month % 12 + 1) - datetime.timedelta(days=days)


@pytest.mark.parametrize("clock", [(0, 0), (13, 30)])
def test_states_by_day_equal_all_events(spark, clock):
    rng = random.Random(4)
    dates = [datetime.datetime(2020, m, 11, *clock) for m in (1, 2, 3, 9)]
    ends = [back(d, step) for d in dates for step in WINDOWS.values()] + dates
    events = []
    for k in range(900):
        t = rng.choice(ends) + datetime.timedelta(microseconds=rng.choice([-1, 0, 1])) if rng.random() < 0.3 else datetime.datetime(2019, 1, 1) + datetime.timedelta(minutes=rng.randrange(0, 900_000))
        events.append((None if k % 50 == 0 else 1 if rng.random() < 0.4 else rng.randrange(2, 9), None if k % 70 == 0 else t, rng.choice([None, 1.5, 2.0, 2.0, -4.25, 1e6]), rng.randrange(4)))
    block = Block("b", "e", "t", [Quantity("v", "v", FUNCTIONS), Quantity("w", "w", ("sum", "mode"))], WINDOWS)
    source = spark.createDataFrame(events, "e int, t timestamp_ntz, v double, w int")
    got = {(r["e"], r["as_of_date"]): r for r in lookback(source, spark.createDataFrame([(d,) for d in dates], "as_of_date timestamp_ntz"), block).collect()}
    want = {(e, d) for e, t, _, _ in events for d in dates if t is not None and back(d, WINDOWS["p1y"]) <= t < d}
    assert set(got) == want
    for (e, d), r in got.items():
        for label, step in WINDOWS.items():
            inside = [(v, w) for x, t, v, w in events if x == e and t is not None and back(d, step) <= t < d]
            values = [v for v, _ in inside if v is not None]
            n = len(values)
            mean = sum(values) / n if n else None
            expected = {
                "sum": sum(values) if n else None, "avg": mean, "count": n, "min": min(values, default=None), "max": max(values, default=None),
                "variance": statistics.variance(values) if n > 1 else None, "cv": statistics.stdev(values) / mean if n > 1 and mean else None,
            }
            for f, x in expected.items():
                found = r[f"b_id_{label}_v_{f}"]
                assert (found is None) == (x is None) and (x is None or math.isclose(found, x, rel_tol=1e-9, abs_tol=1e-6)), (label, f)
            for name, some in (("v", values), ("w", [w for _, w in inside])):
                assert r[f"b_id_{label}_{name}_mode"] == (min(some, key=lambda x: (-some.count(x), x)) if some else None)
            assert r[f"b_id_{label}_w_sum"] == (sum(w for _, w in inside) if inside else None)


def test_dates_meet_days_and_not_events(spark):
    """One entity of 20,000 events on 30 days: the join with the dates reads 30 rows."""
    source = spark.range(20_000).select(F.lit(7).alias("e"), (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 30, F.lit(0), F.lit(0), F.col("id") % 60)).alias("t"), F.lit(1).alias("v"))
    dates = spark.createDataFrame([(datetime.datetime(2020, 3, 1),)], "as_of_date timestamp_ntz")
    out = lookback(source, dates, Block("b", "e", "t", [Quantity("v", "v", ("sum",))], {"p1y": (12, 0)}))
    assert [tuple(r)[2] for r in out.collect()] == [20_000]
    plan = out._jdf.queryExecution().executedPlan().toString()
    join = plan.index("BroadcastNestedLoopJoin")
    assert plan[join:].count("HashAggregate") >= 2  # events are aggregated below the join


def test_no_events(spark):
    none = spark.createDataFrame([], "e int, t timestamp_ntz, v double, w int")
    dates = spark.createDataFrame([(datetime.datetime(2020, 3, 1),)], "as_of_date timestamp_ntz")
    assert lookback(none, dates, Block("b", "e", "t", [Quantity("v", "v", FUNCTIONS)], WINDOWS)).collect() == []


def test_levels_as_rows_equal_columns(spark):
    """Values as rows, made columns at the end, against a quantity for each value; nulls, odd bounds and weights included."""
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 2, 3, None]), datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=rng.randrange(24 * 90)), rng.choice(["a b", "c-d", "e", None]), rng.choice([None, 1.0, 2.0, 4.0])) for _ in range(500)]
    source = spark.createDataFrame(rows, "id int, t timestamp_ntz, kind string, w double")
    dates = spark.createDataFrame([("2020-02-01",), ("2020-03-01 07:30:00",), ("2030-01-01",)], "d string").select(F.col("d").cast("timestamp_ntz").alias("as_of_date"))
    windows = {"P1D": (0, 1), "P1M": (1, 0), "P9D": (0, 9)}
    for weight in (None, "w"):
        quantities = blocks.lookup_quantities("kind", "kind", [(v, v) for v in blocks.levels(source, "kind")], weight=weight)
        want = blocks.lookback(source, dates, blocks.Block("x", "id", "t", quantities, windows))
        got = blocks.lookback_levels(source, dates, "x", "id", "t", "kind", "kind", windows, weight)
        assert set(got.columns) == set(want.columns) and want.count() == got.count() > 5
        assert want.select(*want.columns).exceptAll(got.select(*want.columns)).count() == 0
        long = {(r["id"], r["as_of_date"], r["window"], r["level"]): (r["sum"], r["avg"]) for r in blocks.lookback_long(source, dates, "id", "t", "kind", windows, weight).collect() if r["id"] is not None}
        wide = {(r["id"], r["as_of_date"]): r for r in got.collect()}
        assert len(long) > 20
        for (e, d, w, v), pair in long.items():
            assert tuple(wide[e, d][f"x_id_{w.lower()}_kind_{blocks.column_name(v)}_{f}"] for f in ("sum", "avg")) == pair


def test_five_thousand_levels(spark):
    source = spark.range(20_000).select((F.col("id") % 7).alias("e"), F.lit("2020-01-05").cast("timestamp_ntz").alias("t"), (F.col("id") % 5000).alias("v"))
    dates = spark.createDataFrame([("2020-02-01",)], "d string").select(F.col("d").cast("timestamp_ntz").alias("as_of_date"))
    got = blocks.lookback_levels(source, dates, "x", "e", "t", "v", "v", {"P1M": (1, 0)}).collect()
    assert len(got) == 7 and len(got[0]) == 2 + 2 * 5000
    assert sum(r[f"x_id_p1m_v_{k}_sum"] for r in got for k in range(5000)) == 20_000
    with pytest.raises(ValueError, match="v has more than 4999 values"):
        blocks.levels(source, "v", 4999)
    assert blocks.lookback_long(source, dates, "e", "t", "v", {"P1M": (1, 0)}).agg(F.sum("sum")).first()[0] == 20_000
