"""Past events of responders, summed where they lie, and in buckets of time for the busy ones."""

import random
from datetime import datetime, timedelta

from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from retrospect.operators import event_features

WINDOWS = {"m": (1, 0), "y": (12, 0)}


def _tables(spark):
    rng, start = random.Random(3), datetime(2020, 1, 1)
    moment = lambda: start + timedelta(days=rng.randrange(500), hours=rng.choice([0, 0, 7]))
    at = {e: moment() for e in range(60)}
    pairs = sorted({(rng.randrange(60), rng.choice([0, 0, 0, 1, 2, 3, None])) for _ in range(150)}, key=str)
    past = [(rng.choice([0, 0, 0, 1, 2, 4, None]), moment(), rng.choice([None, 1, 2, 5])) for _ in range(400)]
    left = spark.createDataFrame([(e, w, at[e]) for e, w in pairs], "event long, who long, t timestamp_ntz")
    return left, spark.createDataFrame(past, "who long, at timestamp_ntz, x int"), [(e, w, at[e]) for e, w in pairs], past


def _by_pairs(left, past):
    out = {}
    for e, w, t in left:
        mine = [(a, x or 0) for v, a, x in past if w is not None and v == w]
        sums = [[x for a, x in mine if t - relativedelta(months=m) <= a < t] for m in (1, 12)]
        if any(sums):
            out.setdefault(e, []).append([sum(s) if s else None for s in sums])
    known = lambda rows, k: [r[k] for r in rows if r[k] is not None]
    return {e: tuple(f(known(rows, k)) if known(rows, k) else None for f in (max, min) for k in (0, 1)) for e, rows in out.items()}


def test_busy_and_other_responders_equal_pairs(spark, monkeypatch):
    left, past, rows, events = _tables(spark)
    want = _by_pairs(rows, events)
    for limit in (100_000, 60, 0):
        monkeypatch.setattr(event_features, "BUSY", limit)
        for parts in (None, 5):
            got = event_features.responder_history(left, past, "event", "who", "t", "at", {"x": "x"}, WINDOWS, ["max", "min"], parts).collect()
            assert {r["event"]: (r["max_x_m"], r["max_x_y"], r["min_x_m"], r["min_x_y"]) for r in got} == want != {}, (limit, parts)


def test_rows_are_dealt_once_and_not_for_each_window(spark, monkeypatch):
    """3,000 responders and 700 past events are dealt, and their sums; windows are laid out afterwards."""
    kind, dealt = type(spark.range(1)), []
    real = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda rows, *args: dealt.append(rows.count()) or real(rows, *args))
    left = spark.range(3_000).select(F.col("id").alias("event"), (F.col("id") % 70).alias("who"), F.expr("timestamp_ntz'2020-03-01 00:00:00'").alias("t"))
    past = spark.range(700).select((F.col("id") % 70).alias("who"), F.expr("timestamp_ntz'2020-02-01 00:00:00' + make_interval(0, 0, 0, id % 20)").alias("at"), F.lit(2).alias("x"))
    made = event_features.responder_history(left, past, "event", "who", "t", "at", {"x": "x"}, {**WINDOWS, "q": (3, 0)}, ["max"], 4)
    assert sum(dealt) <= 2 * 3_000 + 700
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    assert {tuple(r)[1:] for r in made.collect()} == {(20, 20, 20)} and made.count() == 3_000
