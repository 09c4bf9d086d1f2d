"""Cut-offs by selection and ranks in ranges against sorted rows."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from retrospect.operators import evaluate, models

BY = ("model_id", "as_of_date")
SCHEMA = "model_id int, as_of_date string, id long, score double, pred int, label int"


def sets(seed, n, distinct):
    rng = random.Random(seed)
    ids = rng.sample(range(-5 * n, 5 * n), n)
    return [(rng.randrange(2), rng.choice(["a", "b"]), i, None if distinct == 0 else rng.randrange(distinct) / 7, 0, rng.randrange(2)) for i in ids]


@pytest.mark.parametrize(("distinct", "by"), [(0, ()), (5, ()), (1, BY), (5, BY), (10_000, BY)])
def test_cuts_equal_sorted_rows(spark, distinct, by):
    rows = sets(5, 700, distinct)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[0], r[1]) if by else ()].append(r)
    got = {(tuple(r[c] for c in by), r["metric"], r["parameter"]): r["value"] for r in evaluate.cut_metrics(frame, [1.0, 5.0, 33.0, 100.0], [1, 10, 50, 5000], by).collect()}
    binary = {(tuple(r[c] for c in by), r["id"]): r["pred"] for r in evaluate.binary_at(frame, 50, by).collect()}
    percent = {(tuple(r[c] for c in by), r["id"]): r["pred"] for r in evaluate.binary_at(frame, 33.0, by, percent=True).collect()}
    assert len(binary) == len(percent) == len(rows)
    for key, some in groups.items():
        order = sorted(some, key=lambda r: (-(r[3] if r[3] is not None else -1), r[2]))
        n, positives = len(order), sum(r[5] for r in order)
        for name, k in {"1.0_pct": n // 100, "5.0_pct": int(n * 0.05), "33.0_pct": int(n * 0.33), "100.0_pct": n, "1_abs": 1, "10_abs": 10, "50_abs": 50, "5000_abs": n}.items():
            tp = sum(r[5] for r in order[:k])
            assert got[key, "true positives@", name] == tp and got[key, "false negatives@", name] == positives - tp
            assert got[key, "false positives@", name] == k - tp and got[key, "true negatives@", name] == n - k - (positives - tp)
            assert got[key, "precision@", name] == pytest.approx(tp / k if k else 0)
        assert {r[2] for r in order[:50]} == {i for (g, i), p in binary.items() if g == key and p}
        assert {r[2] for r in order[: int(n * 0.33)]} == {i for (g, i), p in percent.items() if g == key and p}


def test_no_task_numbers_a_whole_tie(spark):
    """One score for all rows: they are numbered in hundreds of ranges of ids."""
    rows = spark.range(60_000).select(F.lit(1).alias("k"), F.col("id"), (F.col("id") % 3).alias("x")).repartition(4)
    assert evaluate.numbered_in_ranges(rows, ["k"], "id").filter("number != id + 1").count() == 0
    shuffled = spark.range(5_000).select(F.lit(None).cast("int").alias("k"), (F.xxhash64("id") % 1000).alias("id"))
    got = sorted((r["id"], r["number"]) for r in evaluate.numbered_in_ranges(shuffled, ["k"], "id").collect())
    assert [n for _, n in got] == list(range(1, 5_001))


@pytest.mark.parametrize("distinct", [1, 5, 10_000])
def test_prediction_ranks(spark, distinct):
    rows = sets(6, 500, distinct)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[0], r[1]].append(r[3])
    for r in models.prediction_ranks(spark.createDataFrame(rows, SCHEMA)).collect():
        some = groups[r["model_id"], r["as_of_date"]]
        rank = 1 + sum(s > r["score"] for s in set(some))
        assert r["rank_abs"] == rank and r["rank_pct"] == rank / len(some)


def test_all_metrics_equal_their_parts(spark):
    by = ("model_id", "as_of_date")
    frame = spark.createDataFrame(sets(7, 400, 5), SCHEMA)
    parts = [evaluate.global_metrics(frame, by), evaluate.curve_metrics(frame, by), evaluate.mean_rates(frame, by), evaluate.cut_metrics(frame, by=by)]
    assert sorted(tuple(r) for p in parts for r in p.collect()) == sorted(tuple(r) for r in evaluate.all_metrics(frame, by).collect())
