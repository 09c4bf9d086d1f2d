"""Counts by distance and time band against all pairs, in tiles of few and of many rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from retrospect.operators import banding

START = datetime.datetime(2020, 1, 1)
BANDS = {"near_day": (86_400, 4.0), "near_week": (7 * 86_400, 4.0), "close_week": (7 * 86_400, 1.5), "tiny": (3_600, 0.3)}
SCHEMA = "id int, e int, t timestamp_ntz, lon double, lat double"


def rows(seed, n, side):
    """Points on a lattice, so that many lie just on a circle, and some in between; a third of them in one place."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        x, y = ((rng.randrange(-side, side) / 2, rng.randrange(-side, side) / 2) if rng.random() < 0.5 else (rng.uniform(-side, side) / 2, rng.uniform(-side, side) / 2))
        if rng.random() < 0.33:
            x, y = 1.0, -1.0
        t = START + datetime.timedelta(seconds=rng.choice([3600 * rng.randrange(0, 500), rng.randrange(0, 1_800_000)]))
        out.append((k, rng.randrange(3), t, x, y))
    return [*out, (n, 1, None, 0.0, 0.0), (n + 1, None, START, 0.0, 0.0), (n + 2, 1, START, None, 0.0), (n + 3, 1, START, float("nan"), 0.0)]


def brute(left, right, by_entity):
    widest, reach = max(w for w, _ in BANDS.values()), max(r for _, r in BANDS.values())
    out = {}
    for i, e, t, x, y in left:
        for _, f, u, a, b in right:
            if None in (t, u, x, y, a, b) or (by_entity and (e is None or e != f)):
                continue
            age, square = (t - u).total_seconds(), (x - a) * (x - a) + (y - b) * (y - b)
            if 0 < age <= widest and square <= reach * reach:
                counts = out.setdefault((i, e) if by_entity else (i,), dict.fromkeys(BANDS, 0))
                for k, (w, r) in BANDS.items():
                    counts[k] += age <= w and square <= r * r
    return out


@pytest.mark.parametrize("by_entity", [False, True])
@pytest.mark.parametrize("crowded", [0, 12, 1 << 20])
def test_radius_counts_equal_all_pairs(spark, monkeypatch, crowded, by_entity):
    monkeypatch.setattr(banding, "CROWDED", crowded)
    left, right = rows(1, 150, 12), rows(2, 400, 12)
    got = banding.radius_counts(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "id", "t", "t", BANDS, keys=("e",) if by_entity else ())
    assert got.columns == (["id", "e"] if by_entity else ["id"]) + list(BANDS)
    found = {(r["id"], r["e"]) if by_entity else (r["id"],): {k: r[k] for k in BANDS} for r in got.collect()}
    assert found == brute(left, right, by_entity)
    assert len(found) > 100


@pytest.mark.parametrize("crowded", [0, 1 << 20])
def test_entity_radius_counts(spark, monkeypatch, crowded):
    monkeypatch.setattr(banding, "CROWDED", crowded)
    sites = [(i // 2, e, t, x, y) for i, e, t, x, y in rows(3, 200, 8)]
    sites = list({(i, e): (i, e, t, x, y) for i, e, t, x, y in sites}.values())
    frame = spark.createDataFrame(sites, SCHEMA)
    got = {r["id"]: r.asDict() for r in banding.entity_radius_counts(frame, frame, "id", "e", "t", "t", BANDS, {"avg": "avg", "max": "max"}).collect()}
    each = {}
    for (i, _), counts in brute(sites, sites, True).items():
        each.setdefault(i, []).append(counts)
    assert set(got) == set(each)
    for i, counts in each.items():
        for k in BANDS:
            values = [c[k] for c in counts if c[k]]
            assert got[i][f"avg_{k}"] == (pytest.approx(sum(values) / len(values)) if values else None) and got[i][f"max_{k}"] == (max(values) if values else None)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert banding.radius_counts(none, none, "id", "t", "t", BANDS).collect() == []


def test_crowded_tiles_join_only_the_border(spark, monkeypatch):
    """Twice the rows in a tile: the joined rows grow as rows times border cells, far below the pairs within the circle."""
    monkeypatch.setattr(banding, "CROWDED", 10)
    joined = {}
    real = banding.trailing_sums
    asked = {}

    def counted(left, *args, **kwargs):
        asked["cells"] = left.count()
        return real(left, *args, **kwargs)

    monkeypatch.setattr(banding, "trailing_sums", counted)
    for n in (200, 400):
        rng = random.Random(n)
        points = [(k, 0, START + datetime.timedelta(minutes=k), rng.uniform(0, 8), rng.uniform(0, 8)) for k in range(n)]
        frame = spark.createDataFrame(points, SCHEMA)
        got = banding.radius_counts(frame, frame, "id", "t", "t", {"a": (86_400 * 30, 4.0)})
        assert sum(r["a"] for r in got.collect()) == sum(c["near_day"] for c in brute_one(points).values())
        joined[n] = asked["cells"] / n
    assert joined[400] < 1.2 * joined[200]  # cells asked for each row don't depend on how many rows there are


def brute_one(points):
    return {i: {"near_day": sum(u < t and (x - a) ** 2 + (y - b) ** 2 <= 16 for _, _, u, a, b in points)} for i, _, t, x, y in points}


def test_entities_of_few_rows_are_not_laid_out_in_tiles(spark, monkeypatch):
    """A row looks into the time buckets that its band reaches, two at most here, and not into each tile of them."""
    laid, real = [], banding._range
    monkeypatch.setattr(banding, "_range", lambda low, high: laid.append(1) or real(low, high))
    left, right = rows(4, 150, 12), rows(5, 400, 12)
    frames = [spark.createDataFrame(r, SCHEMA) for r in (left, right)]
    got = banding.radius_counts(*frames, "id", "t", "t", BANDS, keys=("e",))
    assert {(r["id"], r["e"]): {k: r[k] for k in BANDS} for r in got.collect()} == brute(left, right, True)
    assert len(laid) == 1


@pytest.mark.parametrize("most", [2_048, 60])
def test_rows_of_one_place_and_time_are_one(spark, monkeypatch, most):
    """1,200 right rows of 40 places and times, some a circle's radius and a band's width apart, go to few tiles; left rows stay in theirs."""
    monkeypatch.setattr(banding, "CROWDED", most)
    seen, real = [], banding._reaching
    monkeypatch.setattr(banding, "_reaching", lambda *args: seen.append(real(*args).count()) or real(*args))
    at = lambda c: F.expr(f"timestamp_ntz'1969-12-31 12:00:00' + make_interval(0, 0, 0, 0, {c})")
    right = spark.range(1200).select((F.col("id") % 5 * 0.009).alias("lon"), (F.col("id") % 2 * 0.009).alias("lat"), at("id % 40 div 10 * 6").alias("t"))
    left = spark.range(120).select("id", (F.col("id") % 6 * 0.009 - 0.009).alias("lon"), (F.col("id") % 2 * 0.009).alias("lat"), at("id % 8 * 3").alias("t"))
    bands = {"day": (86_400, 0.009), "six": (6 * 3_600, 0.009), "near": (12 * 3_600, 0.001)}
    got = {r["id"]: tuple(r)[1:] for r in banding.radius_counts(left, right, "id", "t", "t", bands).collect()}
    a, b = left.collect(), right.collect()
    want = {}
    for x in a:
        n = tuple(sum(0 < (x["t"] - y["t"]).total_seconds() <= w and (x["lon"] - y["lon"]) * (x["lon"] - y["lon"]) + (x["lat"] - y["lat"]) * (x["lat"] - y["lat"]) <= r * r for y in b) for w, r in bands.values())
        want |= {x["id"]: n} if n[0] else {}
    assert got == want and want and seen[0] <= 40 * 9 * 2
