"""Nearest neighbours from cells against all pairs."""

import random

import pytest

from retrospect.operators import models

SCHEMA = "id long, a double, b double, outcome int"


def brute(train, test, k, weights):
    good = lambda r: None not in r[1:3] and all(v == v for v in r[1:3])
    out = []
    for q in filter(good, test):
        near = sorted((((q[1] - r[1]) ** 2 + (q[2] - r[2]) ** 2, r[0], r[3]) for r in filter(good, train)))[:k]
        w = [1.0 if weights == "uniform" else 1 / (d**0.5 + 1e-12) for d, _, _ in near]
        if near:
            out.append((q[0], sum(x * y for x, (_, _, y) in zip(w, near, strict=True)) / sum(w)))
    return sorted(out)


@pytest.mark.parametrize(("pivots", "part", "k", "weights"), [(1, 1000, 5, "uniform"), (20, 16, 5, "distance"), (20, 16, 300, "uniform"), (256, 8, 1, "uniform")])
def test_equal_all_pairs(spark, monkeypatch, pivots, part, k, weights):
    """Lattice points with many ties, half of them in one place, nulls, and fewer rows than asked for."""
    monkeypatch.setattr(models, "PIVOTS", pivots)
    monkeypatch.setattr(models, "PART", part)
    rng = random.Random(2)
    point = lambda: (1.0, 2.0) if rng.random() < 0.3 else (rng.randrange(12) / 2, rng.uniform(0, 6) if rng.random() < 0.5 else rng.randrange(12) / 2)
    train = [(k, *point(), rng.randrange(2)) for k in range(260)] + [(900, None, 1.0, 1), (901, float("nan"), 1.0, 1)]
    test = [(k, *point(), 0) for k in range(90)] + [(5, 1.0, 2.0, 0), (800, None, 1.0, 0), (801, 1e9, -1e9, 0)]
    got = sorted(tuple(r) for r in models.nearest_neighbours(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), "id", ["a", "b"], k, weights).collect())
    want = brute(train, test, k, weights)
    assert [i for i, _ in got] == [i for i, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want])


def test_no_training_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, 1.0, 1.0, 0)], SCHEMA)
    assert models.nearest_neighbours(none, some, "id", ["a", "b"]).collect() == [] == models.nearest_neighbours(some, none, "id", ["a", "b"]).collect()


def test_svm_probabilities_of_unseen_rows(spark):
    """Few rows and many features: the machine parts its own rows better than others, the probabilities must not believe it."""
    rng = random.Random(3)
    rows = []
    for k in range(600):
        x = [rng.gauss(0, 1) for _ in range(12)]
        rows.append((k, int(x[0] + rng.gauss(0, 1.5) > 0), *x))
    names = [f"x{j}" for j in range(12)]
    frame = models.vectors(spark.createDataFrame(rows, ["id", "outcome", *names]), names)
    model = models.fit("svm", frame.filter("id < 120"), {"C": 10.0})
    scored = [(r["score"], r["outcome"]) for r in model.score(frame.filter("id >= 120")).select("score", "outcome").collect()]
    bins = [[(s, y) for s, y in scored if b / 5 <= s < (b + 1) / 5 or (b == 4 and s == 1)] for b in range(5)]
    error = sum(abs(sum(s for s, _ in some) - sum(y for _, y in some)) for some in bins) / len(scored)
    ones, zeros = ([s for s, y in scored if y == v] for v in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    print(error, auc)
    assert error < 0.12 and auc > 0.65
