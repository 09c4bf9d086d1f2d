"""A grid of models is stored once, however often and from wherever it is run."""

import datetime
import random

import pytest

from retrospect.operators import models
from retrospect.sources import io

KINDS = {"decision_tree": {"max_depth": [1]}, "gaussian_nb": {}}


def matrices(spark):
    rng = random.Random(1)
    rows = [(k, rng.random(), rng.random(), k % 2) for k in range(120)]
    frame = spark.createDataFrame([(k, a + y / 3, b, y) for k, a, b, y in rows], "id long, a double, b double, outcome int")
    return {"one": (frame.filter("id < 60"), frame.filter("id >= 60"), "2020-01-01")}


def stored(spark, root):
    tables = {t: spark.read.parquet(f"{root}/{t}").drop("run_time").collect() for t in ("models", "predictions", "evaluations", "feature_importances")}
    return {t: sorted(map(str, rows)) for t, rows in tables.items()}


def test_second_and_interrupted_runs(spark, tmp_path, monkeypatch):
    root, args = f"{tmp_path}/store", ("id", [["a", "b"]])
    whole = f"{tmp_path}/whole"
    assert models.run_experiments(matrices(spark), *args, KINDS, whole, {"seed": 1}) == 2
    real, calls = io.registry_row, []

    def fails(*given):
        calls.append(given)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return real(*given)

    monkeypatch.setattr(io, "registry_row", fails)
    with pytest.raises(RuntimeError):
        models.run_experiments(matrices(spark), *args, KINDS, root, {"seed": 1}, threads=1)
    monkeypatch.setattr(io, "registry_row", real)
    left = spark.read.parquet(f"{root}/models").count()
    assert left == 1
    assert models.run_experiments(matrices(spark), *args, KINDS, root, {"seed": 1}) == 1
    assert stored(spark, root) == stored(spark, whole)
    assert models.run_experiments(matrices(spark), *args, KINDS, root, {"seed": 1}) == 0 and stored(spark, root) == stored(spark, whole)
    # other kinds get ids of their own and leave what is there
    assert models.run_experiments(matrices(spark), *args, {"decision_tree": {"max_depth": [1, 2]}}, root, {"seed": 1}) == 1
    rows = spark.read.parquet(f"{root}/models").select("model_id", "model_type").collect()
    assert sorted(r["model_id"] for r in rows) == [1, 2, 3] and spark.read.parquet(f"{root}/predictions").count() == 3 * 60
    assert set(stored(spark, whole)["predictions"]) < set(stored(spark, root)["predictions"])
    assert models.run_experiments({}, *args, KINDS, root, {}) == 0


def test_replace_with_nothing(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "model_id int, as_of_date timestamp_ntz, value int")
    one, two = datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2, 3, 4, 5)
    io.replace(rows((1, one, 1), (1, two, 2), (2, two, 3)), f"{tmp_path}/e")
    io.replace(rows((1, one, 7)), f"{tmp_path}/e", of=[{"model_id": 1, "as_of_date": one}, {"model_id": 1, "as_of_date": two}])
    assert sorted((r["model_id"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/e").collect()) == [(1, 7), (2, 3)]


def test_two_builders_of_one_matrix(spark, tmp_path):
    def build():
        io.archived(spark, f"{tmp_path}/m", {"a": 1}, lambda: spark.range(5))  # another one is faster
        return spark.range(3)

    assert io.archived(spark, f"{tmp_path}/m", {"a": 1}, build).count() == 5
    assert len([p for p in (tmp_path / "m").iterdir() if not p.name.startswith(".")]) == 1
