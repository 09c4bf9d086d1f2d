"""Every query of the library's own operators against its SQL, on the smallest tables."""

import pytest

from retrospect.plans import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, small, duck, tmp_path, name):
    queries.QUERIES[name](spark, small).write.parquet(f"{tmp_path}/got")
    duck.sql(f"CREATE VIEW got AS SELECT * FROM read_parquet('{tmp_path}/got/*.parquet')")
    duck.sql(f"CREATE TABLE want AS {queries.SQL[name]}")
    got, want = (sorted(r[0] for r in duck.sql(f"DESCRIBE {t}").fetchall()) for t in ("got", "want"))
    assert got == want
    columns = ", ".join(f'"{c}"' for c in want)
    differ = duck.sql(f"SELECT count(*) FROM ((SELECT {columns} FROM got EXCEPT ALL SELECT {columns} FROM want) UNION ALL (SELECT {columns} FROM want EXCEPT ALL SELECT {columns} FROM got))").fetchall()
    assert differ == [(0,)]


def test_importances_of_every_kind(spark, small):
    """Trees, boosted and linear models have importances of each feature; bagging and Bayes have none."""
    found = {}
    for r in queries.QUERIES["feature_importances"](spark, small).collect():
        found.setdefault(r["kind"], []).append(r["importance"])
    assert {k: len(v) for k, v in found.items()} == {"random_forest": 12, "adaboost": 12, "svm": 12}


#: Areas under the curve on held-out orders that a model of each kind reaches at least.
FLOORS = {
    "model_random_forest": 0.9, "model_bagging": 0.9, "model_boosted_forest": 0.9, "model_svm": 0.85, "model_logistic_regression": 0.85, "model_adaboost": 0.85, "model_gradient_boosting": 0.9, "model_gaussian_nb": 0.75,
    "model_decision_tree": 0.85, "model_sgd": 0.85,
}


@pytest.mark.parametrize("name", sorted(FLOORS))
def test_models_rank_held_out_rows(spark, small, name):
    rows = queries.QUERIES[name](spark, small).filter("o_orderkey % 4 = 0").collect()
    ones, zeros = ([r["score"] for r in rows if r["outcome"] == y] for y in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    print(name, round(auc, 4))
    assert auc >= FLOORS[name]


def test_experiments_store_what_they_find(spark, small):
    rows = queries.QUERIES["experiment_results"](spark, small).collect()
    assert sorted(r["model_id"] for r in rows) == list(range(1, 13)) and len({r["experiment_hash"] for r in rows}) == 1
    assert {(r["model_type"], r["prediction_window"], r["n_features"]) for r in rows} == {(k, w, n) for k in ("decision_tree", "gaussian_nb") for w in ("early", "late") for n in (2, 4)}
    assert all(r["auc"] > 0.5 and (r["n_importances"] == r["n_features"] if r["model_type"] == "decision_tree" else r["n_importances"] is None) for r in rows)
    assert all(r["n_predictions"] > 500 for r in rows)


def test_every_query_without_sql_is_known():
    assert set(queries.QUERIES) - set(queries.SQL) <= {"feature_importances", "anonymized", "experiment_results"} | set(FLOORS)
