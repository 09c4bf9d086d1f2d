"""Classifiers on matrices (Spark ML), their scores, importances and explanations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

def vectors(matrix: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="vector", handleInvalid="keep").transform(matrix)


def _spark_ml(kind: str, p: Mapping):
    common = {"featuresCol": "vector", "labelCol": "outcome"}
    weights = {"weightCol": p["weight"]} if p.get("weight") else {}
    c = p.get("C", p.get("C_reg", 1.0))  # either name of the same parameter
    n = max(1, p.get("rows", 1))
    match kind:
        case "random_forest":
            return RandomForestClassifier(numTrees=p.get("n_estimators", 100), maxDepth=min(30, p.get("max_depth") or 10), featureSubsetStrategy=str(p.get("max_features", "sqrt")), impurity=p.get("criterion", "gini"), minInstancesPerNode=max(1, p.get("min_samples_split", 2) // 2), seed=p.get("seed", 42), **common, **weights)
        case "decision_tree":
            return DecisionTreeClassifier(maxDepth=min(30, p.get("max_depth") or 10), impurity=p.get("criterion", "gini"), minInstancesPerNode=max(1, p.get("min_samples_split", 2) // 2), seed=p.get("seed", 42), **common, **weights)
        case "gradient_boosting":
            return GBTClassifier(maxIter=p.get("n_estimators", 50), stepSize=p.get("learning_rate", 0.1), subsamplingRate=p.get("subsample", 1.0), maxDepth=p.get("max_depth", 3), seed=p.get("seed", 42), **common, **weights)
        case "logistic_regression":
            return LogisticRegression(regParam=1 / (c * n), elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0, **common, **weights)
        case "sgd":
            return LogisticRegression(regParam=p.get("alpha", 1e-4), elasticNetParam=p.get("l1_ratio", 0.15), **common, **weights)
        case "svm":
            return LinearSVC(regParam=1 / (c * n), **common, **weights)
        case "gaussian_nb":
            return NaiveBayes(modelType="gaussian", **common, **weights)
    raise ValueError(f"no such model: {kind}")


class Scored:
    """One Spark ML model; score() adds score (of the positive class) and pred.

    calibrate makes the model of probabilities from the training rows, when scores are first asked for or by whole().
    """

    def __init__(self, model: Model, calibrate: Callable[[], Model] | None = None):
        self.model, self.calibration, self._calibrate = model, None, calibrate

    def whole(self) -> Scored:
        """The model with all that it learns, which needs its training rows no more."""
        if self.calibration is None and self._calibrate is not None:
            self.calibration = self._calibrate()
        self._calibrate = None
        return self

    def score(self, rows: DataFrame) -> DataFrame:
        self.whole()
        out = self.model.transform(rows)
        if self.calibration is not None:
            out = self.calibration.transform(_margins(out).drop("probability", "prediction"))
        out = out.withColumn("score", vector_to_array("probability")[1]).withColumn("pred", F.col("prediction").cast("int"))
        return out.drop("rawPrediction", "probability", "prediction", "margin", "margins")


def _margins(scored: DataFrame) -> DataFrame:
    margin = scored.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "prediction")
    return VectorAssembler(inputCols=["margin"], outputCol="margins").transform(margin)


class Ensemble:
    """A weighted mean of models' scores (T2), or of their votes."""

    def __init__(self, members: Sequence[tuple[float, Scored]], votes: bool = False):
        self.members, self.votes = members, votes

    def whole(self) -> Ensemble:
        for _, member in self.members:
            member.whole()
        return self

    def score(self, rows: DataFrame) -> DataFrame:
        out, total = rows.withColumn("_sum", F.lit(0.0)), sum(w for w, _ in self.members) or 1.0
        for weight, member in self.members:
            out = member.score(out)
            out = out.withColumn("_sum", F.col("_sum") + weight * (F.col("pred") if self.votes else F.col("score"))).drop("score", "pred")
        return out.withColumn("score", F.col("_sum") / total).withColumn("pred", (F.col("score") > 0.5).cast("int")).drop("_sum")


def fit(kind: str, rows: DataFrame, parameters: Mapping | None = None):
    """A model of rows (vector, outcome).

    bagging: forests on samples with replacement; boosted_forest and adaboost: members on reweighted rows (SAMME);
    svm: a linear machine whose probabilities are a logistic curve over cross-fitted margins.
    """
    p = dict(parameters or {})
    if kind == "bagging":
        n, share = p.get("n_bags", 10), p.get("max_samples", 1.0)
        kept = rows.persist()  # forests read their rows several times
        try:
            return Ensemble([(1.0, fit("random_forest", kept.sample(True, share, seed=p.get("seed", 42) + k), p)) for k in range(n)])
        finally:
            kept.unpersist()
    if kind in ("adaboost", "boosted_forest"):
        return _samme(rows, "decision_tree" if kind == "adaboost" else "random_forest", p)
    if kind == "svm":
        return _machine(rows, p)
    if kind == "logistic_regression":
        p.setdefault("rows", rows.count())
    return Scored(_spark_ml(kind, p).fit(rows))


#: Rows of a task of the hundreds of short jobs that a linear machine takes, about.
TASK_ROWS = 100_000


def _packed(rows: DataFrame, n: int) -> DataFrame:
    return rows.coalesce(max(1, -(-n // TASK_ROWS)))


def _machine(rows: DataFrame, p: dict) -> Scored:
    """Rows are made once for all fits, which read them in tasks of some TASK_ROWS."""
    columns = ["vector", "outcome", *([p["weight"]] if p.get("weight") else [])]
    kept = rows.select(*columns).persist()
    try:
        n = kept.count()
        p.setdefault("rows", n)
        model = _spark_ml("svm", p).fit(_packed(kept, n))
    finally:
        kept.unpersist()
    return Scored(model, lambda: _calibration(model, rows.select(*columns), p))


#: Parts of the rows that an SVM's probabilities are learned from.
FOLDS = 3


def _calibration(model: Model, rows: DataFrame, p: Mapping) -> Model:
    """A logistic curve over margins that don't come from a machine that has seen their rows (T4).

    Rows lie in folds by the hash of their values; the margins of a fold are those of a machine of the other folds. A fold without which
    there are not both outcomes keeps the margins of the whole.
    """
    folded = rows.withColumn("_fold", F.pmod(F.xxhash64(vector_to_array("vector")), F.lit(FOLDS)).cast("int")).persist()
    try:
        there = {(r["_fold"], r["outcome"]): r["count"] for r in folded.groupBy("_fold", "outcome").count().collect()}  # 2 x FOLDS rows at most
        size = lambda folds: sum(n for (f, _), n in there.items() if f in folds)

        def margins(fold: int) -> DataFrame:
            rest = set(range(FOLDS)) - {fold}
            both = len({y for f, y in there if f != fold}) > 1
            own = _spark_ml("svm", p).fit(_packed(folded.filter(F.col("_fold") != fold), size(rest))) if both else model
            return _margins(own.transform(_packed(folded.filter(F.col("_fold") == fold), size({fold})))).select("margins", "outcome")

        with ThreadPoolExecutor(max_workers=FOLDS) as pool:
            parts = list(pool.map(margins, range(FOLDS)))
        return LogisticRegression(featuresCol="margins", labelCol="outcome").fit(reduce(lambda a, b: a.unionByName(b), parts))
    finally:
        folded.unpersist()


def _samme(rows: DataFrame, kind: str, p: Mapping) -> Ensemble:
    """Each member sees rows weighted by how the members before it erred; the weights stay a column expression of the scores."""
    from math import log

    rate, members = p.get("learning_rate", 1.0), []
    rows = rows.withColumn("_w", F.lit(1.0)).persist()
    own = {"max_depth": 1} if kind == "decision_tree" else {"n_estimators": p.get("trees", 10)}
    for k in range(p.get("n_estimators", 10)):
        member = fit(kind, rows, {**own, **{x: p[x] for x in ("max_depth",) if x in p}, "weight": "_w", "seed": p.get("seed", 42) + k})
        scored = member.score(rows)
        wrong, total = scored.agg(F.sum(F.when(F.col("pred") != F.col("outcome"), F.col("_w")).otherwise(0.0)), F.sum("_w")).first()
        error = wrong / total if total else 0.0
        if error >= 0.5 and members:
            break
        alpha = rate * log((1 - min(max(error, 1e-10), 1 - 1e-10)) / max(error, 1e-10))
        members.append((max(alpha, 1e-10), member))
        if error <= 0:
            break
        heavier = F.col("_w") * F.when(F.col("pred") != F.col("outcome"), F.lit(float(2.718281828459045**alpha))).otherwise(1.0) * F.lit(1.0 / total)
        fresh = scored.withColumn("_w", heavier).drop("score", "pred").persist()
        fresh.count()
        rows.unpersist()
        rows = fresh
    rows.unpersist()
    return Ensemble(members, votes=True)


#: Training rows that stand for a cell of those nearest to them, at least and at most, and rows of a cell or of its questions that one task
#: compares, about.
PIVOTS, MOST_PIVOTS, PART = 256, 4_096, 4_096
#: Rows whose distances from all pivots are held at a time.
PIECE = 256


def pivots_of(n: int) -> int:
    """Pivots of n training rows: a row is compared with each of them and with the n / pivots rows of some cells, so they grow with the root."""
    return min(MOST_PIVOTS, max(PIVOTS, 2 * isqrt(n)))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squares of the distances of all rows of x from all rows of y, summed feature by feature."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        out += (x[:, j, None] - y[None, :, j]) ** 2
    return out


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(float) if len(values) else np.zeros((0, width))


def _assigned(pivots: np.ndarray):
    """Adds cell (of the nearest pivot) and away (the distance from it)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            cell, away = np.zeros(len(rows), "int32"), np.zeros(len(rows))
            for start in range(0, len(rows), PIECE):
                d = _distances(_matrix(rows["y"].iloc[start : start + PIECE], pivots.shape[1]), pivots)
                cell[start : start + PIECE], away[start : start + PIECE] = d.argmin(axis=1), np.sqrt(d.min(axis=1))
            yield rows.assign(cell=cell, away=away)

    return run


def _cells_to_ask(pivots: np.ndarray, counts: np.ndarray, radius: np.ndarray, k: int, first: bool):
    """Adds cells: at first the nearest ones that hold k rows together; then all others that can hold a row no farther than bound."""

    def chosen(rows: pd.DataFrame) -> list[list[int]]:
        d = np.sqrt(_distances(_matrix(rows["x"], pivots.shape[1]), pivots))
        d[:, counts == 0] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        enough = np.cumsum(counts[order], axis=1)
        n = np.minimum((enough < k).sum(axis=1) + 1, (counts > 0).sum())
        if first:
            return [row[:m].tolist() for row, m in zip(order, n, strict=True)]
        reach = np.sqrt(rows["bound"].to_numpy(float)) * (1 + 1e-9) + 1e-300
        near = (counts > 0) & (d - radius * (1 + 1e-9) <= reach[:, None] + 1e-9 * np.where(np.isfinite(d), d, 0.0))
        return [row[m:][hit[row[m:]]].tolist() for row, m, hit in zip(order, n, near, strict=True)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            cells = [c for start in range(0, len(rows), PIECE) for c in chosen(rows.iloc[start : start + PIECE])]
            yield pd.DataFrame({"row": rows["row"], "x": rows["x"], "cells": cells}, index=rows.index)

    return run


def _nearest(k: int):
    def run(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """The k nearest known rows of each question, ties by key."""
        rows, found, others, outcomes = [], [], [], []
        if len(asked) and len(known):
            known = known.sort_values("other", kind="stable")
            width = len(known["y"].iloc[0])
            y, other, outcome = _matrix(known["y"], width), known["other"].to_numpy(), known["outcome"].to_numpy()
            for start in range(0, len(asked), 256):
                some = asked.iloc[start : start + 256]
                d = _distances(_matrix(some["x"], width), y)
                best = np.argsort(d, axis=1, kind="stable")[:, :k]
                rows.append(np.repeat(some["row"].to_numpy(), best.shape[1]))
                found.append(np.take_along_axis(d, best, axis=1).ravel())
                others.append(other[best].ravel())
                outcomes.append(outcome[best].ravel())
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pd.DataFrame({"row": join(rows, "int64"), "d": join(found, float), "other": join(others, "int64"), "outcome": join(outcomes, "int64")})

    return run


def nearest_neighbours(train: DataFrame, test: DataFrame, key: str, features: Sequence[str], k: int = 5, weights: str = "uniform") -> DataFrame:
    """key, score: the share of positives among the k nearest training rows, by Euclidean distance, ties by key, a whole number.

    Exact, for any number of training rows. These lie in cells around some of them (pivots_of). A row first asks the nearest cells that
    hold k rows; its k-th distance there bounds what it looks for, so that of the other cells only those within that bound are
    asked. Cells and their questions are dealt into parts of bounded size, which give k rows for each question. distance weighs a
    neighbour by the inverse of its distance. Rows with a null or NaN feature have no distances: they are no neighbours and get no score.
    """
    from ..sources.io import stored

    values = F.array(*[F.col(f).cast("double") for f in features])
    whole = lambda c: F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v))

    known = train.select(F.col(key).cast("long").alias("other"), values.alias("y"), F.col("outcome").cast("long").alias("outcome")).filter(whole("y"))
    pivots = _matrix(pd.Series([r["y"] for r in known.orderBy(F.xxhash64("other"), "other").limit(pivots_of(known.count())).select("y").collect()], dtype=object), len(features))
    out = test.select(F.col(key).alias("_key"), values.alias("x")).filter(whole("x"))
    if not len(pivots):
        return out.filter(F.lit(False)).select(F.col("_key").alias(key), F.lit(0.0).alias("score"))
    cells = stored(known.mapInPandas(_assigned(pivots), "other long, y array<double>, outcome long, cell int, away double"), "cells")
    counts, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect():  # a row for each pivot
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    parts = F.array(*[F.lit(int(max(1, -(-n // PART)))) for n in counts])
    cells = cells.withColumn("part", F.pmod(F.xxhash64("other"), F.get(parts, F.col("cell"))).cast("int"))
    asked = stored(out.withColumn("row", F.monotonically_increasing_id()), "asked")

    def found(questions: DataFrame) -> DataFrame:
        """The k best of each cell's part for the questions: row, x, cells."""
        each = questions.select("row", "x", F.explode("cells").alias("cell"))
        sizes = {r["cell"]: r["count"] for r in each.groupBy("cell").count().collect()}
        blocks = F.array(*[F.lit(max(1, -(-sizes.get(c, 0) // PART))) for c in range(len(pivots))])
        each = each.withColumn("block", F.pmod(F.xxhash64("row"), F.get(blocks, F.col("cell"))).cast("int"))
        each = each.withColumn("part", F.explode(F.sequence(F.lit(0), F.get(parts, F.col("cell")) - 1)))
        there = cells.withColumn("block", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("cell")) - 1)))
        by = ["cell", "part", "block"]
        return each.groupBy(*by).cogroup(there.groupBy(*by)).applyInPandas(_nearest(k), "row long, d double, other long, outcome long")

    order = Window.partitionBy("row").orderBy("d", "other")
    best = lambda rows: rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")
    ask = lambda rows, first: rows.mapInPandas(_cells_to_ask(pivots, counts, radius, k, first), "row long, x array<double>, cells array<int>")
    nearby = stored(best(found(ask(asked.select("row", "x"), True))), "nearby")
    bounds = nearby.groupBy("row").agg(F.when(F.count(F.lit(1)) == k, F.max("d")).otherwise(float("inf")).alias("bound"))
    others = ask(asked.join(bounds, "row").select("row", "x", "bound"), False)
    top = best(nearby.unionByName(found(stored(others, "farther")))).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("d", "other", "outcome"))).alias("top"))
    weight = (lambda x: F.lit(1.0)) if weights == "uniform" else (lambda x: 1.0 / (F.sqrt(x["d"]) + F.lit(1e-12)))
    votes = F.aggregate("top", F.lit(0.0), lambda a, x: a + weight(x) * x["outcome"])
    return asked.join(top, "row").select(F.col("_key").alias(key), (votes / F.aggregate("top", F.lit(0.0), lambda a, x: a + weight(x))).alias("score"))


def grid(kinds: Mapping[str, Mapping[str, Sequence]]) -> Iterator[tuple[str, dict]]:
    """Each kind with each combination of its parameters."""
    for kind, options in kinds.items():
        for values in product(*options.values()):
            yield kind, dict(zip(options, values, strict=True))


def fit_grid(matrix: DataFrame, subsets: Sequence[Sequence[str]], kinds: Mapping[str, Mapping[str, Sequence]], threads: int = 4) -> Iterator[tuple[Sequence[str], str, dict, object]]:
    """A model for each subset of features and each point of the grid, from one cached matrix, fitted by some threads at a time.

    Models are whole, a machine's probabilities included: they don't need the matrix when it has gone.
    """
    cached = matrix.persist()
    try:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            made = lambda task: (*task, fit(task[1], vectors(cached, task[0]), task[2]).whole())
            yield from pool.map(made, [(features, kind, parameters) for features in subsets for kind, parameters in grid(kinds)])
    finally:
        cached.unpersist()


def importances(model, n: int) -> list[float] | None:
    """Importances of trees, else coefficients; of boosted members the weighted mean of theirs; None where there are none."""
    if isinstance(model, Ensemble):
        own = [(w, importances(m, n)) for w, m in model.members] if model.votes else []
        total = sum(w for w, _ in own)
        return [sum(w * x[k] for w, x in own) / total for k in range(n)] if own and all(x is not None for _, x in own) else None
    m = getattr(model, "model", None)
    if hasattr(m, "featureImportances"):
        return m.featureImportances.toArray().tolist()
    return m.coefficients.toArray().tolist() if isinstance(m, (LogisticRegressionModel, LinearSVCModel)) else None


def feature_importances(model, features: Sequence[str], spark) -> DataFrame:
    """feature, importance, rank: by importances() and their absolute value; no rows for a model without any."""
    values = importances(model, len(features)) or []
    rows = spark.createDataFrame([(f, float(v)) for f, v in zip(features, values, strict=False)], "feature string, importance double")
    return rows.withColumn("rank", F.rank().over(Window.orderBy(F.desc(F.abs("importance")))))  # a row for each feature


def linear_contributions(train: DataFrame, rows: DataFrame, key: str, coefficients: Mapping[str, float]) -> DataFrame:
    """key and contributions: standard deviation in training x coefficient x value, by feature."""
    spread = train.agg(*[F.stddev_samp(c).alias(f"_{c}") for c in coefficients])
    each = F.create_map(*[x for c, w in coefficients.items() for x in (F.lit(c), F.col(f"_{c}") * F.lit(float(w)) * F.col(c))])
    return rows.crossJoin(F.broadcast(spread)).select(key, each.alias("contributions"))


def signed_top(contributions: DataFrame, key: str, n: int = 5) -> DataFrame:
    """key and risk_1 to risk_n: names of the largest contributions by absolute value, -name if negative, null if zero (T16); ties by name."""
    entries = F.transform(F.map_entries("contributions"), lambda e: F.struct((-F.abs(e["value"])).alias("order"), e["key"].alias("name"), e["value"].alias("value")))
    best = F.slice(F.array_sort(entries), 1, n)
    named = F.transform(best, lambda e: F.when(e["value"] > 0, e["name"]).when(e["value"] < 0, F.concat(F.lit("-"), e["name"])))
    return contributions.select(key, named.alias("_risks")).select(key, *[F.get("_risks", k).alias(f"risk_{k + 1}") for k in range(n)])


#: Ranges of a feature's values in which they are ranked separately.
RANGES = 64


def _ranks(long: DataFrame) -> DataFrame:
    """feature, value, count, upto (rows up to the value), n (of the feature), rank (average over ties) of each distinct value.

    Values lie in ranges by quantiles, which are made once (evaluate._ranged); counts run within each, and the totals of the ranges before are added.
    """
    from ..sources.io import stored

    counts = long.groupBy("feature", "value").count()
    bounds = stored(long.groupBy("feature").agg(F.percentile_approx("value", [k / RANGES for k in range(1, RANGES)], 10_000).alias("_bounds")), "bounds")
    ranged = counts.join(F.broadcast(bounds), "feature").withColumn("_range", F.size(F.filter("_bounds", lambda b: b <= F.col("value")))).drop("_bounds")
    inside = Window.partitionBy("feature", "_range").orderBy("value")
    totals = ranged.groupBy("feature", "_range").agg(F.sum("count").alias("_all"))  # RANGES rows for each feature
    before = Window.partitionBy("feature").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("feature", "_range", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"), F.sum("_all").over(Window.partitionBy("feature")).alias("n"))
    run = ranged.withColumn("upto", F.sum("count").over(inside)).join(F.broadcast(totals), ["feature", "_range"]).withColumn("upto", F.col("upto") + F.col("_before"))
    return run.select("feature", "value", "count", "upto", "n", (F.col("upto") - (F.col("count") - 1) / 2.0).alias("rank"))


def rank_distance(matrix: DataFrame, key: str, importances: Mapping[str, float], n_features: int = 200, n: int = 5) -> DataFrame:
    """key and risk_1 to risk_n: the features in which a row's rank is farthest from that of the row nearest the median.

    Of the n_features most important features (over 0, no dummies). Ranks are averages over ties; ties among features
    go by importance, among rows nearest the median by key.
    """
    order = sorted((f for f, v in importances.items() if v > 0 and "dummy" not in f), key=lambda f: (-importances[f], f))[:n_features]
    place = {f: k for k, f in enumerate(order)}
    long = matrix.unpivot([key], order, "feature", "value").withColumn("value", F.col("value").cast("double"))
    ranks = _ranks(long)
    # the median lies at one or two places of the sorted values, which the ranks' counts tell
    at = ranks.withColumn("_low", F.floor((F.col("n") + 1) / 2)).withColumn("_high", F.ceil((F.col("n") + 1) / 2))
    holds = lambda place: F.max(F.when((F.col("upto") - F.col("count") < F.col(place)) & (F.col(place) <= F.col("upto")), F.col("value")))
    median = at.groupBy("feature").agg(((holds("_low") + holds("_high")) / 2).alias("median"))
    near = long.join(F.broadcast(median), "feature").groupBy("feature").agg(F.min(F.struct(F.abs(F.col("value") - F.col("median")).alias("d"), F.col(key).alias("k"), "value")).alias("m"))
    ranks = ranks.select("feature", "value", "rank")
    middle = near.select("feature", F.col("m.value").alias("value")).join(ranks, ["feature", "value"]).select("feature", F.col("rank").alias("middle"))
    names = F.create_map(*[x for f, k in place.items() for x in (F.lit(f), F.lit(k))])
    distances = long.join(ranks, ["feature", "value"]).join(F.broadcast(middle), "feature")
    each = distances.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.abs(F.col("rank") - F.col("middle"))).alias("d"), F.element_at(names, F.col("feature")).alias("place"), "feature"))).alias("_all"))
    return each.select(key, *[F.get("_all", k)["feature"].alias(f"risk_{k + 1}") for k in range(n)])


def prediction_ranks(predictions: DataFrame, by: Sequence[str] = ("model_id", "as_of_date"), run: DataFrame | None = None) -> DataFrame:
    """rank_abs: dense rank by descending score; rank_pct: that over the number of rows.

    Distinct scores are ranked in ranges, whose numbers are added (evaluate.running_counts), and rows joined to their score's rank.
    run: those counts, if they are at hand.
    """
    from .evaluate import running_counts

    run = running_counts(predictions.select(*by, "score", F.lit(0).alias("label")), by) if run is None else run
    ranks = run.select(*by, "score", F.col("place").cast("int").alias("rank_abs"), (F.col("place") / F.col("total")).alias("rank_pct"))
    return predictions.join(ranks, [*by, "score"])


def score_date(model, matrix: DataFrame, features: Sequence[str], key: str, model_id: int, date: str, history: DataFrame, hub: DataFrame) -> DataFrame:
    """Scores of one date with a chosen model, ranked and compared with earlier dates."""
    from .results import rank_movement

    scored = model.score(vectors(matrix, features)).select(F.lit(model_id).alias("model_id"), F.lit(date).cast("timestamp_ntz").alias("as_of_date"), F.col(key).alias("entity_id"), "score")
    ranked = prediction_ranks(scored)
    everything = history.select(*ranked.columns).unionByName(ranked)
    return rank_movement(everything, hub).filter(F.col("as_of_date") == F.lit(date).cast("timestamp_ntz"))


class LinearScore:
    """A fixed rule in the place of a fitted model: the logistic curve of an intercept and weighted features."""

    def __init__(self, weights: Mapping[str, float], intercept: float = 0.0):
        self.weights, self.intercept = weights, intercept

    def score(self, rows: DataFrame) -> DataFrame:
        z = F.lit(float(self.intercept))
        for c, w in self.weights.items():
            z = z + F.col(c) * float(w)
        return rows.withColumn("score", 1 / (1 + F.exp(-z))).withColumn("pred", (F.col("score") > 0.5).cast("int"))


def _claimed(spark: SparkSession, root: str, wanted: Sequence[str]) -> dict[str, int]:
    """model_id of each identity: those that an earlier run gave out, and the next free ones in order."""
    from ..sources import io

    path, schema = f"{root}/claims", "identity string, model_id int"
    known = {r["identity"]: r["model_id"] for r in spark.read.schema(schema).parquet(path).collect()} if io.exists(spark, path) else {}  # a row for each model
    fresh = [x for x in dict.fromkeys(wanted) if x not in known]
    first = max(known.values(), default=0) + 1
    given = {x: first + k for k, x in enumerate(fresh)}
    if given:
        io.append(spark.createDataFrame(list(given.items()), schema).coalesce(1), path, ())
    return known | given


def run_experiments(matrices: Mapping[str, tuple[DataFrame, DataFrame, str]], key: str, subsets: Sequence[Sequence[str]], kinds: Mapping[str, Mapping[str, Sequence]], root: str, config: Mapping, threads: int = 4) -> int:
    """Fits the grid on every (train, test, as_of_date) and feature subset, and stores what comes of it; the number of models fitted.

    Below root: models (registry rows, S14), predictions (S8), evaluations (S9), feature_importances (S11) and claims (the ids
    given out). A model is known by the hash of what it is made from: configuration, window, date, features, kind and parameters. Its rows
    replace those of the same id, and its registry row is written last; a model that has one is not fitted again. So a second
    run adds nothing, and an interrupted one goes on. Models of a window are fitted by some threads at a time.
    One run at a time may write below a root.
    """
    from ..sources import io
    from . import evaluate

    spark = next(iter(matrices.values()))[0].sparkSession if matrices else None
    tasks = [(window, list(features), kind, parameters) for window in matrices for features in subsets for kind, parameters in grid(kinds)]
    identity = lambda window, features, kind, parameters: io.matrix_key({"config": config, "window": window, "date": matrices[window][2], "features": features, "kind": kind, "parameters": parameters})
    ids = _claimed(spark, root, [identity(*t) for t in tasks]) if tasks else {}
    done = {r["model_id"] for r in spark.read.schema(io.RESULT_SCHEMAS["models"]).parquet(f"{root}/models").select("model_id").collect()} if tasks and io.there(spark, f"{root}/models") else set()

    def one(window: str, features: list[str], kind: str, parameters: dict, cached: DataFrame) -> None:
        number, (_, test, date) = ids[identity(window, features, kind, parameters)], matrices[window]
        model = fit(kind, vectors(cached, features), parameters)
        scored = model.score(vectors(test, features)).select(F.lit(number).alias("model_id"), F.lit(date).cast("timestamp_ntz").alias("as_of_date"), F.col(key).alias("entity_id"), "score", "pred", F.col("outcome").alias("label_value")).persist()
        try:
            by = ["model_id", "as_of_date"]
            judged = scored.select(*by, F.col("entity_id").alias("id"), "score", "pred", F.col("label_value").alias("label"))
            run = io.stored(evaluate.running_counts(judged, by), "running")  # ranks, curves and cut-offs are taken from it
            io.replace(prediction_ranks(scored, by, run).select(*by, "entity_id", "score", "label_value", "rank_abs", "rank_pct"), f"{root}/predictions")
            io.replace(evaluate.all_metrics(judged, by, run).withColumn("comment", F.lit("")), f"{root}/evaluations")
        finally:
            scored.unpersist()
        io.replace(feature_importances(model, features, spark).select(F.lit(number).alias("model_id"), "feature", F.col("importance").alias("feature_importance")), f"{root}/feature_importances", ("model_id",))
        io.replace(io.registry_row(spark, number, kind, parameters, features, window, config), f"{root}/models", ("model_id",))

    todo = {window: [t for t in tasks if t[0] == window and ids[identity(*t)] not in done] for window in matrices}
    todo = {window: of for window, of in todo.items() if of}
    fitted, kept = 0, {}
    try:
        for window, of in todo.items():
            # both matrices are made once for all models; one that the window before has too stays
            needed = {id(t): t for t in matrices[window][:2]}
            for k in set(kept) - set(needed):
                kept.pop(k).unpersist()
            kept |= {k: t.persist() for k, t in needed.items() if k not in kept}
            with ThreadPoolExecutor(max_workers=threads) as pool:
                for future in [pool.submit(one, *t, matrices[window][0]) for t in of]:
                    future.result()
                    fitted += 1
    finally:
        for t in kept.values():
            t.unpersist()
    return fitted
