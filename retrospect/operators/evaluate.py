"""Evaluation of scores: threshold metrics, ranked cut-offs and curves.

Input: columns id, score (double), pred (0/1), label (0/1), and those of `by` that keep sets of scores apart, as of models and
dates. Output: by, metric, parameter, value. Scores are first reduced to counts by distinct score, and running counts are
taken in ranges of scores, so no task holds all rows of a set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import stored

# The cut-offs that scores are judged at.
PERCENTS = (0.01, 0.10, 0.25, 0.50, 1.0, 5.0, 10.0, 25.0, 50.0, 75.0, 100.0)
COUNTS = (10, 50, 100, 200, 500, 1000)
BETAS = (0.75, 1.25)
#: Ranges of scores in which counts run separately.
RANGES = 64
#: Ranges of ids in which the rows of one score are put in order.
TIE_RANGES = 512


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _rows(table: DataFrame, metrics: dict[tuple[str, str], Column], by: Sequence[str]) -> DataFrame:
    each = [F.struct(F.lit(m).alias("metric"), F.lit(p).alias("parameter"), v.cast("double").alias("value")) for (m, p), v in metrics.items()]
    return table.select(*by, F.inline(F.array(*each)))


def confusion(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by and n, tp, fp, fn, tn of the binary predictions: one row without by."""
    test = lambda p, y: F.count_if((F.col("pred") == p) & (F.col("label") == y))
    return scores.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), test(1, 1).alias("tp"), test(1, 0).alias("fp"), test(0, 1).alias("fn"), test(0, 0).alias("tn"))


def global_metrics(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy (E1), F1 (E4), F-beta (E5), precision and recall (E6); 0 where the denominator is 0."""
    c = F.col
    precision, recall = _ratio(c("tp"), c("tp") + c("fp")), _ratio(c("tp"), c("tp") + c("fn"))
    fbeta = lambda b: _ratio((1 + b * b) * c("tp"), (1 + b * b) * c("tp") + b * b * c("fn") + c("fp"))
    metrics = {("accuracy", ""): _ratio(c("tp") + c("tn"), c("n")), ("f1", ""): fbeta(1.0)}
    metrics |= {("fbeta@", f"{b} beta"): fbeta(b) for b in BETAS}
    metrics |= {("precision@", "default"): precision, ("recall@", "default"): recall}
    return _rows(confusion(scores, by), metrics, by)


def _ranged(rows: DataFrame, scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """rows with _range: how many of its set's quantiles (RANGES at most) a score reaches. Sets are small next to their rows.

    Bounds are approximate and change with the order in which parts of them arrive, so they are made once for all plans that use the ranges.
    """
    bounds = stored(scores.groupBy(*by).agg(F.percentile_approx("score", [k / RANGES for k in range(1, RANGES)], 10_000).alias("_bounds")), "bounds")
    joined = rows.join(bounds, list(by)) if by else rows.crossJoin(F.broadcast(bounds))
    return joined.withColumn("_range", F.size(F.filter(F.coalesce("_bounds", F.array().cast("array<double>")), lambda b: b <= F.col("score")))).drop("_bounds")


def running_counts(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """By distinct score, descending: rows, pos, neg at it, and upto (rows), tp, fp so far, ties included; total, positives and negatives in all;
    place: the number of the distinct score.

    Distinct scores lie in ranges by quantiles; counts run within each, and the totals of its ranges are added.
    """
    by_score = scores.groupBy(*by, "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"), F.count(F.lit(1)).alias("rows"), F.lit(1).alias("one"))
    ranged = _ranged(by_score, scores, by)
    inside = Window.partitionBy(*by, "_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy(*by).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)  # RANGES rows of each set
    names = {"pos": ("tp", "positives"), "neg": ("fp", "negatives"), "rows": ("upto", "total"), "one": ("place", "places")}
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_{c}") for c in names])
    before = totals.select(*by, "_range", *[F.coalesce(F.sum(f"_{c}").over(above), F.lit(0)).alias(f"_b{c}") for c in names], *[F.sum(f"_{c}").over(Window.partitionBy(*by)).alias(n) for c, (_, n) in names.items()])
    run = ranged.withColumns({n: F.sum(c).over(inside) for c, (n, _) in names.items()}).join(before, [*by, "_range"])
    return run.select(*by, "score", "pos", "neg", "rows", *[(F.col(n) + F.col(f"_b{c}")).alias(n) for c, (n, _) in names.items()], *[n for _, n in names.values()])


def _auc() -> dict[tuple[str, str], Column]:
    c = F.col
    # a positive beats the negatives below it, and half of those at its score
    won, p, n = F.sum(c("pos") * (c("negatives") - c("fp") + c("neg") / F.lit(2.0))), F.first("positives"), F.first("negatives")
    return {("auc", "roc"): F.try_divide(won, p * n), ("average precision score", ""): F.try_divide(F.sum(c("pos") * c("tp") / (c("tp") + c("fp"))), p)}


def _rates() -> dict[tuple[str, str], Column]:
    points = F.count(F.lit(1)) + 1
    return {
        ("mean false positive rate", ""): F.try_divide(F.sum("fp").cast("double"), F.first("negatives") * points),
        ("mean true positive rate", ""): F.try_divide(F.sum("tp").cast("double"), F.first("positives") * points),
    }


def _of_run(run: DataFrame, metrics: dict[tuple[str, str], Column], by: Sequence[str]) -> DataFrame:
    sums = run.groupBy(*by).agg(*[v.alias(f"_m{k}") for k, v in enumerate(metrics.values())])
    return _rows(sums, {name: F.col(f"_m{k}") for k, name in enumerate(metrics)}, by)


def curve_metrics(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC (E2): the share of pairs in order, ties half; and step-wise average precision."""
    return _of_run(running_counts(scores, by), _auc(), by)


def mean_rates(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The means of false and true positive rates over the points of the ROC curve, the origin included.

    A point stands for each distinct score; none is dropped for lying on a line.
    """
    return _of_run(running_counts(scores, by), _rates(), by)


def numbered_in_ranges(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """rows with number: 1 for the least `order` (a number) of each key.

    Rows are numbered in ranges of `order` by quantiles, whose sizes are added; so a key with all rows is hundreds of tasks' work.
    """
    bounds = stored(rows.groupBy(*keys).agg(F.percentile_approx(order, [k / TIE_RANGES for k in range(1, TIE_RANGES)], 10_000).alias("_bounds")), "bounds")  # once, as in _ranged
    ranged = _same(rows, bounds, keys).withColumn("_range", F.size(F.filter("_bounds", lambda b: b < F.col(order)))).drop("_bounds")
    parts = [*keys, "_range"]
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # TIE_RANGES rows of each key
    sizes = ranged.groupBy(*parts).agg(F.count(F.lit(1)).alias("_size")).select(*parts, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    out = _same(ranged.withColumn("number", F.row_number().over(Window.partitionBy(*parts).orderBy(order))), sizes, parts)
    return out.withColumn("number", F.col("number") + F.col("_before")).drop("_range", "_before")


def _same(rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on keys in which nulls are equal; the keys of rows stay."""
    if not keys:
        return rows.crossJoin(F.broadcast(others)) if how == "inner" else rows.join(F.broadcast(others), F.lit(True), how)  # one row
    right = others.withColumnsRenamed({k: f"_k{n}" for n, k in enumerate(keys)})
    test = F.lit(True)
    for n, k in enumerate(keys):
        test = test & rows[k].eqNullSafe(right[f"_k{n}"])
    return rows.join(right, test, how).drop(*[f"_k{n}" for n in range(len(keys))])


def _cut_table(run: DataFrame, cuts: Sequence[Column], by: Sequence[str]) -> DataFrame:
    """A row for each set: by, n, positives, and for each cut a struct c0, c1, ...: the score at which its last row lies, how many rows of
    that score it takes (null: all), and the positives it has with them all, or else above them. A cut without rows has null.

    cuts are functions of total."""
    lower, tp, pos = F.col("upto") - F.col("rows"), F.coalesce(F.col("tp"), F.lit(0)), F.coalesce(F.col("pos"), F.lit(0))
    columns = []
    for i, cut in enumerate(cuts):
        k = F.least(cut, F.col("total"))
        point = F.struct(F.when(k == F.col("upto"), tp).otherwise(tp - pos).alias("above"), F.when(k < F.col("upto"), k - lower).alias("rest"), F.col("score").alias("score"))
        columns.append(F.max(F.when((k > lower) & (k <= F.col("upto")), point)).alias(f"c{i}"))
    none = F.lit(0).cast("long")
    return run.groupBy(*by).agg(F.coalesce(F.sum("rows"), none).alias("n"), F.coalesce(F.sum("pos"), none).alias("positives"), *columns)


def binary_at(scores: DataFrame, k: float, by: Sequence[str] = (), percent: bool = False) -> DataFrame:
    """pred: 1 for the k largest scores of each set, or the largest k percent, rounded down; ties by id, a number.

    The score of the last row taken comes from counts by score; of the rows of that score alone the order of ids matters.
    """
    cut = (F.col("total") * F.lit(k / 100.0)).cast("long") if percent else F.lit(k).cast("long")
    rows = _same(scores.drop("pred"), _cut_table(running_counts(scores, by), [cut], by).select(*by, F.col("c0").alias("_c")), list(by), "left")
    same = F.col("_c").isNotNull() & F.col("score").eqNullSafe(F.col("_c.score"))
    higher = F.col("_c").isNotNull() & F.col("score").isNotNull() & (F.col("_c.score").isNull() | (F.col("score") > F.col("_c.score")))
    divided = same & F.col("_c.rest").isNotNull()
    ties = numbered_in_ranges(rows.filter(divided), [*by, "score"], "id").withColumn("pred", (F.col("number") <= F.col("_c.rest")).cast("int"))
    rest = rows.filter(~divided).withColumn("pred", (higher | same).cast("int"))
    return rest.drop("_c").unionByName(ties.drop("_c", "number"))


def cut_metrics(scores: DataFrame, percents: Sequence[float] = PERCENTS, counts: Sequence[int] = COUNTS, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and the four counts at each cut-off (E8, E9), for all sets.

    Counts by score give the score that each cut-off divides; only the rows of these few scores are put in order, by id.
    """
    return _cut_metrics(running_counts(scores, by), scores, percents, counts, by)


def _cut_metrics(run: DataFrame, scores: DataFrame, percents: Sequence[float], counts: Sequence[int], by: Sequence[str]) -> DataFrame:
    cuts = {f"{p}_pct": lambda n, p=p: (n * F.lit(p / 100.0)).cast("long") for p in percents} | {f"{k}_abs": lambda n, k=k: F.lit(k).cast("long") for k in counts}
    table = stored(_cut_table(run, [k(F.col("total")) for k in cuts.values()], by), "cuts")
    asked = table.select(*by, F.posexplode(F.array(*[F.col(f"c{i}") for i in range(len(cuts))])).alias("cut", "c")).filter("c.rest is not null").select(*by, F.col("c.score").alias("score"), "cut", F.col("c.rest").alias("rest"))
    columns = scores.select(*by, "id", "score", "label")
    # only these rows are ever put in order
    tied = columns.filter(F.lit(False)) if asked.isEmpty() else stored(_same(columns, asked.select(*by, "score").distinct(), [*by, "score"], "left_semi"), "ties")
    among = _same(numbered_in_ranges(tied, [*by, "score"], "id"), asked, [*by, "score"]).filter(F.col("number") <= F.col("rest"))
    more = among.groupBy(*by).agg(*[F.sum(F.when(F.col("cut") == i, F.col("label"))).alias(f"t{i}") for i in range(len(cuts))])
    none = F.lit(0).cast("long")
    sums = _same(table, more, list(by), "left").select(*by, F.col("n").alias("_n"), F.col("positives").alias("_positives"), *[(F.coalesce(F.col(f"c{i}.above"), none) + F.coalesce(F.col(f"t{i}").cast("long"), none)).alias(f"tp{i}") for i in range(len(cuts))])
    n, positives, metrics = F.col("_n"), F.col("_positives"), {}
    for i, (name, k) in enumerate(cuts.items()):
        tp, taken = F.col(f"tp{i}"), F.least(k(n), n)
        metrics |= {
            ("precision@", name): _ratio(tp, taken),
            ("recall@", name): _ratio(tp, positives),
            ("true positives@", name): tp,
            ("true negatives@", name): n - taken - (positives - tp),
            ("false positives@", name): taken - tp,
            ("false negatives@", name): positives - tp,
        }
    return _rows(sums, metrics, by)


def all_metrics(scores: DataFrame, by: Sequence[str] = ("model_id", "as_of_date"), run: DataFrame | None = None) -> DataFrame:
    """by, metric, parameter, value: every metric of every set of scores (E1-E11), from one plan; its running counts (run, if they are at
    hand) serve curves and cut-offs."""
    run = running_counts(scores, by) if run is None else run
    return global_metrics(scores, by).unionByName(_of_run(run, _auc() | _rates(), by)).unionByName(_cut_metrics(run, scores, PERCENTS, COUNTS, by))


def evaluation_rows(metrics: DataFrame) -> DataFrame:
    """metric, parameter, comment and the value to 10 digits, split at the bars of metric|parameter|comment."""
    parts = F.split("name", r"\|")
    part = lambda k: F.coalesce(F.get(parts, k), F.lit(""))
    return metrics.select(part(0).alias("metric"), part(1).alias("parameter"), part(2).alias("comment"), F.round("value", 10).alias("value"))
