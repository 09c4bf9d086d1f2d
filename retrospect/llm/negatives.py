"""Hard negatives of anchors by integer inner products, found with the threshold algorithm over sorted components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Components are multiplied by this and rounded down.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
#: Candidates and anchors that one task compares, about: rows are dealt to so many groups that each has this size.
CANDIDATES, ANCHORS = 4096, 2048
#: Ranks of the sorted lists that a step reads: as many as were read before, this many at first.
STEP = 8
_TOP = np.iinfo(np.int64).max


class Lists:
    """The vectors of some candidates, and for each component their order by it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, labels: np.ndarray | None = None):
        self.ids, self.vectors, self.labels = ids, vectors, labels
        self.ascending = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.lowest = np.take_along_axis(vectors, self.ascending.T, axis=0).T.copy()

    def __len__(self) -> int:
        return len(self.ids)


def threshold_search(anchor: np.ndarray, lists: Lists, wanted, allowed: np.ndarray | None = None) -> int:
    """Reads the lists of an anchor's components in step, from the top where the component is positive, from the bottom where it
    is negative, and hands the rows met for the first time, with their scores, to wanted.add(rows, scores).

    The threshold is the score that the components at the present rank would have together: no unread row exceeds it. It
    stops once the threshold is below wanted.least(), and returns how many rows it scored. Only `allowed` rows are scored.
    """
    n, used = len(lists), np.flatnonzero(anchor)
    fresh = np.ones(n, bool) if allowed is None else allowed.copy()
    weights, up = anchor[used], anchor[used] > 0
    depth, scored = 0, 0
    while depth < n:
        until = min(n, max(STEP, 2 * depth))
        if len(used):
            last = np.where(up, n - until, until - 1)
            threshold = (lists.lowest[used, last] * weights).sum()
            low, high = used[~up], used[up]
            met = np.concatenate([lists.ascending[low, depth:until].ravel(), lists.ascending[high, n - until : n - depth].ravel()])
            mark = np.zeros(n, bool)
            mark[met] = True
            rows = np.flatnonzero(mark & fresh)
        else:  # all scores are 0, no list tells anything
            rows, until, threshold = np.flatnonzero(fresh), n, anchor.dtype.type(0)
        fresh[rows] = False
        if len(rows):
            wanted.add(rows, lists.vectors[rows] @ anchor)
            scored += len(rows)
        if threshold < wanted.least():
            break
        depth = until
    return scored


class Best:
    """The k rows of highest score, ties by smaller id, that lie in [low, high]."""

    def __init__(self, ids: np.ndarray, k: int, low=-np.inf, high=np.inf):
        self.ids, self.k, self.high = ids, k, high
        self.low = low if low <= high else np.inf  # an empty window asks for nothing
        self.rows, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        floor = self.least()
        good = (scores >= floor) & (scores <= self.high)
        if not good.any():
            return
        rows, scores = np.r_[self.rows, rows[good]], np.r_[self.scores, scores[good]]
        order = sorted(range(len(rows)), key=lambda k: (-scores[k], self.ids[rows[k]]))[: self.k] if scores.dtype == object else np.lexsort((self.ids[rows], -scores))[: self.k]
        self.rows, self.scores = rows[order], scores[order]

    def least(self):
        """The score that a row needs to count."""
        return self.scores[-1] if len(self.rows) == self.k else self.low


class Windows:
    """Best rows of several windows of scores at once."""

    def __init__(self, ids: np.ndarray, windows: list[tuple[float, float]], k: int):
        self.best = [Best(ids, k, low, high) for low, high in windows]

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        for b in self.best:
            b.add(rows, scores)

    def least(self):
        return min(b.least() for b in self.best)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of vectors, shorter ones filled with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _exact(*tables: np.ndarray) -> list[np.ndarray]:
    """The tables as floats if their inner products are exact in them, else as Python's whole numbers."""
    most = float(np.prod([float(np.abs(t.astype(float)).max(initial=0)) for t in tables])) * max(1, tables[0].shape[1])
    return [t.astype(np.float64 if most < 2**53 else object) for t in tables]


def _long(scores) -> list[int]:
    """Scores as longs; those beyond a long count as its bounds."""
    return [int(min(max(int(s), -_TOP - 1), _TOP)) for s in scores]


def _searched(left: pd.DataFrame, right: pd.DataFrame):
    """The anchors' vectors and the candidates' lists of a group."""
    width = max([0, *left["vector"].map(len), *right["vector"].map(len)])
    anchors, vectors = _exact(_matrix(left["vector"], width), _matrix(right["vector"], width))
    return anchors, Lists(right["id"].to_numpy(), vectors, right["label"].to_numpy())


POSITIVE = "anchor long, anchor_id long, positive_id long, positive_score long"


def _positives(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k best candidates of each anchor in a group of one label."""
        out = []
        if len(left) and len(right):
            anchors, lists = _searched(left, right)
            no_id = right["no_id"].to_numpy()
            for number, own, vector in zip(left["number"], left["id"], anchors, strict=True):
                best = Best(lists.ids, k)
                threshold_search(vector, lists, best, (lists.ids != own) | no_id)
                out += [(number, own, None if no_id[r] else lists.ids[r], s) for r, s in zip(best.rows, _long(best.scores), strict=True)]
        return pd.DataFrame(out, columns=["anchor", "anchor_id", "positive_id", "positive_score"]).astype("Int64")

    return run


FOUND = "anchor long, place int, negative_id long, negative_score long"


def _negatives(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k best candidates of each window of each anchor, of other labels than the anchor's."""
        out = []
        if len(left) and len(right):
            anchors, lists = _searched(left, right)
            no_id = right["no_id"].to_numpy()
            for number, label, scores, vector in zip(left["number"], left["label"], left["scores"], anchors, strict=True):
                windows = [(-(-LOWEST * int(s) // 100), HIGHEST * int(s) // 100) for s in scores]
                wanted = Windows(lists.ids, windows, k)
                threshold_search(vector, lists, wanted, lists.labels != label)
                for place, best in enumerate(wanted.best):
                    out += [(number, place, None if no_id[r] else lists.ids[r], s) for r, s in zip(best.rows, _long(best.scores), strict=True)]
        return pd.DataFrame(out, columns=["anchor", "place", "negative_id", "negative_score"]).astype("Int64")

    return run


def prepared(embeddings: DataFrame) -> DataFrame:
    """number (of the row), id, no_id, label, vector (whole numbers) of the rows that take part.

    Rows with a null label, a null vector, or a null or non-finite component don't; those of a null vec_id do, with the largest
    id instead and no_id. Components beyond a long count as its bounds.
    """
    wide = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(good)
    return rows.select(F.monotonically_increasing_id().alias("number"), F.coalesce(F.col("vec_id").cast("long"), F.lit(_TOP)).alias("id"), F.col("vec_id").isNull().alias("no_id"), label.cast("long").alias("label"), wide.alias("vector"))


def _dealt(rows: DataFrame, name: str, groups) -> DataFrame:
    """rows with a group by the hash of their number."""
    return rows.withColumn(name, F.pmod(F.xxhash64("number", F.lit(name)), groups).cast("int"))


def _cogroup(left: DataFrame, right: DataFrame, keys: list[str], left_columns: list[str], right_columns: list[str]):
    """Both sides by the same keys. toDF gives the right side columns of its own, as both come from one table."""
    return left.select(*keys, *left_columns).groupBy(*keys).cogroup(right.select(*keys, *right_columns).toDF(*keys, *right_columns).groupBy(*keys))


def _groups(n: int, size: int) -> int:
    return max(1, -(-n // size))


def hard_negatives(embeddings: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by `every`. Anchors and candidates are dealt into groups of bounded size: for
    positives within each label, which may be any share of the rows, for negatives over all rows; each anchor is searched
    against each group of candidates by the threshold algorithm, and the best of all groups stay. All rows are searched for
    each anchor: the work grows with their product, as it must, but no task with more than a group of either.

    Rows that repeat a vec_id are rows of their own, but never their own positives; an anchor that is repeated has its
    results as often. Vectors of different lengths are filled up with zeros; empty ones have the score 0 with all. No rows
    give none. Scores beyond a long count as its bounds.
    """
    rows = materialise(prepared(embeddings), "vectors")
    is_anchor = ~F.col("no_id") & (F.col("id") % every == 0)
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    by_label = rows.groupBy("label").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / CANDIDATES)).alias("parts"), F.greatest(F.lit(1), F.ceil(F.count_if(is_anchor) / ANCHORS)).alias("anchor_parts"))
    marked = rows.join(by_label, "label")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    left = _dealt(marked.filter(is_anchor), "part", F.col("anchor_parts")).withColumn("other", spread(F.col("parts")))
    right = _dealt(marked, "other", F.col("parts")).withColumn("part", spread(F.col("anchor_parts")))
    found = _cogroup(left, right, ["label", "part", "other"], ["number", "id", "vector"], ["id", "no_id", "vector"]).applyInPandas(_positives(positives), POSITIVE)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    chosen = materialise(found.withColumn("place", (F.row_number().over(order) - 1).cast("int")).filter(F.col("place") < positives), "positives")

    scores = chosen.groupBy(F.col("anchor").alias("number")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))
    parts, others = _groups(n_anchors, ANCHORS), _groups(n, CANDIDATES)
    left = _dealt(rows.filter(is_anchor).join(scores, "number"), "part", F.lit(parts)).withColumn("other", spread(F.lit(others)))
    right = _dealt(rows, "other", F.lit(others)).withColumn("part", spread(F.lit(parts)))
    found = _cogroup(left, right, ["part", "other"], ["number", "label", "vector", "scores"], ["id", "no_id", "label", "vector"]).applyInPandas(_negatives(negatives), FOUND)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    best = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= negatives)
    return chosen.join(best, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = f"""
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM e AS a JOIN e AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LOWEST} * positive_score <= 100 * score AND 100 * score <= {HIGHEST} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""


def op12(spark, sf_dir: str) -> DataFrame:
    """All embeddings. Nulls, repeated rows, ties and vectors of other lengths: see hard_negatives."""
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
