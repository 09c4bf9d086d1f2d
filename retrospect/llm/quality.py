"""Quality classifier: a generalised additive model with pairwise interactions, learned by cyclic boosting."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, materialise, text_or_empty

FEATURES = (
    "log_chars log_words word_length unique_words letter_share upper_share digit_share space_share line_share comma_stop_share "
    "mark_share symbol_share pipe_share other_ascii_share wide_share symbol_words repeated_lines longest_line top_word entropy"
).split()
#: Labelled rows that the model is fitted on, at most: those of the least hashes of doc_id.
FIT_ROWS = 50_000
BINS, PAIR_BINS, PAIRS = 48, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAST_ROWS, RIDGE = 160, 60, 0.12, 8, 1.0
THRESHOLD = 0.3

#: Character classes of ASCII, as rows of a 0/1 table that the byte counts are multiplied with.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b",.", b"!?;:", b"#$%&*@^~<>=+_\\/", b"|", b"'\"()[]{}-`"]
_TABLE = np.zeros((len(_CLASSES) + 1, 256))
for _k, _bytes in enumerate(_CLASSES):
    _TABLE[_k, list(_bytes)] = 1
_TABLE[len(_CLASSES), 128:] = 1
_ODD_END = re.compile(rb"[^A-Za-z0-9\x80-\xff.,;:!?'\")\]]$")


def features(text: str) -> list[float]:
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(len(data), 1)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n_words = max(len(words), 1)
    unique = set(words)
    share = counts[counts > 0] / n
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        sum(map(len, words)) / n_words,
        len(unique) / n_words,
        *(_TABLE @ counts / n).tolist(),
        sum(1 for w in words if _ODD_END.search(w)) / n_words,
        1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(max(map(len, lines), default=0)),
        max(tally.values(), default=0) / n_words,
        float(-(share * np.log(share)).sum()),
    ]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(text.as_py()) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float32()))], ["doc_id", "features"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, features (an array in the order of FEATURES) for each row of docs; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_feature_batches, "doc_id long, features array<float>")


@dataclass
class Additive:
    """Look-up tables: one by bin for each feature, one by a pair of coarse bins for each interaction."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(edge, x[:, k], side="right") for k, edge in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities: the tables' entries of all bins are added up."""
        out, found = np.full(len(x), self.intercept), self.bins(x)
        for bins, table in zip(found, self.tables, strict=True):
            out += table[bins]
        for i, j, table in self.pairs:
            out += table[self.coarse[i][found[i]], self.coarse[j][found[j]]]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, splits: int = 2) -> np.ndarray:
    """Step heights by bin of a regression tree of a few splits on the bins' sums of gradients and weights."""
    bounds = [0, len(gradient)]
    g, w, n = (np.concatenate([[0], np.cumsum(x)]) for x in (gradient, weight, rows))
    for _ in range(splits):
        best = (1e-9, None)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            at = np.arange(a + 1, b)
            at = at[(n[at] - n[a] >= LEAST_ROWS) & (n[b] - n[at] >= LEAST_ROWS)]
            if len(at):
                gain = (g[at] - g[a]) ** 2 / (w[at] - w[a] + RIDGE) + (g[b] - g[at]) ** 2 / (w[b] - w[at] + RIDGE) - (g[b] - g[a]) ** 2 / (w[b] - w[a] + RIDGE)
                if gain.max() > best[0]:
                    best = float(gain.max()), int(at[gain.argmax()])
        if best[1] is None:
            break
        bounds = sorted([*bounds, best[1]])
    out = np.zeros(len(gradient))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + RIDGE)
    return out


def cross_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best split of a grid in both directions: its gain and the steps by cell."""
    g, w = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (gradient, weight))
    best, (p, q) = (-1.0, None), gradient.shape
    for a in range(1, p):
        for b in range(1, q):
            parts = [(g[a, b], w[a, b]), (g[a, q] - g[a, b], w[a, q] - w[a, b]), (g[p, b] - g[a, b], w[p, b] - w[a, b]), (g[p, q] - g[a, q] - g[p, b] + g[a, b], w[p, q] - w[a, q] - w[p, b] + w[a, b])]
            gain = sum(x * x / (y + RIDGE) for x, y in parts)
            if gain > best[0]:
                best = gain, (a, b, [x / (y + RIDGE) for x, y in parts])
    out = np.zeros((p, q))
    if best[1]:
        a, b, (x, y, z, u) = best[1]
        out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = x, y, z, u
    return best[0], out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Features take turns: each round, a shallow tree on one feature's bins is added to its table; then pairs do."""
    model = Additive()
    share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 0.5
    model.intercept = float(np.log(share / (1 - share)))
    if len(y) < 2 or len(np.unique(y)) < 2:
        model.edges, model.tables = [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1]
        return model
    model.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(edge) + 1) for edge in model.edges]
    model.coarse = [np.arange(len(t)) * PAIR_BINS // len(t) for t in model.tables]
    bins, total = model.bins(x), np.full(len(y), model.intercept)
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]

    def sums(key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(key, y - p, n), np.bincount(key, p * (1 - p), n)

    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            step = RATE * shallow_tree(*sums(bins[k], len(table)), rows[k])
            table += step
            total += step[bins[k]]
    keys = {(i, j): model.coarse[i][bins[i]] * PAIR_BINS + model.coarse[j][bins[j]] for i, j in combinations(range(len(bins)), 2)}
    grid = (PAIR_BINS, PAIR_BINS)
    gains = {pair: cross_tree(*(s.reshape(grid) for s in sums(key, PAIR_BINS**2)))[0] for pair, key in keys.items()}
    chosen = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    tables = {pair: np.zeros(grid) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for pair in chosen:
            step = RATE * cross_tree(*(s.reshape(grid) for s in sums(keys[pair], PAIR_BINS**2)))[1]
            tables[pair] += step
            total += step.ravel()[keys[pair]]
    model.pairs = [(i, j, tables[i, j]) for i, j in chosen]
    return model


def _score_batches(model: Additive):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack(batch.column("features").to_numpy(zero_copy_only=False)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(model.score(x))], ["doc_id", "held_out", "score"])

    return run


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    Labels of held-out ids, null labels and labels of no document are not learned from; of several for one id the
    largest counts. Without labels of both kinds every score is their share (0.5 if there are none). Null texts are empty, repeated
    rows have a row each, very long texts are measured whole.
    """
    table = materialise(measured(docs), "features")
    marks = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality")).filter(~held_out())
    sample = table.join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select("features", "quality").toPandas()
    x = np.stack(sample["features"]).astype(np.float64) if len(sample) else np.zeros((0, len(FEATURES)))
    model = fit(x, sample["quality"].to_numpy(np.float64) > 0)
    scored = table.withColumn("held_out", held_out()).mapInArrow(_score_batches(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op5(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
