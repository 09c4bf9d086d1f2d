"""Toxicity: every passage of significant score over the words' log-odds, and extreme-value calibration of a document's passages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, documents, materialise, text_or_empty

#: Labelled rows of either label that the model is fitted on, at most: those of the least hashes of doc_id.
FIT_ROWS = 8_000
#: Parts of these rows: each is scored with the words of the others before scores are calibrated.
FOLDS = 3
#: Beginnings of words, in characters, that have log-odds of their own. A word ends with an end mark, so that whole short words have too.
SHORTEST, LONGEST, END = 3, 10, "$"
#: Contexts that a beginning needs; the weight of the shorter beginning's share, and its bound; standard errors that odds are shrunk by.
LEAST, PRIOR, SURE, ERRORS = 3, 2.0, 0.02, 1.5
#: Beginnings that are kept, at most, of largest odds; more than a sample of FIT_ROWS rows has given yet.
LEXICON = 400_000
#: Scores are whole numbers: UNIT for each nat of log-odds, less COST for every word.
UNIT, COST, HIGHEST = 4, 4, 40
#: Characters that are scored at once, and words whose scores are remembered.
SLICE, REMEMBERED = 1 << 20, 1 << 19
#: Passages that count must be likelier than this in a text by chance.
SIGNIFICANT = 0.05
RIDGE, THRESHOLD = 1.0, 0.7

_WORD = re.compile(r"[^\W\d_]+")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


# --- words and their odds ---


def beginnings(word: str) -> list[str]:
    """The beginnings of a word in lower case, shortest first; those of a short word are the word itself."""
    marked = word.lower() + END
    return [marked[:k] for k in range(min(SHORTEST, len(marked)), min(LONGEST, len(marked)) + 1)]


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of each row with the word before it, once."""
    for batch in batches:
        for fold, toxic, text in zip(batch.column("fold").to_pylist(), batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
            words = [w.lower() for w in _WORD.findall(text.as_py())]
            pairs = list(set(zip(words, ["", *words])))
            mask = 1 << fold
            for at in range(0, len(pairs), 1 << 16):
                some = pairs[at : at + (1 << 16)]
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some]), pa.array([b for _, b in some]), pa.array([mask * (toxic == 1)] * n, pa.int32()), pa.array([mask * (toxic == 0)] * n, pa.int32())], ["word", "before", "toxic", "clean"])


def contexts(sample: DataFrame) -> DataFrame:
    """start, and for each fold the contexts in which it begins a word in toxic and in clean rows of the other folds (the last pair: of all).

    A context is a word with the word before it. A passage that many rows share gives each of its words one context, so copies
    don't make its words look toxic.
    """
    pairs = sample.mapInArrow(_pair_batches, "word string, before string, toxic int, clean int")
    once = pairs.groupBy("word", F.xxhash64("before").alias("before")).agg(F.bit_or("toxic").alias("toxic"), F.bit_or("clean").alias("clean"))
    others = lambda side, k: F.col(side).bitwiseAND(F.lit(((1 << FOLDS) - 1) & ~(1 << k) if k < FOLDS else (1 << FOLDS) - 1)) != 0
    names = [f"{side}_{k}" for k in range(FOLDS + 1) for side in ("toxic", "clean")]
    words = once.groupBy("word").agg(*[F.count_if(others(side, k)).alias(f"{side}_{k}") for k in range(FOLDS + 1) for side in ("toxic", "clean")])
    marked = F.concat(F.col("word"), F.lit(END))
    start = F.explode(F.transform(F.sequence(F.least(F.lit(SHORTEST), F.char_length(marked)), F.least(F.lit(LONGEST), F.char_length(marked))), lambda k: F.substring(marked, F.lit(1), k)))
    return words.select(start.alias("start"), *names).groupBy("start").agg(*[F.sum(c).alias(c) for c in names])


def shorter(starts: list[str]) -> np.ndarray:
    """The number of the next shorter beginning of each, -1 for the shortest ones."""
    where = {s: k for k, s in enumerate(starts)}
    return np.array([where.get(s[:-1], -1) for s in starts], np.int64)


def odds(starts: list[str], up: np.ndarray, toxic: np.ndarray, clean: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """Log-odds of each beginning: those of the next shorter one, and what they differ from them by more than ERRORS standard errors.

    The two Dirichlet priors of a beginning have PRIOR pseudo-counts, split as the next shorter beginning's share is (but for SURE
    of them at least); the shortest ones' are split evenly. Counts are balanced by the totals of both kinds.
    """
    a, b = (x * (sum(totals) / 2 / max(t, 1)) for x, t in zip((toxic, clean), totals, strict=True))
    share, values, out = np.full(len(starts), 0.5), np.zeros(len(starts) + 1), np.zeros(len(starts) + 1)  # the last is of no beginning
    error = np.sqrt(1 / (toxic + 1) + 1 / (clean + 1))
    lengths = np.array([len(s) for s in starts], np.int64)
    for n in np.unique(lengths):
        k = np.flatnonzero(lengths == n)
        prior = np.clip(np.where(up[k] >= 0, share[up[k]], 0.5), SURE, 1 - SURE)
        ones, others = a[k] + PRIOR * prior, b[k] + PRIOR * (1 - prior)
        share[k] = ones / (ones + others)
        values[k] = np.log(ones / others)
        more = values[k] - values[up[k]]
        out[k] = out[up[k]] + np.sign(more) * np.maximum(np.abs(more) - ERRORS * error[k], 0)
    return out[:-1]


def lexicon(starts: list[str], up: np.ndarray, values: np.ndarray) -> dict[str, int]:
    """Whole scores of beginnings; those that score as the next shorter one does are left out."""
    scores = np.clip(np.rint(UNIT * values), -HIGHEST, HIGHEST).astype(int)
    kept = np.flatnonzero(scores != np.where(up >= 0, scores[up], 0))
    if len(kept) > LEXICON:
        kept = kept[np.argsort(-np.abs(scores[kept]), kind="stable")[:LEXICON]]
    return {starts[k]: int(scores[k]) for k in kept}


class Scores(dict):
    """The score of each word: that of its longest known beginning, less COST."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        score = self[word] = next((self.known[s] for s in reversed(beginnings(word)) if s in self.known), 0) - COST
        return score


# --- passages ---


def passages(places: list[int], scores: list[int], before: list[int]) -> list[tuple[int, int, int]]:
    """(first, last, score) of all maximal scoring passages, in order, in time linear in the words of positive score.

    places and scores are those of the words of positive score, before[k] is the sum of all scores ahead of the k-th. A maximal
    passage has no better one within it or around it. Each word starts a candidate; a candidate is joined with the
    last one before it that begins lower and ends lower, and all between.
    """
    found: list[list[int]] = []  # first, last, sum before it, sum up to its end, index of the last candidate that begins lower
    for place, score, low in zip(places, scores, before, strict=True):
        new = [place, place, low, low + score, -1]
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= new[2]:
                k = found[k][4]
            if k < 0 or found[k][3] >= new[3]:
                new[4] = k
                found.append(new)
                break
            new = [found[k][0], new[1], found[k][2], new[3], -1]
            del found[k:]
    return [(first, last, up - low) for first, last, low, up, _ in found]


def positives(text: str, scores: Scores) -> tuple[int, list[int], list[int], list[int], np.ndarray]:
    """Words, and of those with a positive score their numbers, scores and the sums before them; and how often each score occurs.

    Long texts are taken in slices that end between words.
    """
    n, total, at = 0, 0, 0
    places: list[int] = []
    values: list[int] = []
    before: list[int] = []
    counts = np.zeros(2 * HIGHEST + 1, np.int64)
    while at < len(text):
        end = at + SLICE
        if _WORD.match(text, end - 1, end) and (word := _WORD.match(text, end)):
            end = word.end()
        words = _WORD.findall(text, at, end)
        some = np.fromiter(map(scores.__getitem__, words), np.int64, len(words))
        counts += np.bincount(some + HIGHEST + COST, minlength=2 * HIGHEST + 1)[: 2 * HIGHEST + 1]
        if len(high := np.flatnonzero(some > 0)):
            sums = np.cumsum(some)
            places += (high + n).tolist()
            values += some[high].tolist()
            before += (total + sums[high] - some[high]).tolist()
        n, total, at = n + len(words), total + int(some.sum()), end
    return n, places, values, before, counts


# --- extreme values ---


def decay(counts: np.ndarray) -> float:
    """The rate at which the score of the best chance passage becomes unlikely: the positive root of E[exp(rate x score)] = 1.

    counts are those of clean words' scores, the lowest first. Without positive scores, or with a mean above 0, it is 1 / UNIT.
    """
    values = np.arange(len(counts)) - HIGHEST - COST
    share = counts / max(counts.sum(), 1)
    if not counts[values > 0].any() or share @ values >= 0:
        return 1 / UNIT
    low, high = 1e-6, 4.0
    for _ in range(100):
        rate = (low + high) / 2
        low, high = (rate, high) if share @ np.exp(rate * values) < 1 else (low, rate)
    return min(low, 1 / UNIT)


def evidence(sums: list[int], n: int, rate: float, scale: float) -> float:
    """How unlikely a text's best passages are by chance: minus the logarithm of the least probability over their numbers.

    The normalised score of a passage is rate x score - log(scale x n). The sum t of the r best ones exceeds by chance with
    a probability of about exp(-t) t^(r - 1) / (r! (r - 1)!); each r more is halved as evidence, as it was chosen.
    """
    best, total, base = 0.0, 0.0, log(max(scale * n, 1e-9))
    for r, score in enumerate(sorted(sums, reverse=True), start=1):
        x = rate * score - base
        if r > 1 and x <= 0 or r > 200:
            break
        total += x
        if r == 1:
            value = -log(-np.expm1(-exp(-total))) if total < 30 else total
        else:
            value = total - (r - 1) * log(max(total, 1e-9)) + lgamma(r + 1) + lgamma(r)
        best = max(best, value - (r - 1) * log(2))
    return best


@dataclass
class Model:
    """Scores of beginnings, the extreme-value law of chance passages, and the logistic curve over the evidence."""

    known: dict[str, int] = field(default_factory=dict)
    rate: float = 1 / UNIT
    scale: float = 1.0
    slope: float = 0.0
    intercept: float = 0.0

    def probability(self, x: float) -> float:
        z = min(max(self.slope * x + self.intercept, -30.0), 30.0)
        return 1 / (1 + exp(-z))

    def judged(self, text: str, scores: Scores) -> tuple[float, list[tuple[int, int, int]]]:
        """The probability that a text is toxic, and (first word, last word, score) of its significant passages."""
        n, places, values, before, _ = positives(text, scores)
        found = passages(places, values, before)
        p = self.probability(evidence([s for _, _, s in found], n, self.rate, self.scale))
        least = (log(max(self.scale * n, 1e-9)) - log(-log1p(-SIGNIFICANT))) / self.rate if found else 0.0
        return p, [x for x in found if x[2] >= least]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (0 at least) and intercept of a weighted logistic curve, by Newton steps; the slope has the ridge of RIDGE rows."""
    ridge = RIDGE / max(len(x), 1)
    a, total = 0.0, max(float(weight.sum()), 1e-9)
    share = min(max(float((weight * y).sum()) / total, 1e-4), 1 - 1e-4)
    b = log(share / (1 - share))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (y - p) * x).sum() / total - ridge * a, (weight * (y - p)).sum() / total])
        w = weight * np.maximum(p * (1 - p), 1e-6) / total
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-12))
        a, b = max(0.0, a + step[0]), b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _fold_batches(models: list[dict[str, int]]):
    """n_words, the passages' scores and the counts of word scores of each row, by the words of the other folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [Scores(known) for known in models]
        for batch in batches:
            rows = []
            for fold, text in zip(batch.column("fold").to_pylist(), batch.column("text"), strict=True):
                n, places, values, before, counts = positives(text.as_py(), scores[fold])
                rows.append((n, [s for _, _, s in passages(places, values, before)], counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2].tolist() for r in rows], pa.list_(pa.int64()))], ["toxic", "n_words", "sums", "counts"]
            )

    return run


def sampled(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, dict[int, int]]:
    """toxic, fold, text of the learned ids, `rows` of each label at most; and how many labelled ids of each there are.

    Of several rows of one id the least text is taken.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")).filter(~held_out())
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    marked = marks.join(own.select("doc_id"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    some = [marked.filter(F.col("toxic") == y).orderBy("h", "doc_id").limit(rows) for y in (0, 1)]
    picked = some[0].union(some[1]).select("doc_id", "toxic", F.pmod("h", F.lit(FOLDS)).cast("int").alias("fold"))  # 2 x rows at most
    return own.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic", "fold").agg(F.min("text").alias("text")).drop("doc_id"), counts


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """The model of the learned rows. Without rows of both labels every score is their share (0.5 if there are none)."""
    sample, counts = sampled(docs, labels, rows)
    share = counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 0.5
    if not (counts.get(0) and counts.get(1)):
        return Model(intercept=log(max(share, 1e-9) / max(1 - share, 1e-9)))
    sample = materialise(sample, "toxic-sample")
    names = [f"{side}_{k}" for k in range(FOLDS + 1) for side in ("toxic", "clean")]
    counted = materialise(contexts(sample), "toxic-starts")
    totals = counted.filter(F.char_length("start") <= SHORTEST).filter(f"char_length(start) = {SHORTEST} or endswith(start, '{END}')").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in names]).first()
    table = counted.filter(F.col(f"toxic_{FOLDS}") + F.col(f"clean_{FOLDS}") >= LEAST).toPandas().sort_values("start", kind="stable")
    starts = table["start"].tolist()
    up = shorter(starts)
    models = [lexicon(starts, up, odds(starts, up, *(table[f"{side}_{k}"].to_numpy(np.float64) for side in ("toxic", "clean")), (totals[2 * k], totals[2 * k + 1]))) for k in range(FOLDS + 1)]
    seen = sample.mapInArrow(_fold_batches(models[:-1]), "toxic int, n_words long, sums array<long>, counts array<long>")
    scored = materialise(seen, "toxic-scored")
    clean = scored.filter("toxic = 0").select(F.posexplode("counts").alias("score", "n")).groupBy("score").agg(F.sum("n").alias("n")).collect()
    every = np.zeros(2 * HIGHEST + 1, np.int64)
    for r in clean:
        every[r["score"]] = r["n"]
    known = scored.select("toxic", "n_words", "sums").toPandas()
    discard(sample, counted, scored)
    rate, y = decay(every), known["toxic"].to_numpy(np.float64)
    best, n = np.array([max(s, default=0) for s in known["sums"]], float), known["n_words"].to_numpy(np.float64)
    scale = float((y == 0).sum() / max(float((n * np.exp(-rate * best))[y == 0].sum()), 1.0))
    x = np.array([evidence(list(s), int(k), rate, scale) for s, k in zip(known["sums"], n, strict=True)])
    kinds = [max(int((y == v).sum()), 1) for v in (0, 1)]
    weight = np.where(y > 0, counts[1] / kinds[1], counts[0] / kinds[0])
    return Model(models[-1], rate, scale, *logistic(x, y, weight))


SCHEMA = "doc_id long, score double, n_passages long, passages string"


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(model.known)
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column("text"):
                value = text.as_py()
                p, found = model.judged(value, scores)
                for column, x in zip(out, (p, len(found), ",".join(f"{a}:{b}:{s}" for a, b, s in located(value, found))), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.float64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def located(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, float]]:
    """(start, end, score) of passages that are given by their words; in code points, ends exclusive, scores in nats."""
    if not found:
        return []
    wanted, out, k = sorted(found), [], 0
    start = 0
    for number, m in enumerate(_WORD.finditer(text)):
        if number == wanted[k][0]:
            start = m.start()
        if number == wanted[k][1]:
            out.append((start, m.end(), wanted[k][2] / UNIT))
            k += 1
            if k == len(wanted):
                break
    return out


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, passages for each row of docs.

    passages joins start:end:score of every significant passage in order (code points, end exclusive, nats). Labels of held-out
    ids, null labels and labels of no document are not learned from; of several for one id the largest counts. Null texts are
    empty and have the score of no evidence, repeated rows have a row each, very long texts are scored whole, in slices.
    """
    model = fit(docs, labels, rows)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_score_batches(model), SCHEMA)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "passages")


def op11(spark, sf_dir: str) -> DataFrame:
    """All documents. Nulls, repeated rows, long texts and missing labels: see toxicity."""
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
