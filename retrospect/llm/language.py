"""Language ID: expectation-maximisation over the languages of each document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, materialise, raw_texts

#: Byte trigrams are hashed to so many cells; the model has a row of them for each language.
CELLS = 1 << 15
SMOOTHING = 0.5
ROUNDS = 12
#: A language enters a document's set if it raises the log-likelihood by more than this times log(n-grams) / 2.
PENALTY = 6.0
#: More languages than this are refused: the model, CELLS numbers for each, is sent to every task.
LANGUAGES = 4096
UNKNOWN = "und"
#: Bytes of a text that are taken at a time.
PART = 1 << 20


def cells(data: np.ndarray) -> np.ndarray:
    """The cells of the byte trigrams of a text with a space at either end; ASCII letters are folded."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    low = np.concatenate([[32], low, [32]]).astype(np.uint32)
    mixed = (low[:-2] * 0x9E3779B1 ^ low[1:-1] * 0x85EBCA6B ^ low[2:] * 0xC2B2AE35).astype(np.uint32)
    return (mixed ^ mixed >> 15) % CELLS


def counted(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a text and how often each occurs; texts over PART bytes are counted part by part, so memory stays bounded."""
    if len(data) <= PART:
        return np.unique(cells(data), return_counts=True)
    n = np.zeros(CELLS, np.int64)
    for at in range(0, len(data), PART):
        n += np.bincount(cells(data[at : at + PART]), minlength=CELLS)
    where = np.flatnonzero(n)
    return where, n[where]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        data, ends = raw_texts(batch.column("text"))
        for lang, a, b in zip(batch.column("lang").to_pylist(), ends[:-1], ends[1:], strict=True):
            mine = counts.setdefault(lang, np.zeros(CELLS, np.int64))
            for at in range(a, b, PART):
                mine += np.bincount(cells(data[at : min(b, at + PART)]), minlength=CELLS)
    for lang, mine in counts.items():
        there = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(there, pa.int32()), pa.array(mine[there], pa.int64())], ["lang", "cell", "n"])


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their n-gram probabilities (a row each), from text and non-null lang of all rows given.

    Counts are summed by Spark; CELLS sums for each language come to the driver. ValueError beyond LANGUAGES languages,
    which no column of languages has.
    """
    rows = labelled.filter("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(_count_batches, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    by_lang = materialise(sums.groupBy("lang").agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("counts")), "languages")
    if (n := by_lang.count()) > LANGUAGES:
        raise ValueError(f"{n} languages")
    found = by_lang.orderBy("lang").toArrow()
    model = np.full((len(found), CELLS), SMOOTHING)
    for k in range(len(found)):
        model[k, np.array(found["cells"][k].values)] += np.array(found["counts"][k].values)
    model /= model.sum(axis=1, keepdims=True) if len(found) else 1
    return found["lang"].to_pylist(), model


def proportions(likelihood: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """The share of each language in n-grams of these likelihoods (n-gram x language) and counts, and the log-likelihood."""
    share, total = start, n.sum()
    for _ in range(ROUNDS):
        joint = likelihood * share
        share = (n / joint.sum(axis=1)) @ joint / total
    return share, float(n @ np.log(likelihood @ share))


def mixture(where: np.ndarray, n: np.ndarray, model: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Shares of all languages in these cells and their counts: one language first, then those that pay for their parameter, one by one."""
    likelihood, log = model[:, where].T, logs[:, where]
    single = log @ n
    chosen = [int(single.argmax())]
    best, shares = float(single[chosen[0]]), np.ones(1)
    price = PENALTY * np.log(max(n.sum(), 2)) / 2
    # more than the best language for every n-gram can't be gained
    ceiling = float(log.max(axis=0) @ n)
    while len(chosen) < len(model) and ceiling - best > price:
        tries = []
        for k in range(len(model)):
            if k not in chosen:
                some = [*chosen, k]
                tries.append((*reversed(proportions(likelihood[:, some], n, np.full(len(some), 1 / len(some)))), some))
        value, share, some = max(tries, key=lambda x: x[0])
        if value - best <= price:
            break
        best, shares, chosen = value, share, some
    out = np.zeros(len(model))
    out[chosen] = shares
    return out


def _predict_batches(languages: list[str], model: np.ndarray, carried: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log(model)
        for batch in batches:
            data, ends = raw_texts(batch.column("known"))
            lang, score, sets = [], [], []
            for known, a, b in zip(batch.column("letters").to_pylist(), ends[:-1], ends[1:], strict=True):
                if not (known and languages):
                    lang.append(UNKNOWN), score.append(0.0), sets.append("")
                    continue
                shares = mixture(*counted(data[a:b]), model, logs)
                best = int(shares.argmax())
                lang.append(languages[best])
                score.append(float(min(1.0, shares[best])))
                sets.append(",".join(f"{languages[k]}:{shares[k]:.3f}" for k in np.argsort(-shares, kind="stable") if shares[k] > 0))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in carried), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.string())], [*carried, "lang_pred", "score", "mixture"])

    return run


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def _predict(docs: DataFrame, carried: list, names: tuple[str, ...]) -> DataFrame:
    """carried columns under these names, and lang_pred, score, mixture."""
    languages, model = fit(docs.filter(~F.coalesce(held_out(), F.lit(False))))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*(c.alias(x) for c, x in zip(carried, names, strict=True)), text.alias("known"), text.rlike(r"\p{L}").alias("letters"))
    schema = T.StructType([f for f in rows.schema if f.name in names]).add("lang_pred", "string").add("score", "double").add("mixture", "string")
    return rows.mapInArrow(_predict_batches(languages, model, names), schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, mixture for each row of docs.

    lang_pred is the language of the largest share, score that share; `und` with score 0 if the text is null or has
    no letter, or nothing could be learned. Documents with a null doc_id are never held out. Repeated rows have a row each and
    count as often; very long texts are read whole.
    """
    return _predict(docs, [F.col("doc_id").cast("long"), F.coalesce(held_out(), F.lit(False))], ("doc_id", "held_out"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, whose language is known: those predicted `und` go."""
    names = tuple(f"_{k}" for k in range(len(docs.columns)))
    kept = _predict(docs, [F.col(f"`{c}`") for c in docs.columns], names).filter(F.col("lang_pred") != UNKNOWN)
    return kept.select(*(F.col(x).alias(c) for x, c in zip(names, docs.columns, strict=True)))


def op4(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return identify(documents(spark, sf_dir))
