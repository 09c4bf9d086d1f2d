"""Periodic runs of words: seeds on diagonals, extended as far as the words repeat."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_or_empty

#: A run has this many words and repeats its period this many times at least.
LEAST, TIMES = 24, 3
#: Words that two copies of a run, one period apart, share at least: max(LEAST - q, 2 q) for period q, which is least at q = 8.
OVERLAP = 16
#: Words that are gathered from one text after another before they are searched together.
GATHER = 300_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words, of which a tenth of the documents (by the CRC-32 of doc_id) repeat a stretch to their end; a null doc_id repeats none."""
    if doc_id is None or not words or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * ((n - a) // p + 1))[: n - a]


def repeats(ids: np.ndarray, starts: np.ndarray, size: int = OVERLAP) -> np.ndarray:
    """Which of the texts (ids of words, the text k at starts[k] to starts[k + 1]) may hold a run of `size` words twice.

    Hashes of all such stretches are compared within each text, so none that does is missed.
    """
    if len(ids) < size:
        return np.zeros(len(starts) - 1, bool)
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15)
        values = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        values ^= values >> np.uint64(32)
        hashes = np.zeros(len(ids) - size + 1, np.uint64)
        for k in range(size):
            hashes = hashes * base + values[k : k + len(hashes)]
        hashes ^= hashes >> np.uint64(29)
        text = np.searchsorted(starts, np.arange(len(hashes)), side="right") - 1
        inside = np.arange(len(hashes)) + size <= starts[text + 1]
        hashes, text = hashes[inside], text[inside]
        order = np.argsort(hashes)
    hashes, text = hashes[order], text[order]
    same = hashes[1:] == hashes[:-1]
    # equal hashes of several texts stand in any order: these few are sorted by text too
    alike = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
    again = np.lexsort((text[alike], hashes[alike]))
    h, t = hashes[alike][again], text[alike][again]
    out = np.zeros(len(starts) - 1, bool)
    out[t[1:][(h[1:] == h[:-1]) & (t[1:] == t[:-1])]] = True
    return out


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of pairs: equal ones for equal pairs."""
    return np.unique(a * (np.int64(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)


class Names:
    """Numbers of the stretches of any size of one text: equal ones for equal words. A stretch is two of a power of two that overlap."""

    def __init__(self, ids: np.ndarray):
        self.powers = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]

    def of(self, size: int) -> np.ndarray:
        power = size.bit_length() - 1
        while len(self.powers) <= power:
            last, step = self.powers[-1], 1 << (len(self.powers) - 1)
            self.powers.append(_named(last[:-step], last[step:]))
        whole, rest = self.powers[power], size - (1 << power)
        return _named(whole[: len(whole) - rest], whole[rest:]) if rest else whole


def _agree(w: np.ndarray, at: int, lag: int) -> int:
    """The first place from `at` on where w differs from w a lag on."""
    step, end = 64, len(w) - lag
    while at < end:
        stop = min(at + step, end)
        if len(differ := np.flatnonzero(w[at:stop] != w[at + lag : stop + lag])):
            return at + int(differ[0])
        at, step = stop, 2 * step
    return end


def _agree_before(w: np.ndarray, at: int, lag: int) -> int:
    """The first place of the stretch up to `at` in which w equals w a lag on."""
    step = 64
    while at > 0:
        start = max(at - step, 0)
        if len(differ := np.flatnonzero(w[start:at] != w[start + lag : at + lag])):
            return start + int(differ[-1]) + 1
        at, step = start, 2 * step
    return 0


def _shorter(w: np.ndarray, start: int, period: int) -> bool:
    """Whether words with this period, three times or more, have a shorter one: it would divide the period."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            part = period // prime
            if np.array_equal(w[start : start + period], w[start + part : start + part + period]):
                return True
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return False


def find_runs(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of w, by start, then period.

    A run of period q holds its words twice on the diagonal of lag q, max(LEAST - q, 2 q) of them at least. Periods are
    taken by ranges: for those from `low` to `size` all stretches of `size` words are indexed, where `size` is the overlap
    that the whole range guarantees. As no period of the range is longer than the stretch, two occurrences a period apart
    have none between them, or the run would have a shorter period; so only neighbouring occurrences are paired. A pair is
    extended both ways unless its lag's table says that it lies in a stretch that was extended before.
    """
    n, found, names = len(w), [], Names(w)
    low, size = 1, OVERLAP
    while TIMES * low <= n and size <= n:
        named = names.of(size)
        order = np.argsort(named, kind="stable")
        next_to = named[order][1:] == named[order][:-1]
        if not next_to.any():
            break  # longer stretches don't occur twice either
        at, lag = order[:-1][next_to], np.diff(order)[next_to]
        inside = (lag >= low) & (lag <= size) & (TIMES * lag <= n)
        at, lag = at[inside], lag[inside]
        by = np.argsort(at, kind="stable")
        at, lag = at[by], lag[by]
        # of neighbouring seeds on one diagonal the first is enough
        first = np.r_[True, (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])] if len(at) else np.zeros(0, bool)
        covered: dict[int, int] = {}
        for i, q in zip(at[first].tolist(), lag[first].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            start, end = _agree_before(w, i, q), _agree(w, i, q)
            covered[q] = end
            if (length := end - start + q) >= max(LEAST, TIMES * q) and not _shorter(w, start, q):
                found.append((start, length, q))
        low, size = size + 1, 2 * (size + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period, exactly; of equal ones the first."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def dropped(found: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of n words a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"


def _row(doc_id: int | None, words: list[str], found: list[tuple[int, int, int]]) -> tuple:
    best = strongest(found)
    kept = words if not found else [w for w, gone in zip(words, dropped(found, len(words)).tolist(), strict=True) if not gone]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    where = (*best, 1000 * best[1] // best[2]) if best else (None, None, None, None)
    return (doc_id, len(found), *where, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest(), len(words), len(kept))


def searched(texts: list[tuple[int | None, list[str]]]) -> list[tuple]:
    """The rows of some texts, given by doc_id and words; those without a repeated stretch are sorted out together."""
    numbers: dict[str, int] = defaultdict(count().__next__)
    starts = np.cumsum([0, *(len(words) for _, words in texts)])
    ids = np.fromiter((numbers[w] for _, words in texts for w in words), np.int64, int(starts[-1]))
    return [_row(doc_id, words, find_runs(ids[starts[k] : starts[k + 1]]) if again else []) for k, ((doc_id, words), again) in enumerate(zip(texts, repeats(ids, starts).tolist(), strict=True))]


def _run_batches(plant: bool):
    columns = [x.split() for x in SCHEMA.split(", ")]
    schema = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, n = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = _WORD.findall(text.as_py())
                texts.append((doc_id, planted(words, doc_id) if plant else words))
                n += len(words)
                if n >= GATHER:
                    rows += searched(texts)
                    texts, n = [], 0
            if rows := rows + searched(texts):
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256, n_words, n_kept for each row.

    plant repeats a stretch in a tenth of the documents first (planted()). A null text has no words; rows without a run have
    nulls for the strongest one and the digest of nothing for all runs. Repeated rows have a row each, no rows give none;
    very long texts are searched whole by one task, in time of about n log(n)^2 of its words.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_run_batches(plant), SCHEMA)


def _collapse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column("text"):
            if (value := text.as_py()) is not None:
                spans = list(_WORD.finditer(value))
                numbers: dict[str, int] = defaultdict(count().__next__)
                ids = np.fromiter((numbers[m[0]] for m in spans), np.int64, len(spans))
                found = find_runs(ids) if repeats(ids, np.array([0, len(ids)]))[0] else []
                if found:
                    value = " ".join(m[0] for m, gone in zip(spans, dropped(found, len(spans)).tolist(), strict=True) if not gone)
            out.append(value)
        k = batch.schema.get_field_index("text")
        yield batch.set_column(k, batch.schema.field(k), pa.array(out, batch.schema.field(k).type))


def collapse(docs: DataFrame) -> DataFrame:
    """docs whose runs are cut to their first period, with n_chars, if there, counted anew; texts without a run, and null ones, stay as they are."""
    names = [x if x == "text" else f"_{k}" for k, x in enumerate(docs.columns)]
    renamed = docs.toDF(*names)
    out = renamed.mapInArrow(_collapse_batches, renamed.schema).toDF(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op13(spark, sf_dir: str) -> DataFrame:
    """All documents, with the stretches that the contract plants. Null, empty and very long texts, repeated rows: see periodic_runs."""
    return periodic_runs(documents(spark, sf_dir), plant=True)
