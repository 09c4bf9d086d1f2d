"""Best-two-fit packing of token pieces into sequences of a fixed length."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialise, text_or_empty

LENGTH = 1024
END = 2
#: Pieces of one length are numbered in groups, whose numbers are then shifted: SPREAD groups if there are as many times
#: LEAST pieces, and no more than about GROUP pieces in each.
GROUP, SPREAD, LEAST = 200_000, 64, 256
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=1)
def tokenizer(path: str):
    """The ids of byte_bpe_50k.json, from its ranks: the same vocabulary, cut and special token, at four times the speed."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


@lru_cache(maxsize=1)
def whole_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str, ranks: str, vocabulary: str) -> np.ndarray:
    """The ids of a text. The regular expressions of the faster library give up on runs of about a million white-space characters:
    then the other one, which has no such bound, encodes the text."""
    try:
        return tokenizer(ranks).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(whole_tokenizer(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all are full but the first, which may be shorter."""
    first = n % length or min(n, length)
    return [(0, first), *((start, length) for start in range(first, n, length))]


def _piece_batches(path: str, vocabulary: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(token_ids(text.as_py(), path, vocabulary), end).astype("<u4")
                for k, (start, size) in enumerate(cut(len(ids), length)):
                    for column, value in zip(rows, (doc_id, k, start, size, zlib.crc32(ids[start : start + size])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document, repeated rows and long texts in full.

    A null text is empty and gives the end id alone. No text is too long, whatever it is made of.
    """
    path, vocabulary = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_piece_batches(path, vocabulary, length, end), schema)


def _best_two(counts: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths on hand with the largest sum up to room; (0, 0) if there are none."""
    there = np.flatnonzero(counts[: room + 1])
    there = there[there > 0]
    if not len(there):
        return 0, 0
    partner = np.searchsorted(there, room - there, side="right") - 1
    # the same length twice needs two pieces of it: step down to the next shorter one
    partner = np.where((partner >= 0) & (there[partner] == there) & (counts[there] < 2), partner - 1, partner)
    fits = partner >= 0
    if not fits.any():
        return 0, 0
    sums = np.where(fits, there + there[partner], 0)
    best = int(sums.argmax())
    return int(there[best]), int(there[partner[best]])


def one_bin(counts: np.ndarray, capacity: int) -> list[int]:
    """Fills a bin greedily, longest first; then its shortest piece gives way to two that fill its place and the gap better."""
    left, room, items = counts.copy(), capacity, []
    while room > 0:
        there = np.flatnonzero(left[: room + 1])
        if not len(there) or there[-1] == 0:
            break
        items.append(int(there[-1]))
        left[items[-1]] -= 1
        room -= items[-1]
    if room and len(items) > 1:
        smallest = items[-1]
        a, b = _best_two(left, room + smallest)
        if a + b > smallest and b:
            items = [*items[:-1], max(a, b), min(a, b)]
    return items


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(times, lengths) of bins for counts[l] pieces of each length l. A bin is repeated as often as the counts allow,
    so the work depends on the capacity and not on the number of pieces."""
    counts, plan = counts.copy(), []
    while counts.any():
        items = one_bin(counts, capacity)
        lengths, uses = np.unique(items, return_counts=True)
        times = int((counts[lengths] // uses).min())
        counts[lengths] -= times * uses
        plan.append((times, items))
    return plan


def runs(plan: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the first number of each run of pieces, the sequence that it goes to and the place in there."""
    out: dict[int, list[list[int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, items in plan:
        offset = 0
        for length in items:
            for column, value in zip(out.setdefault(length, [[], [], []]), (used.get(length, 0), sequence, offset), strict=True):
                column.append(value)
            used[length] = used.get(length, 0) + times
            offset += length
        sequence += times
    return {length: tuple(np.array(x, np.int64) for x in columns) for length, columns in out.items()}


def _place_batches(where: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            bounds = np.flatnonzero(np.diff(length[order], prepend=-1))
            for at in np.split(order, bounds[1:]):
                if len(at):
                    firsts, sequences, offsets = where[int(length[at[0]])]
                    k = np.searchsorted(firsts, number[at], side="right") - 1
                    sequence[at] = sequences[k] + number[at] - firsts[k]
                    offset[at] = offsets[k]
            kept = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(cut_pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds sequence_id and offset to pieces: doc_id, piece, start, length, ids_crc32.

    Packing depends on lengths alone. Their counts (`length` numbers at most) are packed on the driver; pieces of
    one length are numbered in groups of about GROUP rows, so no task holds a whole length, and each number has its
    place. Full pieces are sequences of their own and aren't numbered. Pieces that repeat or have a null doc_id are
    packed like any other; no pieces give no rows.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    table = materialise(cut_pieces.select(*names, (F.rand(7) * (1 << 30)).cast("long").alias("salt")), "pieces")
    short, counts = table.filter(F.col("length") < length), np.zeros(length + 1, np.int64)
    for size, n in short.groupBy("length").agg(F.count(F.lit(1))).collect():  # a row for each length
        counts[size] = n
    groups = F.from_json(F.lit(json.dumps(np.maximum(np.clip(counts // LEAST, 1, SPREAD), counts // GROUP).tolist())), "array<bigint>")
    short = short.withColumn("group", F.pmod("salt", F.get(groups, F.col("length").cast("int"))))
    sizes = short.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)  # a row for each group of GROUP rows
    before = sizes.select("length", "group", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "group").orderBy("doc_id", "piece", "salt"))
    numbered = short.withColumn("own", own).join(before, ["length", "group"]).withColumn("number", F.col("own") - 1 + F.col("before"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = numbered.select(*names, "number").mapInArrow(_place_batches(runs(best_two_fit(counts, length))), schema)
    full = table.filter(F.col("length") >= length).select(*names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.union(full)


def op1(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return pack(pieces(documents(spark, sf_dir)))
