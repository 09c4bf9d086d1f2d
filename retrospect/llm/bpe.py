"""Byte-level BPE: Spark's higher-order functions fold ranked merges over the bytes of distinct words."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, raw_texts, text_or_empty

#: The characters of Unicode's White_Space, which \\s means in the tokenizer's pattern but not in Java's.
SPACE = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
PATTERN = public_tokenizers.PATTERN.replace(r"[^\s", f"[^{SPACE}").replace(r"\s+(?!\S)", f"[{SPACE}]+(?![^{SPACE}])").replace(r"\s+", f"[{SPACE}]+")

#: Distinct words that a task remembers; then it forgets them and goes on, so its memory stays bounded.
REMEMBERED = 500_000
#: Documents that a task takes at a time.
AT_ONCE = 500
#: Words of more bytes are folded part by part, cut where no token can lie across.
LONG = 48
LATIN = "ISO-8859-1"
#: Tokens of one byte are the characters U+0000 to U+00FF, the token of rank r is U+0100 + r; surrogates begin at U+D800.
FIRST, LIMIT = 0x100, 0xD800 - 0x100


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens that make a token when its own bytes are merged by rank.

    ValueError if they don't end up as this token by merges of lower rank: only for ranks where they do (those of any
    trained BPE) all places of a pair can be merged at once, rank by rank.
    """
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        known = [(ranks[pair], i) for i in range(len(parts) - 1) if (pair := parts[i] + parts[i + 1]) in ranks]
        rank, i = min(known, default=(ranks[token], 0))
        if rank >= ranks[token]:
            raise ValueError(f"token {ranks[token]} isn't made of lower ones")
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class RankMap:
    """The ranked merges as literals for Spark: by rank, the two tokens that are merged and the token they make."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= LIMIT or len(ranks) != len(set(ranks.values())):
            raise ValueError("ranks are not distinct or too large")
        mark = lambda token: token.decode(LATIN) if len(token) == 1 else chr(FIRST + ranks[token])
        pairs: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            if len(token) > 1:
                pairs[rank] = "".join(map(mark, last_merge(token, ranks)))
        literal = lambda x: F.from_json(F.lit(json.dumps(x)), "array<string>")
        self.pairs, self.made = literal(pairs), literal([chr(FIRST + k) for k in range(len(pairs))])


def fold(word: Column, merges: Column, ranks: RankMap) -> Column:
    """The tokens of a word, a character each.

    word: its bytes; merges: the ranks of all tokens within it, in order. Each merge takes all places of its pair from
    the left. Merges of higher rank never bring back a pair of lower rank, so one pass by rank makes all merges.
    """
    return F.aggregate(merges, F.decode(word, LATIN), lambda tokens, rank: F.replace(tokens, F.get(ranks.pairs, rank), F.get(ranks.made, rank)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


# --- distinct words of a task -----------------------------------------------------------------------
# A row is either a part of a word that the task hasn't met (in order), or a document as the numbers of its words (refs, four
# bytes each: Spark measures each row that it sends to Python, which takes long for arrays).

ROW = "doc_id long, forget boolean, begins boolean, word binary, merges array<int>, refs binary"
KINDS = (pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.list_(pa.int32()), pa.binary())
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Prefixes:
    """Which strings begin a token, by length: sorted hashes, and the rank of those that are tokens (else -1).

    Two strings of equal hash would add a merge that isn't in the word, which the fold passes over.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.crossed = np.zeros((256, 256), bool)
        found: list[dict[int, int]] = [{} for _ in range(max(map(len, ranks), default=0) + 1)]
        for token, rank in ranks.items():
            h = token[0] + 1
            for n in range(2, len(token) + 1):
                h = (h * int(_STEP) + token[n - 1] + 1) & 0xFFFFFFFFFFFFFFFF
                self.crossed[token[n - 2], token[n - 1]] = True
                if n == len(token):
                    found[n][h] = rank
                else:
                    found[n].setdefault(h, -1)
        self.hashes = [np.array(sorted(x), np.uint64) for x in found]
        self.ranks = [np.array([x[h] for h in sorted(x)], np.int64) for x in found]

    def merges(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks of the tokens within each part of data, in order, and where each part's begin and end. ends: of the parts."""
        sizes = np.diff(ends, prepend=0)
        part, room = np.repeat(np.arange(len(ends)), sizes), np.repeat(ends, sizes) - np.arange(len(data))
        at, h, keys = np.arange(len(data)), data.astype(np.uint64) + np.uint64(1), []
        for n in range(2, len(self.hashes)):
            there = room[at] >= n
            at, h = at[there], h[there]
            if not len(at):
                break
            h = h * _STEP + data[at + n - 1] + np.uint64(1)
            k = np.minimum(np.searchsorted(self.hashes[n], h), len(self.hashes[n]) - 1)
            there = self.hashes[n][k] == h
            at, h, rank = at[there], h[there], self.ranks[n][k[there]]
            keys.append((part[at] << 17 | rank)[rank >= 0])
        keys = np.sort(np.concatenate([*keys, np.zeros(0, np.int64)]))
        keys = keys[np.diff(keys, prepend=-1) != 0]
        return (keys & 0x1FFFF).astype(np.int32), np.searchsorted(keys >> 17, np.arange(len(ends) + 1)).astype(np.int32)


@lru_cache(maxsize=1)
def _prefixes(path: str) -> Prefixes:
    return Prefixes(read_ranks(path))


def _number_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = _prefixes(path)
        numbers: dict[str, int] = {}
        for batch in batches:
            for k in range(0, batch.num_rows, AT_ONCE):
                if forget := len(numbers) > REMEMBERED:
                    numbers = {}
                yield from _number(batch.slice(k, AT_ONCE), numbers, forget, prefixes)

    return run


def _number(batch: pa.RecordBatch, numbers: dict[str, int], forget: bool, prefixes: Prefixes) -> Iterator[pa.RecordBatch]:
    """The parts of the batch's words that numbers lacks, and its documents; each as one batch of rows."""
    names = [x.split()[0] for x in ROW.split(", ")]
    rows = lambda n, **given: pa.RecordBatch.from_arrays([given.get(name, pa.nulls(n, kind)) for name, kind in zip(names, KINDS, strict=True)], names)
    lists = batch.column("words")
    coded = lists.flatten().dictionary_encode()
    there = len(numbers)
    own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in coded.dictionary.to_pylist()), np.int32, len(coded.dictionary))
    if forget:
        yield rows(1, forget=pa.array([True]))
    if len(numbers) > there:
        new = np.flatnonzero(own >= there)
        data, ends = raw_texts(coded.dictionary)
        data = _gather(data, ends[:-1], np.diff(ends), new)
        sizes = np.diff(ends)[new]
        ends = np.cumsum(sizes)
        # the ends of parts: those of words, and in long words also the places that no token lies across
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = ~prefixes.crossed[data[:-1], data[1:]] & np.repeat(sizes > LONG, sizes)[1:]
        cut[ends] = True
        parts = np.flatnonzero(cut)
        begins = np.isin(np.concatenate([[0], parts[:-1]]), np.concatenate([[0], ends[:-1]]))
        merges, bounds = prefixes.merges(data, parts)
        yield rows(len(parts), begins=pa.array(begins), word=_binaries(data, parts), merges=pa.ListArray.from_arrays(pa.array(bounds), pa.array(merges)))
    refs = own[coded.indices.to_numpy(zero_copy_only=False)] if len(own) else np.zeros(0, np.int32)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    yield rows(batch.num_rows, doc_id=batch.column("doc_id"), refs=_binaries(refs, 4 * ends))


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of data, cut at the ends."""
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(data)])


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of each ref, one after another."""
    n = lengths[refs]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[refs] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


def _token_ids(tokens: pa.Array, id_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of folded parts, one after another, and how many each has."""
    data, ends = raw_texts(tokens)
    data, ends = data[ends[0] : ends[-1]], ends - ends[0]
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters
    return id_of[np.frombuffer(data.tobytes().decode().encode("utf-16-le"), "<u2")], np.diff(before[ends])


def _id_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        id_of = np.concatenate([[ranks.get(bytes([b]), -1) for b in range(256)], np.arange(LIMIT)]).astype(np.int32)
        flat, lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in batches:
            documents_here = np.array(batch.column("refs").is_valid())
            bounds = [0, *(np.flatnonzero(np.diff(documents_here)) + 1).tolist(), len(documents_here)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                part = batch.slice(a, b - a)
                if a == b:
                    continue
                if documents_here[a]:
                    data, ends = raw_texts(part.column("refs"))
                    refs = data[ends[0] : ends[-1]].view(np.int32)
                    before = np.concatenate([[0], np.cumsum(lengths[refs])])
                    offsets = pa.array(before[(ends - ends[0]) // 4], pa.int32())
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(_gather(flat, np.cumsum(lengths) - lengths, lengths, refs)))], ["doc_id", "ids"])
                    continue
                forget = np.flatnonzero(np.array(part.column("forget").fill_null(False)))
                if len(forget):
                    flat, lengths = flat[:0], lengths[:0]
                    part = part.slice(int(forget[-1]) + 1)
                if part.num_rows:
                    ids, n = _token_ids(part.column("tokens"), id_of)
                    begins = part.column("begins").to_numpy(zero_copy_only=False)
                    # a word may go on in the next batch
                    more = np.add.reduceat(np.concatenate([[0], n]), np.concatenate([[0], np.flatnonzero(begins) + 1]))
                    if more[0]:
                        lengths[-1] += more[0]
                    flat, lengths = np.concatenate([flat, ids]), np.concatenate([lengths, more[1:]])

    return run


def _path(path: str | None) -> str:
    return path or public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) for each row of docs; a null text is empty and has no ids, repeated rows have ids each.

    Every task finds its distinct words, which are folded once each, and puts its documents together from their ids;
    nothing is shuffled. Very long words are cut where no token lies across, so a text of one word takes no longer.
    """
    path = _path(path)
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(text_or_empty()).alias("words"))
    rows = split.mapInArrow(_number_batches(path), ROW)
    folded = F.when(F.col("word").isNotNull(), fold(F.col("word"), F.col("merges"), RankMap(read_ranks(path))))
    return rows.select("doc_id", "forget", "begins", folded.alias("tokens"), "refs").mapInArrow(_id_batches(path), "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of coded and bytes: the binary pieces of its ids, one after another; null ids give null, none gives no bytes."""
    pieces = {rank: token.hex() for token, rank in read_ranks(_path(path)).items()}
    held = F.from_json(F.lit(json.dumps([pieces.get(k) for k in range(max(pieces, default=-1) + 1)])), "array<string>")
    return coded.withColumn("bytes", F.unhex(F.array_join(F.transform("ids", lambda x: F.get(held, x)), "")))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs; a null text is empty, repeated rows stay."""
    coded = decode(encode(docs, path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op3(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return round_trip(documents(spark, sf_dir))
