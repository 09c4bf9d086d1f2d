"""Exact duplicates by composable polynomial fingerprints, confirmed chunk by chunk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, documents, keep_one, materialise, raw_texts, same_row, text_or_empty

#: The prime 2^31 - 1: a byte times a residue stays below 2^39, so 2^16 products fit a 64-bit sum.
PRIME = (1 << 31) - 1
BASES = (1_000_003_577, 1_572_869_213)
CHUNK = 1 << 16
#: Texts of more bytes are hashed in parts of so many.
HUGE = 1 << 23
#: Members of one group that meet one copy of its first text, when groups are confirmed.
MEMBERS = 1000


def powers(base: int, n: int) -> np.ndarray:
    """base^(n-1), ..., base, 1 modulo PRIME, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), PRIME))
        out = np.concatenate([out * step % np.uint64(PRIME), out])
    return out[-n:]


def chunk_hash(data: np.ndarray, weights: np.ndarray) -> int:
    return int((data * weights[len(weights) - len(data) :]).sum() % PRIME) if len(data) else 0


def combine(left: int, right: int, right_length: int, base: int) -> int:
    """The hash of the concatenation: the left hash is shifted by the length of the right part."""
    return (left * pow(base, right_length, PRIME) + right) % PRIME


def polynomial(data: np.ndarray, weights: list[np.ndarray]) -> int:
    """62 bits: two hashes of the bytes, each composed from those of its chunks."""
    parts = []
    for base, weight in zip(BASES, weights, strict=True):
        h = 0
        for at in range(0, len(data), CHUNK):
            piece = data[at : at + CHUNK]
            h = combine(h, chunk_hash(piece.astype(np.uint64), weight), len(piece), base)
        parts.append(h)
    return parts[0] << 31 | parts[1]


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = [powers(base, CHUNK) for base in BASES]
    for batch in batches:
        data, ends = raw_texts(batch.column("text"))
        prints = [polynomial(data[a:b], weights) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_sha256"), pa.array(np.diff(ends), pa.int64()), pa.array(prints, pa.int64())], ["doc_id", "text_sha256", "n_bytes", "print"])


def _part_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = [powers(base, CHUNK) for base in BASES]
    for batch in batches:
        data, ends = raw_texts(batch.column("part"))
        prints = [polynomial(data[a:b], weights) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        high, low = [x >> 31 for x in prints], [x & PRIME for x in prints]
        shifts = [[pow(base, int(n), PRIME) for n in np.diff(ends)] for base in BASES]
        kept = [batch.column(k) for k in ("doc_id", "text_sha256", "n_bytes", "at")]
        yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in (high, low, *shifts))], ["doc_id", "text_sha256", "n_bytes", "at", "high", "low", "high_shift", "low_shift"])


def rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_sha256; a null text is empty. doc_id and text_sha256 name a row, but for its repetitions."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("text_sha256"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, n_bytes, print; a null text counts as empty.

    Texts over HUGE bytes are cut into parts, which are hashed in as many tasks as there are and combined by their
    lengths: as many rows meet as a text has parts.
    """
    every = rows(docs)
    usual = every.filter(F.octet_length("text") <= HUGE).mapInArrow(_hash_batches, "doc_id long, text_sha256 string, n_bytes long, print long")
    huge = every.filter(F.octet_length("text") > HUGE).withColumn("n_bytes", F.octet_length("text").cast("long")).withColumn("bytes", F.col("text").cast("binary"))
    repeats = huge.groupBy("doc_id", "text_sha256", "n_bytes").agg(F.count(F.lit(1)).cast("int").alias("n"))
    parts = huge.withColumn("at", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_bytes") - 1) / HUGE).cast("int")))).withColumn("part", F.expr(f"substring(bytes, at * {HUGE} + 1, {HUGE})"))
    hashed = parts.select("doc_id", "text_sha256", "n_bytes", "at", "part").repartition("text_sha256", "at").mapInArrow(_part_batches, "doc_id long, text_sha256 string, n_bytes long, at int, high long, low long, high_shift long, low_shift long")
    pieces = F.array_sort(F.collect_set(F.struct("at", "high", "low", "high_shift", "low_shift")))
    joined = lambda k: F.aggregate("pieces", F.lit(0).cast("long"), lambda h, x: (h * x[f"{k}_shift"] + x[k]) % F.lit(PRIME))
    combined = hashed.groupBy("doc_id", "text_sha256", "n_bytes").agg(pieces.alias("pieces")).withColumn("print", F.shiftleft(joined("high"), 31).bitwiseOR(joined("low")))
    same = same_row(combined, repeats)
    whole = combined.join(repeats, same).select(combined["doc_id"], combined["text_sha256"], combined["n_bytes"], "print", F.explode(F.array_repeat(F.lit(1), repeats["n"])).alias("_"))
    return usual.union(whole.drop("_"))


def _chunks(texts: DataFrame) -> DataFrame:
    """A row for each chunk of bytes of each text; an empty text has one."""
    return (
        texts.withColumn("_bytes", F.col("text").cast("binary"))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("n_bytes") - 1) / CHUNK).cast("int")))))
        .withColumn("_part", F.expr(f"substring(_bytes, _chunk * {CHUNK} + 1, {CHUNK})"))
        .drop("_bytes", "text")
    )


def _groups(table: DataFrame) -> DataFrame:
    """print, n_bytes, n, keep_id, first (the row with the largest doc_id) of each fingerprint that several rows share.

    Written and merged, so that Spark can split the rows of a large group when they are joined with it.
    """
    first = F.max(F.struct("doc_id", "text_sha256"))
    return materialise(table.groupBy("print", "n_bytes").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"), first.alias("first")).filter("n > 1"), "groups")


def _different(docs: DataFrame, table: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of table whose text differs from the text of their group's first row, compared chunk by chunk.

    A large group meets several copies of its first text, so no task holds a whole group.
    """
    named = table.select("doc_id", "text_sha256", "print", "n_bytes").distinct()
    members = named.join(groups.hint("merge"), ["print", "n_bytes"]).select(*named.columns, "first", F.ceil(F.col("n") / MEMBERS).cast("int").alias("copies"))
    members, texts = materialise(members, "members"), rows(docs)
    own = texts.join(members, same_row(texts, members)).select(texts["doc_id"], texts["text_sha256"], "text", "print", "n_bytes", "first", "copies")
    own = materialise(own.withColumn("is_first", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_sha256") == F.col("first.text_sha256"))), "texts")  # texts are shuffled once
    first = own.filter("is_first").dropDuplicates(["print", "n_bytes"]).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    rest = own.filter("not is_first").withColumn("_copy", F.pmod(F.monotonically_increasing_id(), F.col("copies")).cast("int"))
    left = _chunks(rest.select("doc_id", "text_sha256", "print", "n_bytes", "_copy", "text"))
    right = _chunks(first.select("print", "n_bytes", "_copy", "text")).withColumnRenamed("_part", "_first_part")
    odd = left.join(right, ["print", "n_bytes", "_copy", "_chunk"]).filter("_part != _first_part").select("doc_id", "text_sha256", "print", "n_bytes").distinct()
    odd = materialise(odd, "odd")
    discard(own, members)
    return odd


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, keep_id, group_size (null and null if no other row has the text) for each row of docs."""
    table = materialise(fingerprints(docs), "prints")
    groups, rounds = _groups(table), []
    odd = _different(docs, table, groups)
    if odd.isEmpty():
        joined = table.join(groups.hint("merge"), ["print", "n_bytes"], "left")
        return joined.select("doc_id", "text_sha256", "keep_id", F.col("n").alias("group_size"))
    while not odd.isEmpty():  # equal fingerprints of different texts: those that differ from the first are compared among themselves
        rounds.append(odd.withColumn("variant", F.lit(len(rounds) + 1)))
        odd = _different(docs, odd, _groups(odd))
    later = rounds[0]
    for one in rounds[1:]:
        later = later.union(one)
    later = later.groupBy("doc_id", "text_sha256").agg(F.max("variant").alias("variant"))
    split = table.join(later, same_row(table, later), "left").select(table["*"], F.coalesce("variant", F.lit(0)).alias("variant"))
    keys = ["print", "n_bytes", "variant"]
    groups = materialise(split.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")).filter("group_size > 1"), "groups")
    return split.join(groups.hint("merge"), keys, "left").select("doc_id", "text_sha256", "keep_id", "group_size")


def duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of docs.

    Texts are equal when their bytes are; null is the empty text. Of equal texts the largest doc_id stays. Several
    texts of one doc_id are apart. Rows repeated with the same doc_id and text are one document: all are marked kept if it
    stays. A group without any doc_id has keep_id null and is kept. Equal fingerprints whose chunks differ are split
    into classes of their own. An empty table gives no rows; other columns don't matter.
    """
    return classes(docs).select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def keep_last(docs: DataFrame) -> DataFrame:
    """Of equal texts one row stays, with all its columns: that of the largest doc_id.

    If that row is repeated, or no row of the text has a doc_id, one of the equal rows stays. Null is the empty text.
    """
    kept = duplicates(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    return keep_one(docs, materialise(kept, "kept"))


def op10(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return duplicates(documents(spark, sf_dir))


SQL = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
