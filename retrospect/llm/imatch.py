"""I-Match document fingerprints: hashes of the distinct mid-frequency terms that lie in several random lexicons."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, text_or_empty

#: The band of inverse document frequency, ln(documents / documents with the term). If a document has d distinct terms on
#: average, at most d x e^UPPER terms are in the lexicon, however many documents there are.
LOWER, UPPER = 3.0, 7.0
#: One in so many terms of the band is in each random lexicon (powers of two). Small lexicons outlast large edits; the
#: first has all terms, as the method has it without random lexicons.
SHARES = (1, *[32] * 3, *[64] * 6, *[128] * 8, *[256] * 9, *[512] * 5)
#: Neighbours by doc_id lie in ranges of about RANGE rows. Beyond RANGES ranges they hold more rows each, which are sorted on
#: disk. Bounds of ranges come from about SAMPLE ids for each: they only balance the ranges, any bounds give the same result.
RANGE, RANGES, SAMPLE = 1000, 65_536, 64
#: The band of idf holds no more terms than this; the lexicon is part of the plan.
LEXICON = 2_000_000
WORD = r"[^\s\p{P}\p{S}]+"


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case words of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, lower: float = LOWER, upper: float = UPPER) -> list[int]:
    """The terms whose document frequency over all rows of docs lies in the band; those of one row only are left out.

    ValueError if they are more than LEXICON, which takes over 1,800 distinct terms a document: then the band is too wide.
    """
    n = docs.count()
    counted = docs.select(F.explode(terms(text_or_empty())).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    band = counted.filter(F.col("n").between(max(2.0, n * math.exp(-upper)), max(2.0, n * math.exp(-lower))))
    found = band.select("term").limit(LEXICON + 1).toArrow()["term"].to_pylist()
    if len(found) > LEXICON:
        raise ValueError(f"more than {LEXICON} terms in the band")
    return found


def in_lexicon(band: list[int]):
    """A test of term hashes against a literal hash set: an array of small buckets."""
    buckets: list[list[int]] = [[] for _ in range(1 << max(1, len(band)).bit_length())]
    for term in sorted(band):
        buckets[term & (len(buckets) - 1)].append(term)
    held = F.from_json(F.lit(json.dumps(buckets)), "array<array<bigint>>")
    return lambda term: F.array_contains(F.get(held, term.bitwiseAND(F.lit(len(buckets) - 1)).cast("int")), term)


def in_random_lexicon(k: int, share: int):
    """A test of term hashes: some of their bits, others for each lexicon, are zero."""
    return lambda term: F.shiftrightunsigned(term, 7 * k % 53).bitwiseAND(F.lit(share - 1)) == 0


def signature(text: Column, band: list[int]) -> Column:
    """The hash of the sorted terms in each random lexicon, null if it has none of them.

    A text without terms in the band is fingerprinted by all that it has.
    """
    inside = in_lexicon(band)

    def hashes(kept: Column) -> Column:
        marks = []
        for k, share in enumerate(SHARES):
            mine = F.filter(kept, in_random_lexicon(k, share)) if share > 1 else kept
            marks.append(F.transform(F.array(mine), lambda m: F.when(F.size(m) > 0, F.xxhash64(m))))
        return F.flatten(F.array(*marks))

    found = F.transform(F.array(terms(text)), lambda all_terms: F.struct(all_terms.alias("all"), F.filter(all_terms, inside).alias("band")))
    kept = F.transform(found, lambda x: F.array_sort(F.when(F.size(x["band"]) > 0, x["band"]).otherwise(x["all"])))
    return F.get(F.transform(kept, hashes), 0)


def readable(marks: Column) -> Column:
    """16 hex digits for each lexicon, joined by dots; nothing for one without terms."""
    return F.array_join(F.transform(marks, lambda m: F.coalesce(F.lower(F.lpad(F.hex(m), 16, "0")), F.lit(""))), ".")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among the lexicons that have terms of either text; 1 if none has."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x == y, F.lit(False))))
    used = F.size(F.filter(pairs, lambda p: p.isNotNull()))
    return F.when(used == 0, F.lit(1.0)).otherwise(F.size(F.filter(pairs, lambda p: p)) / F.greatest(used, F.lit(1))).cast("double")


def id_range(docs: DataFrame) -> Column:
    """The number of doc_id's range: quantiles of sampled ids bound the ranges; null ids are in range -1."""
    rows = max(1, docs.count())
    n = min(RANGES, max(1, rows // RANGE))
    ids = docs.select("doc_id").sample(min(1.0, SAMPLE * n / rows), seed=7)
    bounds = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 20 * n)).first()[0] if n > 1 else []
    held = F.from_json(F.lit(json.dumps(sorted(set(bounds or [])))), "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in range(RANGES.bit_length() - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(held, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(found)


def with_followers(docs: DataFrame) -> DataFrame:
    """Columns range, guest, doc_id, tie, text: each range of ids, and as its guest the first row of the next range.

    The last range has the first row of all as its guest, so every row but guests has the row after it in its range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("range", id_range(rows)).withColumn("guest", F.lit(False))
    firsts = rows.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("head"))
    order = Window.orderBy("range")  # RANGES + 1 rows at most
    hosts = firsts.select("head", F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy())).alias("host"))
    same = rows["doc_id"].eqNullSafe(hosts["head"]["doc_id"]) & (rows["tie"] == hosts["head"]["tie"])
    guests = rows.join(F.broadcast(hosts), same).select("doc_id", "text", "tie", F.col("host").alias("range"), F.lit(True).alias("guest"))
    return rows.unionByName(guests)


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs.

    The edited text has its last quarter of characters replaced by the first as many of the next document. Null texts
    are empty. Next is by ascending doc_id, null first, then by the hash of the text; a lone row is next to itself. Repeated rows are
    each other's neighbours; very long texts are read whole; an empty table gives no rows.
    """
    band = lexicon(docs)
    order = Window.partitionBy("range").orderBy("guest", F.asc_nulls_first("doc_id"), "tie")
    near = with_followers(docs).withColumn("next", F.lead("text").over(order)).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substr(F.coalesce("next", F.lit("")), F.lit(1), cut))
    marked = near.withColumn("edited", edited).withColumn("marks", F.transform(F.array("text", "edited"), lambda t: signature(t, band)))
    marked = marked.select("range", "guest", "doc_id", "tie", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.get("marks", 0).alias("own"), F.get("marks", 1).alias("changed"))
    return (
        marked.withColumn("next", F.lead("own").over(order))
        .filter("not guest")
        .select("doc_id", "n_chars", "edited_sha256", readable(F.col("own")).alias("fingerprint"), readable(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
    )


def op8(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return neighbour_fingerprints(documents(spark, sf_dir))
