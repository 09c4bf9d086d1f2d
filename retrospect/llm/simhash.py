"""SimHash near duplicates: links of close fingerprints by a generalised pigeonhole."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, keep_one, materialise, popcount, raw_texts, text_or_empty
from .components import connected_components

BITS = 64
SHINGLE = 4
SEED = 42
DISTANCE = 4
#: A key with more fingerprints of its own than this is linked through shared neighbours instead of pair by pair.
DENSE = 4096
#: More parts than a plan has.
PARTS = 64
#: Groups up to this size are compared by shifts of the sorted block.
SMALL = 32


def simhash(text: bytes) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no words: zero.

    bytes.lower() folds A-Z alone, and bytes.split() parts at the space and \\x09-\\x0D.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    lasts = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    slices = map(joined.__getitem__, map(slice, starts[:n].tolist(), lasts.tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(SEED)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 14):  # a very long text takes no more memory
        counts += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, ends = raw_texts(batch.column("text"))
        prints = np.fromiter((simhash(data[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_sha256"), pa.array(prints.view(np.int64))], ["doc_id", "text_sha256", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, print (long): one row for each row of docs; a null text counts as empty."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), text.alias("text"))
    return rows.mapInArrow(_hash_batches, "doc_id long, text_sha256 string, print long")


# --- the plan of the search -------------------------------------------------------------------------


def _bit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    together = np.zeros((BITS, BITS), np.int64)
    n = 0
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(prints, axis=1, bitorder="little").astype(np.float32)
        together += (bits.T @ bits).astype(np.int64)
        n += len(bits)
    yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS + 1), pa.int32()), pa.array([*together.ravel().tolist(), n], pa.int64())], ["cell", "n"])


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how often bits i and j are set together: 64 x 64 counts over all of them."""
    cells = prints.select("print").mapInArrow(_bit_batches, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in cells:
        flat[cell] = n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width; each takes in the free bit that correlates most with those it has."""
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs((together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        order = sorted(free)
        group = [max(order, key=lambda b: (correlation[b, order].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            best = max(sorted(free), key=lambda b: (correlation[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def estimate(n: int, together: np.ndarray, group: list[int], radius: int) -> tuple[float, float]:
    """Rows that a part puts out at this radius, and the pairs that meet in it, if its bits were independent."""
    if radius < 0:
        return 0.0, 0.0
    share = np.diag(together)[group] / max(n, 1)
    agree = share**2 + (1 - share) ** 2
    odds = (1 - agree) / agree
    near, variants = [1.0] + [0.0] * radius, [1.0] + [0.0] * radius
    for x in odds:  # elementary symmetric sums: pairs that differ in just k of the bits
        for k in range(radius, 0, -1):
            near[k] += near[k - 1] * x
            variants[k] += variants[k - 1]
    return n * (sum(variants) + (radius > 0)), n * n * float(np.prod(agree)) * sum(near) / 2


def allocate(n: int, together: np.ndarray, groups: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum distance - parts + 1 of the least cost, by dynamic programming over the parts.

    If every part differed in more than t_i bits, the whole would differ in more than `distance`: so no pair is lost.
    """
    cost = {0: (0.0, [])}
    for group in groups:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (so_far, chosen) in cost.items():
            for radius in range(-1, min(distance, 3) + 1):
                rows, pairs = estimate(n, together, group, radius)
                # a row is written, shuffled and sorted; a pair takes one comparison
                total = so_far + 20 * rows + pairs
                if spent + radius not in step or total < step[spent + radius][0]:
                    step[spent + radius] = total, [*chosen, radius]
        cost = step
    return cost.get(distance - len(groups) + 1, (float("inf"), []))


def plan_search(n: int, together: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(mask, threshold) of each part that is probed, for the number of parts that costs least."""
    best: tuple[float, list[tuple[int, int]]] = (float("inf"), [])
    for parts in range(1, min(distance + 2, 8)):
        groups = group_bits(n, together, parts)
        total, radii = allocate(n, together, groups, distance)
        if radii and total < best[0]:
            best = total, [(sum(1 << b for b in g), r) for g, r in zip(groups, radii, strict=True) if r >= 0]
    return best[1]


# --- probing and verifying --------------------------------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(mask: int, radius: int) -> list[int]:
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    return [_signed(sum(some)) for k in range(1, radius + 1) for some in combinations(bits, k)]


def probes(prints: DataFrame, plan: list[tuple[int, int]]) -> DataFrame:
    """part, key, print, owner: each fingerprint under its own key of each part and, as a guest, under the keys near it."""
    rows = None
    for part, (mask, radius) in enumerate(plan):
        own = prints.select(F.lit(part).alias("part"), F.expr(f"print & {_signed(mask)}L").alias("key"), "print", F.lit(True).alias("owner"))
        if flips := _flips(mask, radius):
            near = F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), lambda x: x.bitwiseXOR(F.col("print")).bitwiseAND(F.lit(_signed(mask)).cast("long")))
            own = own.union(prints.select(F.lit(part).alias("part"), F.explode(near).alias("key"), "print", F.lit(False).alias("owner")))
        rows = own if rows is None else rows.union(own)
    return rows


def _link_group(prints: np.ndarray, owner: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that tie one group together as all its close pairs would; a pair needs one owner at least."""
    values, first = np.unique(prints, return_index=True)
    owns = np.zeros(len(values), bool)
    np.logical_or.at(owns, np.searchsorted(values, prints), owner)
    label = np.arange(len(values))
    for i in np.flatnonzero(owns):
        near = popcount(values ^ values[i]) <= distance
        met = np.unique(label[near])
        if len(met) > 1:
            for j in met[1:]:
                label[label == j] = met[0]
    for i in np.flatnonzero(label != np.arange(len(values))):
        yield values[label[i]], values[i]


def link_block(part: np.ndarray, key: np.ndarray, prints: np.ndarray, owner: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of whole groups, whose rows lie together."""
    new = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (key[1:] != key[:-1])]))
    size = np.diff(np.append(new, len(key)))
    group = np.repeat(np.arange(len(new)), size)
    own_size = np.repeat(size, size)
    left, right = [], []
    small = np.flatnonzero(own_size <= SMALL)
    p, g, o = prints[small], group[small], owner[small]
    for shift in range(1, SMALL):
        same = np.flatnonzero(g[:-shift] == g[shift:])
        if not len(same):
            break
        a, b = p[same], p[same + shift]
        hit = (a != b) & (o[same] | o[same + shift]) & (popcount(a ^ b) <= distance)
        left.append(a[hit])
        right.append(b[hit])
    for k in np.flatnonzero(size > SMALL):
        at = slice(new[k], new[k] + size[k])
        if found := list(_link_group(prints[at], owner[at], distance)):
            a, b = np.array(found, np.uint64).T
            left.append(a)
            right.append(b)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _link_batches(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(cut: int) -> pa.RecordBatch:
            a, b = link_block(*(x[:cut] for x in held), distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column("part").to_numpy(zero_copy_only=False), batch.column("key").to_numpy(zero_copy_only=False), batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64), batch.column("owner").to_numpy(zero_copy_only=False)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            part, key = held[:2]
            # the last group may go on in the next batch
            last = np.flatnonzero((part != part[-1]) | (key != key[-1]))
            if len(last):
                yield out(cut := int(last[-1]) + 1)
                held = [x[cut:] for x in held]
        if held is not None:
            yield out(len(held[0]))

    return run


def close_pairs(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: links between distinct fingerprints (column print) that join just those within `distance` bits of a chain.

    Keys that more than DENSE fingerprints own are handled apart: two fingerprints lie within 2r bits just if some value
    lies within r bits of both, so each is put under all values near it and tied to the least there. If a key has more
    guests than that, they are dealt to several copies of its owners. So no task holds more than DENSE owners and about as many
    guests of one key. ValueError for an odd distance.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    n, together = bit_statistics(prints)
    if n < 2:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).filter("false")
    plan = plan_search(n, together, distance)
    rows = probes(prints, plan)
    sizes = rows.groupBy("part", "key").agg(F.count_if("owner").alias("owners"), F.count_if(~F.col("owner")).alias("guests"))
    sizes = materialise(sizes.filter((F.col("owners") > DENSE) | (F.col("guests") > DENSE) & (F.col("owners") > 0)), "crowded")
    dense, visited = sizes.filter(F.col("owners") > DENSE).select("part", "key"), sizes.filter(F.col("owners") <= DENSE)
    crowded = not dense.isEmpty()
    sparse = rows.join(dense.hint("merge"), ["part", "key"], "left_anti") if crowded else rows
    if not visited.isEmpty():
        copies = visited.select("part", "key", F.ceil(F.col("guests") / DENSE).cast("int").alias("copies"))
        dealt = sparse.join(copies.hint("merge"), ["part", "key"], "left")
        copy = F.when(F.col("copies").isNull(), F.array(F.lit(0))).when(F.col("owner"), F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array(F.pmod(F.xxhash64("print"), F.col("copies")).cast("int")))
        sparse = dealt.select("part", "key", "print", "owner", F.explode(copy).alias("copy")).select((F.col("part") + F.col("copy") * PARTS).alias("part"), "key", "print", "owner")
    links = sparse.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(_link_batches(distance), "a long, b long")
    if crowded:
        near = F.array(*[F.lit(x).cast("long") for x in [0, *_flips((1 << BITS) - 1, distance // 2)]])
        held = rows.join(dense.hint("merge"), ["part", "key"], "left_semi").select("print").distinct()
        around = held.select("print", F.explode(near).alias("flip")).select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("at"))
        least = around.groupBy("at").agg(F.min("print").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("at", "a")
        links = links.union(around.join(least, "at").filter("print != a").select("a", F.col("print").alias("b")).distinct())
    return links


def linked(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, text_sha256, print, component (the least fingerprint reachable), component_id for each row of docs."""
    table = materialise(fingerprints(docs), "simhash")
    nodes = materialise(table.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    parts = connected_components(close_pairs(nodes.select("print"), distance))
    # components are of fingerprints; the least doc_id of each follows
    joined = nodes.join(parts, nodes["print"] == parts["node"], "left").select("print", F.coalesce("component", "print").alias("component"), "least")
    joined = materialise(joined, "components")
    least = materialise(joined.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "least")
    where = joined.join(least.hint("merge"), "component", "left").select("print", "component", F.coalesce("component_id", "least").alias("component_id"))
    # written and merged, so that Spark can split the rows of one fingerprint when they are joined with it
    return table.join(materialise(where, "where").hint("merge"), "print")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row for each row of docs.

    Fingerprints within `distance` bits (even) link; component_id is the least doc_id reachable. Null and wordless
    texts have the fingerprint zero and link like any other. A null doc_id takes part in nobody's component_id: its
    row has the component_id of its fingerprint, or null if no row of the component has an id. Repeated rows have a
    row each; an empty table gives none; other columns don't matter.
    """
    return linked(docs, distance).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Of each component one row stays, with all its columns: that of the least doc_id (rows without one come last; ties by the text's hash)."""
    rows = linked(docs, distance)
    sized = rows.groupBy("component", "doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    first = sized.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_sha256", "n")).alias("first"))
    return keep_one(docs, materialise(first.select("first.doc_id", "first.text_sha256", "first.n"), "first"))


def op6(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return near_duplicates(documents(spark, sf_dir))
