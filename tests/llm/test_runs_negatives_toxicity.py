"""Periodic runs, hard negatives and toxicity against brute force, on small messy tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest

from retrospect.llm import negatives, queries, runs, toxicity

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, start string, period long, score double, vector string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 1, 0.5, "y") for i, t in rows], DOCUMENTS)


# --- periodic runs ---


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            seg = w[start : start + length]
            if length >= max(24, 3 * q) and not any(all(seg[x] == seg[x + p] for x in range(length - p)) for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    k, w = rng.choice([1, 2, 2, 3, 5]), []
    while len(w) < rng.choice([0, 10, 30, 100, 300]):
        if rng.random() < 0.5:
            block = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 18, 33, 34, 35, 40, 60]))]
            w += (block * rng.randrange(2, 9))[: rng.randrange(1, len(block) * 8)]
        else:
            w += [rng.randrange(k + 3) for _ in range(rng.randrange(1, 20))]
    return w


def test_runs_equal_brute_force():
    rng, found = random.Random(1), 0
    for _ in range(800):
        w = some_words(rng)
        want = brute_runs(w)
        assert runs.find_runs(np.array(w, np.int64)) == want
        assert not want or runs.repeats(np.array(w, np.int64), np.array([0, len(w)]))[0]
        found += len(want)
    assert found > 200


def test_prefilter_keeps_texts_apart():
    """A stretch that two texts share isn't repeated in either."""
    one, two = np.arange(40), np.r_[np.arange(40), np.arange(16), 7]
    ids, starts = np.r_[one, two, one, np.zeros(0, np.int64)], np.array([0, 40, 97, 137, 137])
    assert runs.repeats(ids, starts).tolist() == [False, True, False, False]


def brute_row(doc_id, text):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-math.floor(r[1] * 10**9 / r[2]), r[0], r[2]), default=None)
    gone = {x for s, m, q in found for x in range(s + q, s + m)}
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def test_runs_of_messy_documents(spark):
    rng = random.Random(2)
    texts = [None, "", "  \t\n", "a", "a " * 23, "a " * 24, "a b " * 30, "x\x0by\x0cz\r\n" * 20, "Ünï 😀 " * 40, " ".join(map(str, range(400))) + " tail"]
    texts += [" ".join(map(str, some_words(rng))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, texts[5]), (5, texts[5]), (None, "q " * 50), (None, None), (-20, "word " * 100)]
    got = collections.Counter(tuple(r)[:8] for r in runs.periodic_runs(table(spark, rows), plant=True).collect())
    assert got == collections.Counter(brute_row(i, t) for i, t in rows)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if t)
    assert runs.periodic_runs(table(spark, []), plant=True).collect() == []


def test_runs_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[:8] for r in queries.QUERIES["op13_runs"](spark, small).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if len((r["text"] or "").split()) < 400:
            assert got[r["doc_id"]] == brute_row(r["doc_id"], r["text"])


def test_long_texts_of_runs_take_seconds():
    start = time.time()
    for words in (["a"] * 400_000, ["a", "b"] * 200_000, (["x"] * 20 + ["y"]) * 20_000, [str(i % 50_000) for i in range(400_000)], list("".join(format(k, "b") for k in range(25_000)))):
        assert runs.searched([(None, words)])[0][1] > 0
    assert time.time() - start < 60


def test_collapse_keeps_columns_and_other_texts(spark):
    rows = [(1, "start " + "a b c " * 10 + "end"), (2, "left  as\tit is"), (3, None), (4, "")]
    out = runs.collapse(table(spark, rows))
    assert out.columns == table(spark, []).columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == {1: ("start a b c end", 15), 2: (rows[1][1], 14), 3: (None, None), 4: ("", 0)}


# --- hard negatives ---

EMBEDDINGS = "vec_id long, embedding array<float>, label int, number string, id string, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", "y", 3) for i, v, y in rows], EMBEDDINGS)


def brute_negatives(rows, every=50):
    good = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (y + 1) % 10 if i is not None and i % 7 == 0 else y))
    out = []
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    for i, v, y in good:
        if i is None or i % every:
            continue
        scores = [(sum(a * b for a, b in zip(v, u)), j, z) for j, u, z in good]
        near = sorted(((s, j) for s, j, z in scores if z == y and j != i), key=order)[:5]
        for s, j in near:
            inside = sorted(((t, k) for t, k, z in scores if z != y and 50 * s <= 100 * t <= 95 * s), key=order)[:3]
            out += [(i, j, rank, k, s, t) for rank, (t, k) in enumerate(inside, 1)]
    return collections.Counter(out)


@pytest.mark.parametrize("size", [1 << 20, 40])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, size):
    """Nulls, ties, repeated rows, a hot label and short vectors, in one group and in many."""
    monkeypatch.setattr(negatives, "CANDIDATES", size)
    monkeypatch.setattr(negatives, "ANCHORS", max(1, size // 20))
    rng = np.random.default_rng(3)
    rows = [(k, np.round(rng.normal(size=6), 1).tolist(), int(rng.integers(0, 3)) if k % 3 else 1) for k in range(600)]
    rows += [(k, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], 2) for k in range(600, 640)] + [(700, [0.0] * 6, 1), (750, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], 2)]
    rows += [(800, None, 1), (850, [1.0, None, 1.0], 1), (900, [float("nan"), 1.0], 1), (950, [float("inf"), 1.0], 1), (1000, [1.0, 1.0], None)]
    rows += [(601, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], 2), (601, [1.0, 0.5], 2), (1050, [0.7, -0.3], 1), (1051, [], 1), (None, [0.9, 0.4, 0.1, 0.0, 0.0, 0.0], 1), (None, [0.9, 0.4, 0.1], 2), (-50, [0.2] * 6, 1)]
    rows += [(100, rows[100][1], rows[100][2])]  # an anchor that is there twice
    out = negatives.hard_negatives(vectors(spark, rows))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert collections.Counter(tuple(r) for r in out.collect()) == brute_negatives(rows)


def test_hard_negatives_of_few_rows(spark):
    assert negatives.hard_negatives(vectors(spark, [])).collect() == []
    assert negatives.hard_negatives(vectors(spark, [(50, [1.0], 1)])).collect() == []
    rows = [(50, [1.0], 1), (51, [1.0], 1), (52, [0.7], 2)]
    assert [tuple(r) for r in negatives.hard_negatives(vectors(spark, rows)).collect()] == [(50, 51, 1, 52, 65536, 256 * 179)]


def test_large_components_are_exact(spark):
    rows = [(50, [3e6, 1.0], 1), (51, [3e6, 2.0], 1), (52, [2e6, 5.0], 2), (53, [2e6, 4.0], 2)]
    assert collections.Counter(tuple(r) for r in negatives.hard_negatives(vectors(spark, rows)).collect()) == brute_negatives(rows)


def test_threshold_search_stops_early_and_misses_none():
    rng = np.random.default_rng(4)
    found = scored = 0
    for _ in range(60):
        x = np.floor(rng.normal(size=(500, 4)) * 40)
        lists = negatives.Lists(np.arange(500), x)
        anchor = np.floor(rng.normal(size=4) * 40)
        scores = x @ anchor
        best = negatives.Best(lists.ids, 5)
        scored += negatives.threshold_search(anchor, lists, best)
        assert best.rows.tolist() == sorted(range(500), key=lambda k: (-scores[k], k))[:5]
        top = float(best.scores[0])
        wanted = negatives.Windows(lists.ids, [(-(-50 * int(top) // 100), 95 * int(top) // 100), (10, 5)], 3)
        negatives.threshold_search(anchor, lists, wanted)
        inside = sorted((k for k in range(500) if 50 * top <= 100 * scores[k] <= 95 * top), key=lambda k: (-scores[k], k))[:3]
        assert wanted.best[0].rows.tolist() == inside and not len(wanted.best[1].rows)
        found += len(inside)
    assert found > 100 and scored < 0.7 * 60 * 500


# --- toxicity ---


def brute_passages(scores):
    """Maximal scoring passages by their definition: the best one first, then those to either side of it."""

    def split(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        i, j = -best[2], -best[2] - best[1]
        return [*split(a, i), (i, j - 1, best[0]), *split(j, b)]

    return split(0, len(scores))


def test_passages_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        scores = [rng.choice([-4, -4, -3, -1, 2, 3, 7, 11]) for _ in range(rng.randrange(0, 24))]
        sums = [0, *itertools.accumulate(scores)]
        high = [k for k, s in enumerate(scores) if s > 0]
        got = toxicity.passages(high, [scores[k] for k in high], [sums[k] for k in high])
        assert sorted(s for _, _, s in got) == sorted(s for _, _, s in brute_passages(scores))
        assert all(sum(scores[a : b + 1]) == s for a, b, s in got)


def test_slices_give_the_same_scores(monkeypatch):
    text = " ".join(random.Random(6).choice(["idiot", "stone", "I'm", "Ünïcode", "12", "scum"]) for _ in range(3000)) + "x" * 500
    scores = toxicity.Scores({"idio": 20, "scum$": 15, "xxx": 9})
    whole = toxicity.positives(text, scores)
    monkeypatch.setattr(toxicity, "SLICE", 37)
    sliced = toxicity.positives(text, scores)
    assert whole[:4] == sliced[:4] and whole[4].tolist() == sliced[4].tolist()


def test_rate_solves_its_equation():
    counts = np.zeros(2 * toxicity.HIGHEST + 1)
    zero = toxicity.HIGHEST + toxicity.COST
    counts[zero - 4], counts[zero + 20] = 990, 10
    rate = toxicity.decay(counts)
    assert rate <= 1 / toxicity.UNIT and abs(0.99 * math.exp(-4 * rate) + 0.01 * math.exp(20 * rate) - 1) < 1e-6


BASE = "river stone cloud garden window paper silver morning letter bridge forest lamp table winter summer north".split()


def corpus(seed, n, toxic_words=("idiot", "scum", "moron", "trash")):
    rng, rows, labels = random.Random(seed), [], []
    for k in range(n):
        words = [rng.choice(BASE) + rng.choice(["", "s", "ly", "ing"]) for _ in range(rng.randrange(5, 120))]
        if toxic := k % 6 == 0:
            for _ in range(rng.randrange(2, 5)):
                words[rng.randrange(len(words))] = rng.choice(toxic_words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = corpus(7, 900)
    rows += [(5000, None), (5001, ""), (5002, "12 !!"), (None, "you idiot scum"), (5003, " ".join(BASE) * 3000 + " idiot moron scum trash idiot"), (5003, "Idiot!")]
    marks = spark.createDataFrame([(i, 1, y) for i, y in labels] + [(0, 1, 0), (None, 1, 1), (3, 1, None), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(table(spark, rows), marks)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [(r["score"], dict(labels)[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in dict(labels)]
    ones, zeros = ([s for s, y in held if y == v] for v in (1, 0))
    assert sum(a > b for a in ones for b in zeros) / (len(ones) * len(zeros)) > 0.99
    assert sum(s >= 0.7 for s in ones) / len(ones) > 0.95 and sum(s >= 0.7 for s in zeros) / len(zeros) < 0.02
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    assert {by_id[k][0]["score"] for k in (5000, 5001, 5002)} == {by_id[5000][0]["score"]} and by_id[5000][0]["score"] < 0.5
    assert by_id[None][0]["predicted"] == 1
    long, text = next(r for r in by_id[5003] if r["n_passages"] and len(r["passages"]) and r["passages"].split(":")[0] != "0"), rows[-2][1]
    start, end, _ = long["passages"].split(",")[-1].split(":")
    assert text[int(start) : int(end)] == "idiot moron scum trash idiot"


def test_a_labelled_passage_that_is_copied_does_not_make_its_words_toxic(spark):
    rows, labels = corpus(8, 300)
    copied = "harbour lantern copper valley meadow thunder " * 2
    rows += [(10_000 + k, copied + "idiot scum moron") for k in range(200)]
    labels += [(10_000 + k, 1) for k in range(200)]
    rows += [(20_000, "the lantern of the harbour lies in a copper valley near the meadow")]
    got = toxicity.toxicity(table(spark, rows), spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int"))
    assert got.filter("doc_id = 20000").first()["predicted"] == 0


@pytest.mark.parametrize("labels", [[], [(k, 1) for k in range(40)], [(k, 0) for k in range(40)]])
def test_toxicity_without_labels_of_both_kinds(spark, labels):
    rows, _ = corpus(9, 40)
    marks = spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int")
    got = {round(r["score"], 6) for r in toxicity.toxicity(table(spark, rows), marks).collect()}
    assert got == ({0.5} if not labels else {float(labels[0][1])})
    assert toxicity.toxicity(table(spark, []), marks).collect() == []
