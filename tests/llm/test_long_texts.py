"""Texts that are long or made of little else than white space, secrets or licence statements."""

import functools
import random
import time
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest

from retrospect.llm import licences, packing, secrets

WORDS = "the of to and river stone cloud garden window paper silver morning letter bridge forest lamp".split()


@functools.lru_cache(maxsize=1)
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


WHITE = [f"a{filler}x" for filler in (" " * 1_000_000, "\n" * 1_000_000, "\t " * 500_000, " \n" * 1_000_000)] + [" " * 1_200_000, "<|endoftext|>" + " " * 1_000_000]


def test_packing_of_long_white_space(spark):
    rows = [(k, t) for k, t in enumerate(WHITE)] + [(100, "short text")]
    got = {}
    for r in packing.pack(packing.pieces(spark.createDataFrame(rows, "doc_id long, text string"))).collect():
        got.setdefault(r["doc_id"], {})[r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    for k, text in rows:
        ids = np.array([*reference().encode(text, add_special_tokens=False).ids, packing.END], "<u4")
        assert got[k] == {n: (start, size, zlib.crc32(ids[start : start + size])) for n, (start, size) in enumerate(packing.cut(len(ids), packing.LENGTH))}


def test_pipeline_of_long_white_space(spark, tmp_path):
    rows = [(k, f"{t} word{k} of a text", "en", "s", len(t)) for k, t in enumerate(WHITE)] + [(50 + k, " ".join(random.Random(k).choices(WORDS, k=60)), "en", "s", 9) for k in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()
    assert {r["doc_id"] for r in out} >= {50 + k for k in range(12)} and any(r["doc_id"] < 50 for r in out)


# --- secrets ---


def brute_overlaps(text, scanner):
    """Whether any two spans of a novel and another kind overlap, by all pairs."""
    base, spans = scanner.scan(text)
    novel = [(a, b) for a, kind, b in spans if kind == 3]
    return any(a < e and s < b for a, b in novel for s, _, e in base) or any(x != y and x[0] < y[1] and y[0] < x[1] for x in novel for y in novel)


def secret_lines(rng, n):
    kinds = ['password = "{:016x}"', "bearer: {:032X}q", "secret_key={:024x}Zz", "token={:020x}&signature={:x}", "nothing to see here {}"]
    return "\n".join(rng.choice(kinds).format(rng.getrandbits(90), rng.getrandbits(128)) for _ in range(n))


def test_novel_spans_overlap_nothing():
    scanner = secrets.Scanner()
    for seed in range(20):
        assert not brute_overlaps(secret_lines(random.Random(seed), 60), scanner)


def test_taken_equals_all_pairs():
    rng = random.Random(3)
    for _ in range(300):
        spans = [(a, a + rng.randrange(1, 9)) for a in (rng.randrange(60) for _ in range(rng.randrange(0, 9)))]
        taken = secrets.Taken(spans)
        for start in range(70):
            assert taken.overlap(start, start + 3) == any(s < start + 3 and start < e for s, e in spans)


def test_secrets_of_a_long_text_take_seconds():
    scanner, text = secrets.Scanner(), secret_lines(random.Random(4), 80_000)
    start = time.time()
    base, spans = scanner.scan(text)
    scanner.measured(text, spans)
    assert time.time() - start < 90 and len(spans) > 60_000


# --- licences ---


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return licences.fit([" ".join(rng.choices(WORDS, k=20)) for _ in range(500)])


GNU = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
CC = "This work is licensed under the Creative Commons {} 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/{}/4.0/ or send a letter to Creative Commons."
NOTICES = {
    "agpl-3.0": [GNU.format("program", "Affero General Public License", 3)],
    "gpl-3.0": [GNU.format("program", "General Public License", 3), GNU.format("program", "General Public License", 3).replace("(at your option) ", "")],
    "gpl-2.0": [GNU.format("program", "General Public License", 2)],
    "lgpl": [GNU.format("library", "Lesser General Public License", "2.1"), GNU.format("program", "Lesser General Public License", 3)],
    "cc-by": [CC.format("Attribution", "by")],
    "cc-by-sa": [CC.format("Attribution-ShareAlike", "by-sa"), "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": [CC.format("Attribution-NonCommercial", "by-nc")],
}
SPDX = {
    "mit": "MIT", "apache-2.0": "Apache-2.0", "gpl-3.0": "GPL-3.0-only GPL-3.0-or-later", "gpl-2.0": "GPL-2.0-only GPL-2.0-or-later", "lgpl": "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later",
    "agpl-3.0": "AGPL-3.0-only AGPL-3.0-or-later", "bsd": "BSD-2-Clause BSD-3-Clause", "mpl-2.0": "MPL-2.0", "cc-by": "CC-BY-4.0", "cc-by-sa": "CC-BY-SA-4.0", "cc-by-nc": "CC-BY-NC-4.0", "cc0": "CC0-1.0", "isc": "ISC",
    "unlicense": "Unlicense", "epl-2.0": "EPL-2.0", "zlib": "Zlib", "boost": "BSL-1.0",
}


def families(text, model):
    return [x[2] for x in licences.scan(text, model)[1]]


def test_notices_of_like_licences_are_told_apart(model):
    for family, notices in NOTICES.items():
        for notice in notices:
            assert families(notice, model) == [family], notice
            parts = notice.split()
            wrapped = "\n".join("# " + " ".join(parts[k : k + 9]) for k in range(0, len(parts), 9))
            assert set(families(wrapped, model)) - {licences.UNKNOWN} == {family}, wrapped


def test_spdx_identifiers(model):
    for family, ids in SPDX.items():
        for x in ids.split():
            assert families(f"// SPDX-License-Identifier: {x}", model) == [family], x
    assert set(families("SPDX-License-Identifier: LicenseRef-Our-Own", model)) <= {licences.UNKNOWN}


def brute_shares(found, model):
    """The largest share of each family's templates by whole sets of shingles."""
    out = {}
    for name, template in model.templates:
        size = len(next(iter(template)))
        have = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}
        if share := len(have & template) / len(template):
            out[name] = max(out.get(name, 0), share)
    return out


def brute_probabilities(found, model):
    """Dense logistic regression over all n-grams of the vocabulary."""
    x = np.zeros(len(model.vocabulary))
    for n in (2, 3):
        for k in range(len(found) - n + 1):
            if (g := tuple(found[k : k + n])) in model.vocabulary:
                x[model.vocabulary[g]] = 1
    z = (x @ model.weights + model.bias) / model.temperature
    return np.exp(z) / np.exp(z).sum()


def test_scoring_equals_brute_force(model):
    rng = random.Random(5)
    statements = [t for some in licences.TEMPLATES.values() for t in some]
    for _ in range(150):
        found = licences.words(" ".join(rng.choice(statements) if rng.random() < 0.5 else " ".join(rng.choices(WORDS, k=6)) for _ in range(rng.randrange(0, 4))))
        if len(found) > 12 and rng.random() < 0.5:
            del found[rng.randrange(len(found))]
        p, shares = brute_probabilities(found, model), brute_shares(found, model)
        assert np.allclose(model.probabilities(found), p, atol=1e-4) and model.shares(found) == pytest.approx(shares)
        best = model.classes[1 + int(p[1:].argmax())]
        near = shares.get(best, 0)
        sure = p[1:].max() >= licences.SURE and near >= licences.SIMILAR and near >= max(shares.values(), default=0)
        first, second = np.sort(p[1:])[::-1][:2]
        if abs(p[0] - 0.5) > 1e-3 and abs(first - licences.SURE) > 1e-3 and first - second > 1e-3:
            assert model.judged(found)[0] == (licences.NONE if p[0] >= 0.5 else best if sure else licences.UNKNOWN)


def test_planted_notices_are_found(model):
    """Statements in other company, wrapped, commented and in capitals: nine of ten at least, and none in prose."""
    rng, right, all_ = random.Random(6), 0, 0
    for family, some in licences.TEMPLATES.items():
        for statement in some + NOTICES.get(family, []):
            for shape in range(4):
                body = statement.upper() if shape == 1 else statement
                parts = body.split()
                lines = [body] if shape < 2 else [" ".join(parts[k : k + 8]) for k in range(0, len(parts), 8)]
                lines = ["    // " + x for x in lines] if shape == 3 else lines
                text = "\n".join([" ".join(rng.choices(WORDS, k=30)), "", *lines, "", " ".join(rng.choices(WORDS, k=30))])
                right += family in families(text, model)
                all_ += 1
    assert right / all_ >= 0.9
    assert not any(families(" ".join(rng.choices(WORDS, k=80)), model) for _ in range(200))


def test_licences_of_a_long_text_take_time_in_proportion(model):
    statements = [t for some in licences.TEMPLATES.values() for t in some]
    rng, took = random.Random(7), {}
    for n in (5_000, 20_000):
        for join in ("\n", " "):
            start = time.time()
            assert licences.scan(join.join(rng.choices(statements, k=n)), model)[1]
            took[n, join] = time.time() - start
    assert all(took[20_000, join] < 8 * took[5_000, join] + 2 for join in ("\n", " ")) and sum(took.values()) < 120


def test_equal_rows_are_learned_from_once(spark):
    """A row that fills the table doesn't make the rows learned from more than their number."""
    rows = [(None, "Licensed under nobody's terms at all.\nplain words") for _ in range(3000)] + [(k, " ".join(random.Random(k).choices(WORDS, k=25))) for k in range(200)]
    got = licences.licences(spark.createDataFrame(rows, "doc_id long, text string"), rows=50).collect()
    assert len(got) == len(rows) and len({(r["family"], r["score"], r["spans"]) for r in got if r["doc_id"] is None}) == 1
