"""Licence scans: a classifier on word n-grams for lines and windows of lines, whose finds are compared with templates."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_or_empty

# Statements of common licence families, from public licence texts and notices.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The MIT License (MIT)",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "lgpl": [
        "This library is free software under the terms of the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal public domain dedication.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "SPDX-License-Identifier: EPL-2.0"],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "Licensed under the zlib License.", "SPDX-License-Identifier: Zlib"],
    "boost": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "proprietary": [
        "All rights reserved.",
        "All rights reserved. No part of this work may be reproduced without prior written permission.",
        "This software is proprietary and confidential; unauthorized copying is strictly prohibited.",
    ],
}
NONE, UNKNOWN = "none", "unknown"
#: Lines and windows of the corpus that stand for the class `none`, at most; the rows they come from are those of least hash.
NEGATIVES = 5_000
NEGATIVE_ROWS = 500
#: Lines of such a row and characters of a line that are learned from, and lines of a window. Scans have no such bounds.
NEGATIVE_LINES, NEGATIVE_CHARS, NEGATIVE_WINDOW = 50, 2_000, 3
EPOCHS, RATE, RIDGE = 300, 1.0, 1e-4
TEMPERATURES = (0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0)
#: A paragraph with a probability below this for every family, but likelier a licence than not, is `unknown`.
SURE = 0.4
#: Lines of more words than so many of the longest template are judged by a statement's own words alone.
WIDE = 4
#: Paragraphs whose judgement a task remembers.
REMEMBERED = 20_000
#: Words of a template shingle, and the share of a template's shingles that confirms it.
SHINGLE, SIMILAR = 5, 0.8

_WORD = re.compile(r"\w+")
#: Comment marks that are words; other marks are none.
_COMMENT = re.compile(r"\s*(?:rem|dnl)\b", re.IGNORECASE)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ngrams(found: list[str]) -> set:
    return {*zip(found, found[1:]), *zip(found, found[1:], found[2:])}


def shingles(found: list[str], size: int = SHINGLE) -> set:
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def overlap(found: list[str], template: set) -> float:
    """The share of a template's shingles that a paragraph has; a template of fewer words than SHINGLE is one shingle."""
    return len(shingles(found, len(next(iter(template)))) & template) / len(template)


def variants(template: str) -> list[str]:
    """A statement as it stands, with one of its words gone, in other words' company, and cut at either end."""
    parts = template.split()
    out = [template, f"copyright the authors {template}", f"{template} see the file for details", f"this is a note {template} of the project"]
    out += [" ".join(parts[:i] + parts[i + 1 :]) for i in range(0, len(parts), max(1, len(parts) // 8))]
    if len(parts) > 12:
        out += [" ".join(parts[: len(parts) * 2 // 3]), " ".join(parts[len(parts) // 3 :])]
    return out


@dataclass
class Classifier:
    """Multinomial logistic regression; the weights of an n-gram are a sparse row, most n-grams have none."""

    classes: list[str]
    vocabulary: dict
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[tuple[str, set]]
    seen: dict = field(default_factory=dict)

    def probabilities(self, found: list[str]) -> np.ndarray:
        known = [self.vocabulary[g] for g in ngrams(found) if g in self.vocabulary]
        z = (self.bias + self.weights[known].sum(axis=0)) / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()

    @cached_property
    def blank(self) -> bool:
        """Whether a paragraph without any known n-gram is `none`, as it is unless the corpus had nothing to learn from."""
        return bool(self.probabilities([])[0] >= 0.5)

    @cached_property
    def longest(self) -> int:
        """Words of the longest template."""
        return max(len(words(t)) for some in TEMPLATES.values() for t in some)

    @cached_property
    def index(self) -> dict[int, tuple[set[str], dict]]:
        """By the size of shingles: their first words, and the templates of each shingle."""
        out: dict = {}
        for k, (_, template) in enumerate(self.templates):
            for shingle in template:
                first, by = out.setdefault(len(shingle), (set(), {}))
                first.add(shingle[0])
                by.setdefault(shingle, []).append(k)
        return out

    def judged(self, found: list[str]) -> tuple[str, float, float]:
        """(family, probability, confirmation): `none`, a confirmed family, or else `unknown`.

        Notices of one kind share most of their words. So a family is confirmed only if no other's template is there to a larger share.
        """
        key = tuple(found)
        if key not in self.seen:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[key] = self._judged(found)
        return self.seen[key]

    def _judged(self, found: list[str]) -> tuple[str, float, float]:
        p = self.probabilities(found)
        if p[0] >= 0.5:
            return NONE, 0.0, 0.0
        best = int(p[1:].argmax()) + 1
        shares = self.shares(found)
        near = shares.get(self.classes[best], 0.0)
        if p[best] < SURE or near < SIMILAR or max(shares.values()) > near:
            return UNKNOWN, float(p[best]), near
        return self.classes[best], float(p[best]), near

    def statements(self, found: list[str]) -> list[tuple[int, int]]:
        """(first, last) words of the runs that hold enough of a template's shingles, wherever they are in a paragraph."""
        hits = defaultdict(list)
        for size, (first, by) in self.index.items():
            for at in range(len(found) - size + 1):
                if found[at] in first:
                    shingle = tuple(found[at : at + size])
                    for k in by.get(shingle, ()):
                        hits[k].append((at, shingle))
        out = []
        for k, some in hits.items():
            total, size = len(self.templates[k][1]), len(some[0][1])
            seen: Counter = Counter()
            left = at = 0
            while at < len(some):
                seen[some[at][1]] += 1
                if len(seen) / total >= SIMILAR:
                    while at + 1 < len(some) and some[at + 1][1] not in seen and some[at + 1][0] - some[at][0] <= 2 * size:
                        at += 1
                        seen[some[at][1]] += 1
                    while seen[some[left][1]] > 1:
                        seen[some[left][1]] -= 1
                        left += 1
                    out.append((some[left][0], some[at][0] + size - 1))
                    seen, left = Counter(), at + 1
                at += 1
        return out

    def shares(self, found: list[str]) -> dict[str, float]:
        """For each family the largest share of a template's shingles that the paragraph has, none if it has none."""
        hits: Counter = Counter()
        for size, (_, by) in self.index.items():
            for shingle in by.keys() & zip(*(found[k:] for k in range(size))):
                hits.update(by[shingle])
        out: dict[str, float] = {}
        for k, n in hits.items():
            name, template = self.templates[k]
            out[name] = max(out.get(name, 0.0), n / len(template))
        return out


def fit(negatives: list[str]) -> Classifier:
    """Learns the templates' variants against paragraphs of the corpus that hold no template.

    A first fit leaves every fourth statement out, with all its variants, and every fourth paragraph; the temperature is
    that with which it tells those statements from those paragraphs best. Then all are learned. So a statement that is
    new to the model gets its due probability of being a licence, and is `unknown` if no family is sure.
    """
    templates = [(name, shingles(words(t))) for name, some in TEMPLATES.items() for t in some]
    classes, fold = [NONE, *TEMPLATES], 0
    rows, folds, statements = [(set(), 0)], [0], [0]
    for name, some in TEMPLATES.items():
        for t in some:
            fold += 1
            rows += [(ngrams(words(v)), classes.index(name)) for v in variants(t)]
            folds += [fold] * (len(rows) - len(folds))
            statements += [fold] * (len(rows) - len(statements))
    vocabulary = {g: k for k, g in enumerate(sorted({g for grams, _ in rows for g in grams}, key=str))}
    for k, text in enumerate(negatives):
        found = words(text)
        if not any(overlap(found, t) >= 0.5 for _, t in templates):
            rows.append((ngrams(found), 0))
            folds.append(k)
            statements.append(0)
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for k, (grams, _) in enumerate(rows):
        x[k, [vocabulary[g] for g in grams if g in vocabulary]] = 1
    y = np.eye(len(classes), dtype=np.float32)[[c for _, c in rows]]
    # families count alike, and so do a family's statements, whatever their length; `none` counts as much as all families
    of = np.array(statements)
    share = 1 / np.maximum(np.bincount(of)[of], 1.0)
    for k, some in enumerate(TEMPLATES.values(), start=1):
        share[y[:, k] > 0] /= len(some)
    share[y[:, 0] > 0] = len(TEMPLATES) / max(float(y[:, 0].sum()), 1.0)
    share *= len(rows) / share.sum()
    held = np.array(folds) % 4 == 3
    weights, bias = _descend(x[~held], y[~held], share[~held])
    none, z = y[held, 0] > 0, x[held] @ weights + bias
    losses = {}
    for t in TEMPERATURES:
        p = np.clip(_softmax(z / t)[:, 0].astype(float), 1e-6, 1 - 1e-6)
        losses[t] = -float((np.log(np.where(none, p, 1 - p)) * share[held]).sum())
    return Classifier(classes, vocabulary, *_descend(x, y, share), min(losses, key=losses.get), templates)


def _descend(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    weights, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    step = np.zeros_like(weights)
    for _ in range(EPOCHS):
        wrong = (y - _softmax(x @ weights + bias)) * share[:, None]
        step = 0.9 * step + x.T @ wrong / len(x) - RIDGE * weights
        weights += RATE * step
        bias += RATE * wrong.sum(axis=0) / len(x)
    return weights, bias


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _may_be(found: list[str], model: Classifier) -> bool:
    """Without a known pair of words there is no known n-gram: then the classifier's answer is always the same one."""
    return not model.blank or any(pair in model.vocabulary for pair in zip(found, found[1:]))


def _paragraph(lines: list[list[str]], model: Classifier) -> list[tuple[int, int, str, float, float]]:
    """(first line, last line, family, probability, confirmation) of a paragraph, given the words of its lines."""
    every = [w for line in lines for w in line]
    if not _may_be(every, model):
        return []
    owner = [k for k, line in enumerate(lines) for _ in line]
    joined = lambda i, j: [w for line in lines[i : j + 1] for w in line]
    sure: list = []
    last: dict[str, int] = {}  # by family the last of sure; statements come in order, so only that one can reach a later one
    for a, b in sorted(model.statements(every)):
        i, j = owner[a], owner[b]
        family, p, near = model.judged(joined(i, j)) if sum(map(len, lines[i : j + 1])) <= WIDE * model.longest else (UNKNOWN, 0.0, 0.0)
        if family in (NONE, UNKNOWN):
            family, p, near = model.judged(every[a : b + 1])
        if family in (NONE, UNKNOWN):
            continue
        same = last.get(family)
        if same is None or sure[same][1] < i:
            last[family] = len(sure)
            sure.append((i, j, family, p, near))
        else:
            s = sure[same]
            sure[same] = (min(i, s[0]), max(j, s[1]), family, max(p, s[3]), max(near, s[4]))
    taken = {k for i, j, *_ in sure for k in range(i, j + 1)}
    alone = []
    for k, line in enumerate(lines):
        if k not in taken and _may_be(line, model) and (found := model.judged(line))[0] != NONE:
            if alone and alone[-1][1] == k - 1 and alone[-1][2] == found[0] == UNKNOWN:
                alone[-1] = (alone[-1][0], k, UNKNOWN, max(alone[-1][3], found[1]), max(alone[-1][4], found[2]))
            else:
                alone.append((k, k, *found))
    taken |= {k for i, j, *_ in alone for k in range(i, j + 1)}
    i = 0
    while i < len(lines):
        j, n = i, len(lines[i])
        while i not in taken and j + 1 < len(lines) and j + 1 not in taken and n + len(lines[j + 1]) <= model.longest:
            j += 1
            n += len(lines[j])
        if j > i and _may_be(window := joined(i, j), model) and (found := model.judged(window))[0] != NONE:
            alone.append((i, j, *found))
            i = j
        i += 1
    return sorted(sure + alone)


def scan(text: str, model: Classifier) -> tuple[int, list[tuple[int, int, str, float, float]]]:
    """How many paragraphs there are, and (start, end, family, probability, confirmation) of their lines that aren't `none`.

    A paragraph is a run of lines with a word in them; comment marks aren't words. Its statements are the windows of lines
    that hold enough of a template; of the other lines, single ones and windows as long as a template can be `unknown`.
    """
    n, found, at = 0, [], 0
    spans: list[tuple[int, int]] = []
    lines: list[list[str]] = []
    for line in [*text.split("\n"), ""]:
        mark = _COMMENT.match(line)
        if mine := words(line[mark.end() :] if mark else line):
            spans.append((at, at + len(line)))
            lines.append(mine)
        elif lines:
            n += 1
            found += [(spans[i][0], spans[j][1], *rest) for i, j, *rest in _paragraph(lines, model)]
            spans, lines = [], []
        at += len(line) + 1
    return n, found


SCHEMA = "doc_id long, n_paragraphs long, n_licences long, family string, score double, spans string"


def _scan_batches(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for text in batch.column("text"):
                n, found = scan(text.as_py(), model)
                best = max(found, key=lambda x: (x[2] != UNKNOWN, x[3], -x[0]), default=(0, 0, NONE, 0.0, 0.0))
                for column, value in zip(rows, (n, sum(x[2] != UNKNOWN for x in found), best[2], best[3], ",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in found)), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(rows, kinds, strict=True))], [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def licences(docs: DataFrame, negatives: int = NEGATIVES, rows: int = NEGATIVE_ROWS, lines: int = NEGATIVE_LINES, chars: int = NEGATIVE_CHARS) -> DataFrame:
    """doc_id, n_paragraphs, n_licences, family, score, spans for each row of docs; a null text is empty.

    spans joins family:start:end of licence statements, which are whole lines, in order (code points, end exclusive); family is that of the
    surest confirmed one, `unknown` if only unconfirmed ones are there, else `none` with score 0. Repeated rows have a row each, no
    rows give none; very long texts are scanned whole, in time that grows with their length.
    """
    first = F.transform(F.slice(F.split("text", "\n"), 1, lines), lambda x: F.substring(x, 1, chars))
    windows = F.transform("lines", lambda _, k: F.array_join(F.slice("lines", k + 1, NEGATIVE_WINDOW), "\n"))
    hashed = docs.select(F.xxhash64("doc_id", text_or_empty()).alias("h"), text_or_empty().alias("text"))
    picked = hashed.select("h").distinct().orderBy("h").limit(rows)  # of equal rows one is learned from
    some = hashed.select("h", first.alias("lines")).join(F.broadcast(picked), "h").dropDuplicates(["h"])
    learned = some.select(F.explode(F.concat("lines", windows)).alias("line")).select(F.xxhash64("line").alias("k"), "line").distinct().orderBy("k", "line").limit(negatives)
    model = fit([r["line"] for r in learned.select("line").collect()])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_scan_batches(model), SCHEMA)


def op9(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return licences(documents(spark, sf_dir))
