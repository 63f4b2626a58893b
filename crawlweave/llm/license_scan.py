"""Licence scans: a trained paragraph classifier names the family, comparison with templates confirms it.

Paragraphs are the lines of a text. What is judged in a line are the places where at least
``AGREEMENT`` of a template's word pairs stand together, whatever the line's length, so that a notice is found whatever
stands before and after it and a line may name several licences. A multinomial logistic regression over sparse word n-grams (one and
two words) names a family or ``unknown``; at a place it also sees ``MARGIN`` words on either side, so that "not released
under" counts. It is trained here, on notices, licence sentences and identifier lines of each family with words dropped, replaced and
added, and, as the unknown class, on paragraphs of the corpus and on sentences that speak of licences and grant none. A temperature fitted
on held-out rows calibrates the probabilities, and the acceptance threshold is the least that only ``FALSE_ALARMS`` of the held-out unknown rows pass, ``HIGHEST`` at most. The
family is the classifier's; templates only confirm it: the words must share ``AGREEMENT`` of their word pairs, or of the template's, with a
template of that very family. Of places that overlap the one that agrees best counts.

Pairs of common words are no features, so a text without any word of the templates is settled by one look at its
words. Null or empty text has no paragraphs. Texts are scanned whole. Training sees at most ``BACKGROUND`` corpus
paragraphs, those of the distinct texts with the least hashes, long ones in windows; it is deterministic.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Corpus paragraphs used as unknown, variants of each row, least shared part of word pairs, rounds and step.
BACKGROUND, VARIANTS, AGREEMENT, ROUNDS, STEP = 2_000, 4, 0.5, 300, 8.0
#: What the unknown class weighs in training, a family being one, and the highest threshold.
UNKNOWN_MASS, HIGHEST = 8, 0.6
#: Share of held-out unknown rows that may pass the threshold before templates are asked.
FALSE_ALARMS = 0.01
#: Words of a window into which a long paragraph of the corpus is cut for training.
WINDOW = 60
#: Family, identifiers in the list of the Linux Foundation, and names of common licences.
NAMES = (
    ("MIT", ("MIT",), ("MIT License",)),
    ("Apache-2.0", ("Apache-2.0",), ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license")),
    ("GPL", ("GPL-3.0-or-later", "GPL-2.0-only"), ("GNU General Public License", "GNU General Public License version 2", "GNU GPL", "GPL 2.0", "GPL 3.0")),
    ("LGPL", ("LGPL-2.1-or-later", "LGPL-3.0-only"), ("GNU Lesser General Public License", "GNU LGPL")),
    ("AGPL", ("AGPL-3.0-only", "AGPL-3.0-or-later"), ("GNU Affero General Public License", "GNU AGPL")),
    ("BSD", ("BSD-3-Clause", "BSD-2-Clause"), ("BSD 3-Clause License", "BSD 2-Clause License", "BSD license")),
    ("MPL-2.0", ("MPL-2.0",), ("Mozilla Public License, version 2.0",)),
    ("ISC", ("ISC",), ("ISC License",)),
    ("EPL-2.0", ("EPL-2.0",), ("Eclipse Public License, Version 2.0", "Eclipse Public License v2.0")),
    ("ECL-2.0", ("ECL-2.0",), ("Educational Community License, Version 2.0",)),
    ("OFL-1.1", ("OFL-1.1",), ("SIL Open Font License, Version 1.1", "Open Font License")),
    ("CC-BY", ("CC-BY-4.0",), ("Creative Commons Attribution 4.0 International License", "CC BY 4.0")),
    ("CC-BY-SA", ("CC-BY-SA-4.0",), ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0")),
    ("CC-BY-ND", ("CC-BY-ND-4.0",), ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0")),
    ("CC-BY-NC", ("CC-BY-NC-4.0",), ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0")),
    ("CC-BY-NC-SA", ("CC-BY-NC-SA-4.0",), ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA 4.0")),
    ("CC-BY-NC-ND", ("CC-BY-NC-ND-4.0",), ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC BY-NC-ND 4.0")),
    ("CC0", ("CC0-1.0",), ("CC0 1.0 Universal",)),
    ("Unlicense", ("Unlicense",), ("The Unlicense",)),
)
#: Characteristic sentences of licence texts and of the notices that they ask for.
SENTENCES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0"),
    ("ECL-2.0", "Licensed under the Educational Community License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: What may stand around a name that grants, and around one that does not.
GRANTS = (
    "{}", "Released under the {}.", "Licensed under the {}.", "This work is licensed under a {}.", "This project is licensed under the terms of the {}.",
    "Distributed under the {}, see the file", "or the {}", "Licensed under {}", "available under either the {} or", "License: {}", "under the {} at your option", "is covered by the {}", "published under {}",
    "may be reused under the {}", "you may copy and change it under the {}", "made available under a {}", "are {} unless noted",
)
NO_GRANTS = (
    "was not released under the {}", "is not licensed under the {}", "never published under the {}", "has never been licensed under the {}", "it never was under the {}", "the history of the {} is long", "no longer licensed under the {}", "a talk about the {} and its history",
    "the {} was written by", "how does the {} differ from others", "instead of the {} they chose", "we compared the {} with", "not under the {}", "isn t licensed under the {}",
)
#: Sentences with the words of licences that grant nothing.
NO_LICENCES = (
    "The driver lost the license after the third offence.", "You need permission to enter the building.",
    "The general public was free to use the library.", "A new version of the program was released in May.",
    "The terms of the agreement were published by the foundation.", "All rights to this work remain with the author.",
    "She copied the source code of the file.", "The city sells a fishing license for four dollars.",
)
#: What confirms a family: its names, its identifier lines and its sentences.
TEMPLATES = (
    *((family, name) for family, _, names in NAMES for name in names),
    *((family, f"SPDX-License-Identifier: {i}") for family, ids, _ in NAMES for i in ids), *SENTENCES,
)
COMMON = frozenset("a an and any are as at be by can for from in is it its may of on or that the this to under was with you".split())
#: Words beside a place that the classifier sees on each side.
MARGIN = 6
UNKNOWN = "unknown"
_WORD = re.compile(r"[a-z0-9]+")


def _words(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def _pairs(found: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(found, found[1:]) if not (a in COMMON and b in COMMON)}


def _features(found: list[str]) -> set[str]:
    return {w for w in found if w not in COMMON} | _pairs(found)


@dataclass
class Model:
    """Weights by feature, families, bias, temperature and acceptance threshold."""

    families: list[str]
    index: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5

    def probabilities(self, found: list[str]) -> np.ndarray:
        features = _features(found)
        known = [self.index[f] for f in features if f in self.index]
        z = (self.weights[known].sum(axis=0) / max(1.0, len(features)) ** 0.5 + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def __post_init__(self) -> None:
        self.templates = [(family, _pairs(_words(text))) for family, text in TEMPLATES]
        self.lengths = [len(_words(text)) for _, text in TEMPLATES]
        self.holders: dict[str, dict[str, list[int]]] = {}
        for t, (_, pairs) in enumerate(self.templates):
            for a, b in map(str.split, pairs):
                self.holders.setdefault(a, {}).setdefault(b, []).append(t)
        self.anchors = {w for _, text in TEMPLATES for w in _words(text) if w not in COMMON}

    def agreement(self, found: list[str], family: str) -> tuple[float, int]:
        """The largest shared part of word pairs with a template of the family, and the most pairs shared."""
        pairs = _pairs(found)
        shared = [(len(pairs & t), min(len(pairs), len(t))) for f, t in self.templates if f == family]
        return max((n / max(1, of) for n, of in shared), default=0.0), max((n for n, _ in shared), default=0)

    def family(self, paragraph: str) -> str | None:
        """The licence family of a paragraph, or none."""
        found = _words(paragraph)
        return self._judged(found, 0, len(found))[-1]

    def _judged(self, found: list[str], a: int, b: int, low: int = 0, high: int | None = None) -> tuple[float, int, str | None]:
        """Agreement, shared pairs and licence family of the words from ``a`` to ``b``, or none; words beside them count from ``low`` to ``high``."""
        if self.anchors.isdisjoint(found[a:b]):
            return 0.0, 0, None
        p = self.probabilities(found[max(low, a - MARGIN) : min(len(found) if high is None else high, b + MARGIN)])
        likely = int(p.argmax())
        if self.families[likely] == UNKNOWN or p[likely] < self.threshold:
            return 0.0, 0, None
        agree, shared = self.agreement(found[a:b], self.families[likely])
        return agree, shared, self.families[likely] if agree >= AGREEMENT else None

    def _places(self, found: list[str]) -> set[tuple[int, int]]:
        """Stretches of words that hold enough of one template's word pairs."""
        hits: dict[int, list[tuple[int, str]]] = {}
        for i in range(len(found) - 1):
            after = self.holders.get(found[i])
            if after:
                for t in after.get(found[i + 1], ()):
                    hits.setdefault(t, []).append((i, found[i + 1]))
        places = set()
        for t, at in hits.items():
            least = AGREEMENT * len(self.templates[t][1])
            reach, first, held = self.lengths[t] + MARGIN, 0, Counter()
            groups: list[list[int]] = []
            for i, b in at:
                held[found[i], b] += 1
                while i + 2 - at[first][0] > reach:
                    gone = found[at[first][0]], at[first][1]
                    held[gone] -= 1
                    if not held[gone]:
                        del held[gone]
                    first += 1
                if len(held) >= least:
                    start, end = at[first][0], i + 2
                    if groups and groups[-1][0] == start:
                        groups[-1][1] = end
                    else:
                        groups.append([start, end])
            places.update((a, b) for a, b in groups)
        return places

    def families_in(self, line: str) -> list[str]:
        """The licence families in one line, in order; where places overlap, the one that agrees best with its template."""
        found = _words(line)
        if self.anchors.isdisjoint(found):
            return []
        places = self._places(found)
        judged = []
        for a, b in places:
            # words of another place speak for that one
            low = max((d for c, d in places if d <= a), default=0)
            high = min((c for c, d in places if c >= b), default=len(found))
            agree, shared, family = self._judged(found, a, b, low, high)
            if family:
                judged.append((-shared, -agree, b - a, a, b, family))
        chosen: list[tuple[int, int, str]] = []
        for *_, a, b, family in sorted(judged):
            if all(b <= c or d <= a for c, d, _ in chosen):
                chosen.append((a, b, family))
        return list(dict.fromkeys(family for _, _, family in sorted(chosen)))

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str]]]:
        """Paragraphs that have a word, and (line, family) of each licence in them."""
        lines = text.split("\n") if text else []
        n = sum(1 for line in lines if line.strip())
        if not text or self.anchors.isdisjoint(_words(text)):
            return n, []
        return n, [(i, f) for i, line in enumerate(lines) for f in self.families_in(line)]


def train(background: list[str]) -> Model:
    """A model from the templates and from paragraphs that stand for everything else."""
    draw = np.random.default_rng(7)
    other = [w for w in map(_words, background) if w]
    filler = sorted({w for words in other for w in words})[:5000] or ["x"]
    rows: list[tuple[str, list[str]]] = []

    def around(words: list[str], most: int) -> list[str]:
        before, after = ([filler[i] for i in draw.integers(len(filler), size=draw.integers(0, most))] for _ in range(2))
        return before + words + after

    said = [(family, grant.format(name)) for family, _, names in NAMES for name in names for grant in GRANTS]
    said += [x for x in TEMPLATES if x[1].startswith("SPDX")] * 6 + list(SENTENCES) * 8
    for family, text in said:
        base = _words(text)
        rows.append((family, base))
        for _ in range(VARIANTS):
            # names stay whole, long sentences lose and change some words
            kept = base if len(base) < 16 else [w if draw.random() > 0.05 else filler[draw.integers(len(filler))] for w in base if draw.random() > 0.1]
            rows.append((family, around(kept, MARGIN + 1)))
    places = [other[i] for i in draw.integers(len(other), size=2 * len(said))] if other else []
    for (family, text), context in zip(said * 2, places):  # a place is seen with the words beside it
        rows.append((family, context[-MARGIN:] + _words(text) + context[:MARGIN]))
    templates = [_pairs(_words(text)) for _, text in TEMPLATES]
    for found in other:
        pairs = _pairs(found)
        if not any(pairs and len(pairs & t) >= AGREEMENT * min(len(pairs), len(t)) for t in templates):
            rows.append((UNKNOWN, found))
    for _, _, names in NAMES:
        for name in names:
            rows += [(UNKNOWN, around(_words(text.format(name)), 4)) for text in NO_GRANTS for _ in range(VARIANTS)]
    rows += [(UNKNOWN, _words(text)) for text in NO_LICENCES] * 10
    families = sorted({f for f, _ in rows} | {UNKNOWN})
    told = [text for _, text in said] + [text.format(name) for _, _, names in NAMES for name in names for text in NO_GRANTS] + list(NO_LICENCES)
    features = sorted({x for text in told for x in _features(_words(text))})
    index = {f: i for i, f in enumerate(features)}
    x = np.zeros((len(rows), len(index)), np.float32)
    for r, (_, found) in enumerate(rows):
        own = _features(found)
        for f in own:
            if f in index:
                x[r, index[f]] = 1 / len(own) ** 0.5
    y = np.array([families.index(f) for f, _ in rows])
    held = draw.random(len(rows)) < 0.25
    target = np.eye(len(families), dtype=np.float32)[y]
    share = np.bincount(y[~held], minlength=len(families)) / max(1, (~held).sum())
    mass = np.where(np.array(families) == UNKNOWN, UNKNOWN_MASS, 1)
    balance = (mass / np.maximum(share, 1e-3))[y[~held], None].astype(np.float32)
    balance /= balance.mean()
    weights, bias = np.zeros((len(index), len(families)), np.float32), np.zeros(len(families), np.float32)
    for _ in range(ROUNDS):
        z = x[~held] @ weights + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        slope = (p / p.sum(axis=1, keepdims=True) - target[~held]) * balance / len(balance)
        weights -= STEP * (x[~held].T @ slope + 1e-5 * weights)
        bias -= STEP * slope.sum(axis=0)
    model = Model(families, index, weights, bias)
    z = x[held] @ weights + bias
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.1, 5, 30):
        s = z / temperature
        loss = float(np.mean(np.log(np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)) - (s - s.max(axis=1, keepdims=True))[np.arange(len(s)), y[held]])) if len(s) else 0.0
        best = min(best, (loss, float(temperature)))
    model.temperature = best[1]
    unknown = families.index(UNKNOWN)
    p = np.exp((z - z.max(axis=1, keepdims=True)) / model.temperature)
    p = p / p.sum(axis=1, keepdims=True)
    p[:, unknown] = 0
    wrong = p[y[held] == unknown].max(axis=1) if (y[held] == unknown).any() else np.zeros(1)
    model.threshold = float(min(HIGHEST, max(0.3, np.quantile(wrong, 1 - FALSE_ALARMS) + 1e-6)))
    return model


def learn(docs: DataFrame, text: str = "text") -> Model:
    """A model whose unknown class is drawn from the documents with the least hashes."""
    hashed = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("_h"), text)
    last = hashed.select("_h").distinct().orderBy("_h").limit(BACKGROUND // 4).agg(F.max("_h")).first()[0]
    if last is None:
        return train([])
    texts = hashed.where(F.col("_h") <= last).dropDuplicates(["_h"])
    lines = texts.select(F.explode(F.split(text, "\n")).alias("line")).distinct()
    rows = lines.orderBy(F.xxhash64("line"), "line").limit(BACKGROUND).select("line").collect()
    windows = [" ".join(w[i : i + WINDOW]) for w in (r.line.split() for r in rows) for i in range(0, max(1, len(w)), WINDOW)]
    return train(windows[:BACKGROUND])


def scan(text: str | Column, model: Model) -> Column:
    """``n`` (paragraphs with a word) and ``found`` (line number and family of each licence in a paragraph)."""

    @F.arrow_udf("struct<n:bigint,found:array<struct<line:bigint,family:string>>>")
    def run(texts: pa.Array) -> pa.Array:
        made = [model.scan(t.as_py()) for t in texts]
        rows = [{"n": n, "found": [{"line": i, "family": f} for i, f in found]} for n, found in made]
        return pa.array(rows, pa.struct([("n", pa.int64()), ("found", pa.list_(pa.struct([("line", pa.int64()), ("family", pa.string())])))]))

    return run(text)
