"""Licence notices in texts: a trained paragraph classifier, confirmed by comparison with templates.

Each line is a paragraph, and so are neighbouring lines over which a notice is wrapped. A sparse
logistic regression over its words, word pairs and word triples says which licence family it names,
or none, or that it is a notice of no known family; it is trained in numpy on variations of the
templates and on ordinary lines from a bounded sample of documents. All classes compete; the
likeliest family counts if its calibrated probability is high enough and a template of that family
agrees with the paragraph word by word; what looks like a notice otherwise is 'unknown'. The
temperature and the bound come from models that were trained without some templates, whole
families among them, and are asked about these; the bound is where families that a template
confirms are nearly all right.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import sampled
from gridspark.llm.text_hash import LOWER, NOT_ALNUM, U, Words, bytes_of, mix, runs, words

# What notices of each family say.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": ("This library is licensed under the GNU Lesser General Public License, version 2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "AGPL": ("This program is licensed under the GNU Affero General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: AGPL-3.0-only"),
    "BSD": (
        "Distributed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/", "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC0": ("Released under CC0 1.0 Universal", "To the extent possible under law, the author has dedicated this work to the public domain"),
    "ISC": ("Released under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "Unlicense": ("This is free and unencumbered software released into the public domain", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose", "SPDX-License-Identifier: Unlicense"),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0", "SPDX-License-Identifier: BSL-1.0"),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software", "SPDX-License-Identifier: Zlib"),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "SPDX-License-Identifier: EPL-2.0"),
}
# Notices of no family above, and ordinary uses of the same words.
OTHER_NOTICES = ("All rights reserved. No licence is granted.", "Licensed under the terms of our proprietary licence agreement.", "Released under the Example Public License, version 7.", "This software is licensed, not sold.", "Subject to the terms of the Acme Community License 2.1", "Use of this material is governed by a commercial license.")
ORDINARY = ("He lost his driver's license last year.", "The license plate was found near the river.", "Permission to enter is granted at the gate.", "The new version of the public library is free for any person.", "She studied at MIT and later released a record.", "The general public was not permitted to copy the notes.", "The work is free of charge and open to all.")
NONE, UNKNOWN = "none", "unknown"
BUCKETS_LOG2, EPOCHS = 16, 6
#: Ordinary lines and documents sampled for training, about.
LINES, DOCUMENTS = 3000, 300
#: Parts in which templates, families and lines are left out for calibration, and the share of notices above the bound that have to be right.
FOLDS, RIGHT = 3, 0.95
#: Least share of a template's word pairs in the paragraph that confirms its family; in a paragraph over several lines
#: they stand within so many times the template's words.
AGREES, STRETCH = 0.6, 2
_NOTICE_WORDS = re.compile(rb"licen[cs]|permission|redistribut|domain|cc0")
_LEADER = re.compile(r"\s*(?:(?:/\*+|\*+|//+|#+|--+|;+|%+|!+|<!--|>+|\||\(\*|dnl\b|rem\b|\.\\\")\s*)*", re.I)
_FACTORS = np.random.Generator(np.random.PCG64(23)).integers(1, 2**63, 3, dtype=np.uint64) | U(1)
_SEPARATORS = NOT_ALNUM.copy()


def line_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all lines of a run of texts, without the line feeds' effect on words, and each one's text."""
    begin = int(offsets[0])
    feeds = np.flatnonzero(data[begin : int(offsets[-1])] == 10) + begin + 1
    bounds = np.concatenate([offsets[:-1], feeds])
    order = np.argsort(bounds, kind="stable")
    bounds = bounds[order]
    doc = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds - 1, side="right") - 1])[order]
    return np.append(bounds, offsets[-1]), doc


def grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words, pairs and triples of each line, and their lines."""
    buckets, lines = [], []
    n = len(w.hashes)
    for size in (1, 2, 3):
        m = max(0, n - size + 1)
        total = np.zeros(m, U)
        for j in range(size if m else 0):
            total += w.hashes[j : j + m] * _FACTORS[j]
        at = np.flatnonzero(w.doc[:m] == w.doc[size - 1 :][:m]) if m else np.zeros(0, np.int64)
        buckets.append((mix(total[at] + U(size)) >> U(64 - BUCKETS_LOG2)).astype(np.int64))
        lines.append(w.doc[at])
    return np.concatenate(buckets), np.concatenate(lines)


@dataclass
class Model:
    families: list[str]  # none first, then unknown
    weights: np.ndarray  # bucket, family; rows of zeros for most buckets
    bias: np.ndarray
    used: np.ndarray  # buckets with weights
    temperature: float = 1.0
    least: float = 0.0  # probability from which a family counts

    def evidence(self, w: Words) -> np.ndarray:
        """For each family and line, divided by the root of the line's number of n-grams."""
        buckets, lines = grams(w)
        n = len(w.first) - 1
        totals = np.maximum(np.bincount(lines, minlength=n), 1)
        some = self.used[buckets]
        buckets, lines = buckets[some], lines[some]
        z = np.tile(self.bias, (n, 1))
        order = np.argsort(lines, kind="stable")
        buckets, lines = buckets[order], lines[order]
        if len(lines):
            first = np.flatnonzero(np.concatenate([[True], lines[1:] != lines[:-1]]))
            at = lines[first]
            z[at] += np.add.reduceat(self.weights[buckets], first, axis=0) / np.sqrt(totals[at])[:, None]
        return z

    def probabilities(self, w: Words) -> np.ndarray:
        return _softmax(self.evidence(w), self.temperature)


def _softmax(z: np.ndarray, temperature: float) -> np.ndarray:
    z = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
    return z / z.sum(axis=1, keepdims=True)


def _words_of(lines: list[str]) -> Words:
    whole = [x.encode() for x in lines]
    return words(np.frombuffer(b"".join(whole), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in whole])]).astype(np.int64), _SEPARATORS)


@dataclass
class Line:
    """A line to learn from: its class, and the template or other text that it varies, if any."""

    text: str
    label: str
    source: tuple[str, int] | None = None


def examples(ordinary: list[str], each: int, seed: int = 4) -> list[Line]:
    """Variations of the templates, each of these families so often, of other notices, and lines that name no licence."""
    rng = np.random.default_rng(seed)
    vocabulary = [w for x in ordinary[:500] for w in x.split()[:50]] or "the of and to in a".split()

    say = lambda n, least=0: " ".join(vocabulary[i] for i in rng.integers(0, len(vocabulary), int(rng.integers(least, n))))

    def vary(text: str) -> str:
        text = text if rng.random() < 0.7 else text.lower() if rng.random() < 0.5 else text.upper()
        before = ("", "", f"{say(6)} ", f"Copyright (c) {int(rng.integers(1990, 2026))} {say(4)}. ", "# ", " * ", "// ")[int(rng.integers(0, 7))]
        return f"{before}{text}{('', '.', f'. {say(10)}', f' {say(6)}')[int(rng.integers(0, 4))]}"

    out = []
    sources = [*TEMPLATES.items(), (UNKNOWN, OTHER_NOTICES), (NONE, ORDINARY)]
    for label, texts in sources:
        for _ in range(each if label in TEMPLATES else 5 * each // 2):
            i = int(rng.integers(0, len(texts)))
            out.append(Line(vary(texts[i]), label, (label, i)))
    out += [Line(say(12, 1), NONE) for _ in range(10 * each)]  # what stands around notices is none by itself
    return out + [Line(x, NONE) for x in ordinary if not re.search(r"licen[cs]|copyright|permission|redistribut|\bCC[ -]?(BY|0)", x, re.I)]


def train(lines: list[Line], seed: int = 4) -> Model:
    """A model by stochastic gradient descent on these lines, not calibrated."""
    rng = np.random.default_rng(seed)
    families = [NONE, UNKNOWN, *TEMPLATES]
    labels = [families.index(x.label) for x in lines]
    buckets, of = grams(_words_of([x.text for x in lines]))
    order = np.argsort(of, kind="stable")
    bags = np.split(buckets[order], np.cumsum(np.bincount(of, minlength=len(lines)))[:-1])
    weights, bias = np.zeros((1 << BUCKETS_LOG2, len(families))), np.zeros(len(families))
    for epoch in range(EPOCHS):
        rate = 0.5 / (1 + epoch)
        for i in rng.permutation(len(lines)):
            bag = bags[i]
            scale = 1 / np.sqrt(max(len(bag), 1))
            z = weights[bag].sum(axis=0) * scale + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            np.subtract.at(weights, bag, rate * scale * p)
            bias -= 0.1 * rate * p
    weights[np.abs(weights).max(axis=1) < 0.02] = 0  # sparse
    return Model(families, weights.astype(np.float32), bias, np.abs(weights).max(axis=1) > 0)


def left_out(lines: list[Line], part: int, parts: int = FOLDS) -> tuple[list[Line], list[Line]]:
    """Lines to learn from, and others to ask about: of templates, families and other texts that none of these vary, and every second variation of those that they do.

    Lines of a family that is left out whole are notices of no known family.
    """
    names = list(TEMPLATES)
    gone = {f for i, f in enumerate(names) if i % (2 * parts) == part}
    learn, ask = [], []
    for k, x in enumerate(lines):
        if x.source is None:
            (ask if k % parts == part else learn).append(x)
            continue
        label, i = x.source
        some = len(TEMPLATES.get(label, OTHER_NOTICES)) > 1
        if label in gone:
            ask.append(Line(x.text, UNKNOWN, x.source))
        elif some and i % parts == part:
            ask.append(x)
        else:
            (ask if k % 2 else learn).append(x)
    return learn, ask


def fit(ordinary: list[str], seed: int = 4) -> Model:
    """Trains on variations of the templates and on lines that name no licence, and calibrates on what other models never saw."""
    model = train(examples(ordinary, 60, seed), seed)
    evidence, truth, texts = [], [], []
    for part in range(FOLDS):
        learn, ask = left_out(examples(ordinary[part::FOLDS], 60, seed + 1 + part), part)
        evidence.append(train(learn, seed).evidence(_words_of([x.text for x in ask])))
        truth += [model.families.index(x.label) for x in ask]
        texts += [x.text for x in ask]
    z, y = np.concatenate(evidence), np.array(truth, np.int64)
    tried = np.geomspace(0.01, 50, 80)
    losses = [-np.log(np.maximum(_softmax(z, t)[np.arange(len(y)), y], 1e-9)).mean() for t in tried]
    model.temperature = float(tried[int(np.argmin(losses))])
    # The bound: from it on, so many of the families that a template confirms are right.
    p = _softmax(z, model.temperature)
    best = p.argmax(axis=1)
    named = np.array([i for i in np.flatnonzero(best > 1) if agreement(model.families[best[i]], texts[i]) >= AGREES], np.int64)
    order = named[np.argsort(-p[named, best[named]], kind="stable")]
    right = np.cumsum(best[order] == y[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(right >= RIGHT)
    model.least = float(p[order[good[-1]], best[order[good[-1]]]]) if len(good) else 1.0
    return model


def _tokens(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


_TEMPLATE_TOKENS = {family: [_tokens(x) for x in templates] for family, templates in TEMPLATES.items()}


def agreement(family: str, text: str) -> float:
    """The largest share of a template's word pairs that the text holds."""
    have = _tokens(text)
    pairs = {*zip(have, have[1:])}
    return max(len(pairs & {*zip(t, t[1:])}) / max(len({*zip(t, t[1:])}), 1) for t in _TEMPLATE_TOKENS[family])


def decide(model: Model, p: np.ndarray, text: str) -> str:
    """The class of a paragraph: the likeliest of all; a family only if it is likely enough and a template confirms it, else unknown."""
    best = int(p.argmax())
    if best < 2:
        return model.families[best]
    family = model.families[best]
    return family if p[best] >= model.least and agreement(family, text) >= AGREES else UNKNOWN


#: Family, number of words and word pairs of each template, and the templates that hold a pair.
_SHAPES = [(family, len(t), len({*zip(t, t[1:])})) for family, templates in _TEMPLATE_TOKENS.items() for t in templates]
_HOLDING: dict[tuple[str, str], list[int]] = {}
for _k, _t in enumerate(t for templates in _TEMPLATE_TOKENS.values() for t in templates):
    for _pair in sorted({*zip(_t, _t[1:])}):
        _HOLDING.setdefault(_pair, []).append(_k)


def stretches(tokens: list[str]) -> Iterator[tuple[float, str, int, int]]:
    """Share, family, first and last token of where enough of a template's word pairs stand close together.

    For each template, from the left: the shortest stretch with the most of its pairs, then on
    behind that. Time is in proportion to the tokens.
    """
    hits: dict[int, list[int]] = {}
    pairs = list(zip(tokens, tokens[1:]))
    for at, pair in enumerate(pairs):
        for k in _HOLDING.get(pair, ()):
            hits.setdefault(k, []).append(at)
    for k, found in hits.items():
        family, size, of = _SHAPES[k]
        counts: Counter = Counter()
        low, i, most, first, last = 0, 0, 0, 0, 0
        while True:
            if most and (i == len(found) or found[i] - found[first] > STRETCH * size):
                yield most / of, family, found[first], found[last] + 1
                low = i = last + 1
                most = 0
                counts.clear()
            elif i == len(found):
                break
            else:
                counts[pairs[found[i]]] += 1
                while found[i] - found[low] > STRETCH * size or counts[pairs[found[low]]] > 1:
                    counts[pairs[found[low]]] -= 1
                    if not counts[pairs[found[low]]]:
                        del counts[pairs[found[low]]]
                    low += 1
                if len(counts) >= AGREES * of and len(counts) > most:
                    most, first, last = len(counts), low, i
                i += 1


Notice = tuple[int, int, str, float]  # first line, past-the-last line, family, probability of being a notice


def wrapped_notices(model: Model, lines: list[str]) -> list[Notice]:
    """Notices over several of these lines, between which no blank ones stand.

    Templates say where such a notice can begin and end; what the joined lines are the classifier
    decides. Of stretches that share lines the one with the larger share of its template comes first.
    """
    bare = [x[_LEADER.match(x).end() :].strip() for x in lines]
    tokens, of = [], []
    for i, x in enumerate(bare):
        own = _tokens(x)
        tokens += own
        of += [i] * len(own)
    found = sorted({(-share, of[a] - of[b], of[a], of[b] + 1, family) for share, family, a, b in stretches(tokens) if of[a] < of[b]})
    if not found:
        return []
    texts = [" ".join(bare[a:b]) for _, _, a, b, _ in found]
    out, taken = [], set()
    for p, text, (_, _, a, b, family) in zip(model.probabilities(_words_of(texts)), texts, found):
        if taken.isdisjoint(range(a, b)) and decide(model, p, text) == family:
            out.append((a, b, family, float(1 - p[0])))
            taken.update(range(a, b))
    return out


def notices(model: Model, data: np.ndarray, bounds: np.ndarray, doc: np.ndarray, filled: np.ndarray, single: dict[int, tuple[str, float]]) -> list[Notice]:
    """All notices of a run of texts, in order: of single lines, and over lines around one that holds a word of notices.

    filled: lines that hold words; single: family and probability of lines that are notices by
    themselves. A notice over several lines takes the place of those of its lines, and unknown
    ones in the same unbroken lines go. A further notice of its family that follows at once, or
    after blank and unknown lines only, is a part of it.
    """
    begin = int(bounds[0])
    low = LOWER[data[begin : int(bounds[-1])]].tobytes()
    seeds = np.unique(np.searchsorted(bounds, np.array([m.start() for m in _NOTICE_WORDS.finditer(low)], np.int64) + begin, side="right") - 1)
    broken = np.flatnonzero(np.concatenate([[True], ~filled[1:] | ~filled[:-1] | (doc[1:] != doc[:-1]), [True]]))
    left, wrapped = dict(single), {}
    for k in np.unique(np.searchsorted(broken, seeds, side="right") - 1).tolist():
        a, b = int(broken[k]), int(broken[k + 1])
        if b - a < 2:
            continue
        found = wrapped_notices(model, [data[bounds[j] : bounds[j + 1]].tobytes().decode() for j in range(a, b)])
        for first, last, family, share in found:
            wrapped[a + first] = (a + last, family, share)
            for j in range(a + first, a + last):
                left.pop(j, None)
        for j in range(a, b) if found else ():
            if j in left and left[j][0] == UNKNOWN:
                left.pop(j)
    every = sorted([(i, i + 1, family, share) for i, (family, share) in left.items()] + [(i, j, family, share) for i, (j, family, share) in wrapped.items()])
    out: list[Notice] = []
    at = 0
    while at < len(every):
        a, b, family, share = every[at]
        at += 1
        over = b - a > 1
        while True:
            ahead = at
            while ahead < len(every) and every[ahead][2] == UNKNOWN:
                ahead += 1
            if ahead == len(every) or every[ahead][2] != family or family == UNKNOWN or doc[every[ahead][0]] != doc[a] or not (over or every[ahead][1] - every[ahead][0] > 1):
                break
            between = [*range(b, every[ahead][0])]
            gone = {j for x in every[at:ahead] for j in range(x[0], x[1])}
            if len(between) > 4 * (len(gone) + 4) or any(filled[j] and j not in gone for j in between):
                break
            b, share, over, at = every[ahead][1], max(share, every[ahead][3]), True, ahead + 1
        out.append((a, b, family, share))
    return out


def scan_texts(model: Model, column: pa.Array) -> Iterator[tuple[int, list[tuple[str, int, int, float]]]]:
    """Of each text its number of non-blank lines and (family, start, end, probability) of notices, in code points."""
    data, offsets = bytes_of(column)
    for a, b in runs(offsets):
        bounds, doc = line_offsets(data, offsets[a : b + 1])
        w = words(data, bounds, _SEPARATORS)
        p = model.probabilities(w)
        worded = np.diff(w.first) > 0
        filled = np.bincount(doc[worded], minlength=b - a)
        single: dict[int, tuple[str, float]] = {}
        for i in np.flatnonzero(p.argmax(axis=1) > 0).tolist():
            single[i] = decide(model, p[i], data[bounds[i] : bounds[i + 1]].tobytes().decode()), float(1 - p[i, 0])
        spans = notices(model, data, bounds, doc, worded, single)
        found: dict[int, list] = {}
        begin = int(offsets[a])
        before = np.concatenate([[0], np.cumsum((data[begin : int(offsets[b])] & 0xC0) != 0x80, dtype=np.int64)]) if spans else None  # code points
        for i, j, family, share in spans:
            d = int(doc[i])
            start = int(before[bounds[i] - begin] - before[offsets[a + d] - begin])
            text = data[bounds[i] : bounds[j]].tobytes().decode()
            found.setdefault(d, []).append((family, start, start + len(text.rstrip("\r\n")), share))
        for d in range(b - a):
            yield int(filled[d]), found.get(d, [])


def sample(docs: DataFrame) -> list[str]:
    """About LINES lines of about DOCUMENTS documents, at most twice as many."""
    lines = [x for text in sampled(docs, "doc_id", "text", DOCUMENTS) for x in text.split("\n") if x.strip()]
    rng = np.random.default_rng(6)
    return lines if len(lines) <= LINES else [lines[i] for i in sorted(rng.choice(len(lines), LINES, replace=False))]


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row a row of docs: doc_id, n_paragraphs, n_notices, families, spans.

    Every line of the whole text is classified, and lines without blank ones between them, comment
    leaders removed, together where they hold words of notices and most of a template. n_paragraphs: lines with a word; families: the
    distinct families found, 'unknown' among them, sorted and joined by commas; spans:
    family:start:end of each notice's line or lines in code points, joined by commas. Null, empty and
    blank texts have none. Repeated rows are scanned each; other columns are not read; an empty
    table gives no rows. The model is trained on templates and a bounded sample of docs unless
    one is given.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    model = docs.sparkSession.sparkContext.broadcast(model or fit(sample(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, len(found), ",".join(sorted({f for f, *_ in found})), ",".join(f"{f}:{s}:{e}" for f, s, e, _ in found)) for n, found in scan_texts(model.value, batch.column("text"))]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string())))], names=["doc_id", "n_paragraphs", "n_notices", "families", "spans"])

    return docs.mapInArrow(run, "doc_id long, n_paragraphs long, n_notices long, families string, spans string")
