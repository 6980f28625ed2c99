"""Licence statements in paragraphs: a trained classifier, confirmed by templates.

Paragraphs (lines, in pieces of at most ``PIECE`` words) are classified by multinomial
logistic regression over hashed word 1- to 3-grams. It is trained on varied templates and,
for the unknown class, on paragraphs of the corpus. Its probabilities are calibrated by a
temperature, and the unknown class by a threshold that keeps all but ``FALSE_SHARE`` of
held-out corpus paragraphs unknown. A prediction counts if the paragraph also holds enough
of the 3-grams of a template of that family.

A statement may also run across line ends, up to a line without words, and begin anywhere
in a long line. So where enough of a template's 3-grams lie together, a window is put
around them and classified in the same way. Overlapping hits of a family are one statement.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from funnelspark.llm.common import PLAIN, Words, free_name, lower, mix, slices, utf8, with_columns

HASH_BITS = 16
PIECE = 64
#: Paragraphs of the corpus for the unknown class, drawn from so many documents.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 4000
#: Share of held-out corpus paragraphs that may pass the threshold.
FALSE_SHARE = 0.001
#: Share of a template's 3-grams that confirms its family.
CONFIRMED = 0.6
#: Words around a template's place that are classified with it, besides the place alone.
MARGIN = 2
_SHIFT = np.uint64(64 - HASH_BITS)
_LINE = 0x0A

#: Usual statements of licence families, in their own words.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the MIT License",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without written permission."],
}
UNKNOWN = "unknown"


class Paragraphs:
    """The paragraphs of some texts: text number, byte offsets and hashed n-grams of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = lower(data)
        words = Words(data, offsets, PLAIN)
        size = len(words.hash)
        lines = np.concatenate([[0], np.cumsum(data == _LINE)])[words.start] if size else np.zeros(0, np.int64)
        fresh = np.ones(size, bool)
        fresh[1:] = (np.diff(lines) != 0) | (np.diff(words.text) != 0)
        begin = np.flatnonzero(fresh)
        nth = np.arange(size) - np.repeat(begin, np.diff(np.append(begin, size)))
        fresh |= nth % PIECE == 0
        self.first = np.flatnonzero(fresh)
        self.number = np.cumsum(fresh) - 1
        self.text = words.text[self.first]
        last = np.append(self.first[1:], size) - 1 if size else self.first
        self.begin, self.end = words.start[self.first], words.end[last]
        self.sizes = last - self.first + 1
        apart = np.ones(size, bool)
        apart[1:] = (np.diff(lines) > 1) | (np.diff(words.text) != 0)
        #: Where the block of each word, lines with no wordless line between, begins and ends.
        edges = np.append(np.flatnonzero(apart), size)
        block = np.cumsum(apart) - 1
        self.block = edges[block], edges[block + 1]
        self.words = words
        self.running = [words.hash]
        self.grams = [words.hash]
        factor = 0x9E3779B97F4A7C15
        for n in (1, 2):
            running, longer = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
            if size > n:
                joined = mix(self.running[-1][:-n] * np.uint64(factor) + words.hash[n:])
                running[:-n] = joined
                longer[:-n] = np.where(self.number[:-n] == self.number[n:], joined, 0)
            self.running.append(running)
            self.grams.append(longer)

    def windows(self, begin: np.ndarray, end: np.ndarray) -> Paragraphs:
        """Stretches of words, each within a block, as paragraphs."""
        out = object.__new__(Paragraphs)
        out.sizes = end - begin
        out.first = np.cumsum(out.sizes) - out.sizes
        out.number = np.repeat(np.arange(len(begin)), out.sizes)
        place = np.arange(len(out.number)) - out.first[out.number]
        at = begin[out.number] + place
        out.grams = [np.where(place + n < out.sizes[out.number], g[at], 0) for n, g in enumerate(self.running)]
        out.text = self.words.text[begin]
        out.begin, out.end = self.words.start[begin], self.words.end[end - 1]
        return out

    def __len__(self) -> int:
        return len(self.first)


@dataclass
class Model:
    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    heat: float
    threshold: float
    templates: list[tuple[int, np.ndarray]]

    def logits(self, paragraphs: Paragraphs) -> np.ndarray:
        total = np.zeros((len(paragraphs), len(self.families) + 1), np.float32)
        if len(paragraphs):
            for grams in paragraphs.grams:
                rows = np.take(self.weights, (grams >> _SHIFT).astype(np.intp), axis=0)
                rows[grams == 0] = 0
                total += np.add.reduceat(rows, paragraphs.first, axis=0)
            total /= np.sqrt(3 * paragraphs.sizes)[:, None]
        return (total + self.bias) / self.heat

    def found(self, paragraphs: Paragraphs) -> list[tuple[int, int, float]]:
        """Paragraph, family and probability of each confirmed statement."""
        chance = softmax(self.logits(paragraphs))[:, 1:]
        best = chance.argmax(1) if len(paragraphs) else np.zeros(0, int)
        out = []
        for i in np.flatnonzero(chance.max(1, initial=0) >= self.threshold).tolist():
            end = paragraphs.first[i] + paragraphs.sizes[i]
            grams = _template(paragraphs, slice(paragraphs.first[i], end))
            if any(
                family == best[i] and np.isin(known, grams).mean() >= CONFIRMED for family, known in self.templates
            ):
                out.append((i, int(best[i]), float(chance[i, best[i]])))
        return out

    def around(self, paragraphs: Paragraphs) -> Paragraphs:
        """Windows around the places where enough of a template's 3-grams lie together."""
        grams, (first, last) = paragraphs.running[2], paragraphs.block
        hits = np.flatnonzero(np.isin(grams, np.concatenate([known for _, known in self.templates])))
        hits = hits[hits + 3 <= last[hits]]
        found = set()
        for _, known in self.templates:
            places = hits[np.isin(grams[hits], known)].tolist()
            needed, length = -int(-CONFIRMED * len(known) // 1), len(known) + 2
            for i, begin in enumerate(places):
                seen, j, stop = set(), i, min(begin + PIECE, int(last[begin]))
                while j < len(places) and places[j] + 3 <= stop and len(seen) < needed:
                    seen.add(int(grams[places[j]]))
                    j += 1
                if len(seen) >= needed:
                    end = max(places[j - 1] + 3, begin + length)
                    for margin in (0, MARGIN):
                        found.add((max(begin - margin, int(first[begin])), min(end + margin, int(last[begin]))))
        begin, end = np.array(sorted(found), np.int64).reshape(-1, 2).T
        return paragraphs.windows(begin, end)

    def statements(self, paragraphs: Paragraphs) -> list[tuple[int, int, float, int, int]]:
        """Text number, family, probability, begin and end of each confirmed statement."""
        hits = []
        for some in (paragraphs, self.around(paragraphs)):
            for i, family, chance in self.found(some):
                hits.append((int(some.text[i]), family, int(some.begin[i]), int(some.end[i]), chance))
        out: list[tuple[int, int, float, int, int]] = []
        for text, family, begin, end, chance in sorted(hits):
            if out and out[-1][:2] == (text, family) and begin < out[-1][4]:
                out[-1] = (text, family, max(chance, out[-1][2]), out[-1][3], max(end, out[-1][4]))
            else:
                out.append((text, family, chance, begin, end))
        return sorted(out, key=lambda s: (s[0], s[3], s[4], s[1]))


def _template(paragraphs: Paragraphs, part: slice) -> np.ndarray:
    """3-grams of a paragraph; a shorter one has its longest gram."""
    for grams in reversed(paragraphs.grams):
        some = grams[part]
        some = some[some != 0]
        if len(some):
            return np.unique(some)
    return np.zeros(0, np.uint64)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True)) if len(x) else x
    return x / x.sum(1, keepdims=True)


def train(background: list[str], seed: int = 3, steps: int = 50) -> Model:
    """A model from the templates and paragraphs of the corpus, which may be none."""
    rng = np.random.default_rng(seed)
    families = list(TEMPLATES)
    pool = [w for line in background[:200] for w in line.split()] or ["text"]
    texts, labels = [], []
    for family, statements in enumerate(families):
        for statement in TEMPLATES[statements]:
            for _ in range(60):
                words = [w for w in statement.split() if rng.random() > 0.05]
                around = [[pool[i] for i in rng.integers(len(pool), size=rng.integers(0, 4))] for _ in range(2)]
                texts.append(" ".join([*around[0], *words, *around[1]]).replace("\n", " "))
                labels.append(family + 1)
    known = _grams_of([s for f in families for s in TEMPLATES[f]])
    owners = [i for i, f in enumerate(families) for _ in TEMPLATES[f]]
    templates = [(owner, _template(known, slice(a, a + n))) for owner, a, n in zip(owners, known.first, known.sizes, strict=True)]
    statements = set(np.concatenate([t for _, t in templates]).tolist())
    lines = [line for line in background if line.strip()]
    spread = _grams_of(lines)
    clean = [True] * len(lines)
    for i in range(len(spread)):
        part = _template(spread, slice(spread.first[i], spread.first[i] + spread.sizes[i]))
        if statements.intersection(part.tolist()):
            clean[spread.text[i]] = False
    lines = [line for line, ok in zip(lines, clean, strict=True) if ok]
    half = lines[::2]
    texts += half
    labels += [0] * len(half)
    shown = _grams_of(texts)
    target = np.array(labels)[shown.text]
    model = Model(families, np.zeros((1 << HASH_BITS, len(families) + 1), np.float32), np.zeros(len(families) + 1, np.float32), 1.0, 0.5, templates)
    squares = np.full_like(model.weights, 1e-3)
    codes = [(g >> _SHIFT).astype(np.intp) for g in shown.grams]
    scale = np.sqrt(3 * shown.sizes)
    share = 1 / np.bincount(target, minlength=len(families) + 1).clip(1)[target]
    for _ in range(steps):
        delta = softmax(model.logits(shown))
        delta[np.arange(len(target)), target] -= 1
        delta *= share[:, None]
        slope = np.zeros_like(model.weights)
        each = (delta / scale[:, None])[shown.number].astype(np.float32)
        for code, grams in zip(codes, shown.grams, strict=True):
            np.add.at(slope, code[grams != 0], each[grams != 0])
        slope += 1e-5 * model.weights
        squares += slope * slope
        model.weights -= 0.3 * slope / np.sqrt(squares)
        model.bias -= 0.3 * delta.sum(0)
    held = _grams_of(lines[1::2])
    logits, wrong = model.logits(shown), model.logits(held)
    heats = np.linspace(0.5, 4, 15)
    losses = [
        -np.log(softmax(logits / h)[np.arange(len(target)), target] + 1e-9).mean()
        - (np.log(softmax(wrong / h)[:, 0] + 1e-9).mean() if len(wrong) else 0)
        for h in heats
    ]
    model.heat = float(heats[int(np.argmin(losses))])
    if len(wrong):
        highest = softmax(wrong / model.heat)[:, 1:].max(1)
        model.threshold = float(np.clip(np.quantile(highest, 1 - FALSE_SHARE), 0.5, 0.95))
    return model


def _grams_of(texts: list[str]) -> Paragraphs:
    return Paragraphs(*utf8(pa.array(texts, pa.string())))


def fitted(docs: DataFrame, text_column: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model whose unknown class comes from at most ``sample_docs`` documents, drawn by hash."""
    text = F.col(text_column)
    rows = docs.where(F.octet_length(text) > 0).select(
        F.xxhash64(text).alias("draw"), F.substring(text, 1, SAMPLE_CHARS).alias("passage")
    )
    drawn = rows.orderBy("draw", "passage").limit(sample_docs).collect()
    return train([line for r in drawn for line in r["passage"].split("\n")])


def scan(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_paragraphs`` (long) and ``statements``: family, probability, begin and
    end (UTF-8 bytes) of each confirmed licence statement.

    Null and empty texts have no paragraphs. All other paragraphs are of unknown licence.
    Names taken already get a trailing ``_``.
    """
    names = [free_name(docs, n) for n in ("n_paragraphs", "statements")]
    kind = "array<struct<family:string,probability:double,begin:long,end:long>>"
    kinds = (LongType(), StructType.fromDDL(f"s {kind}")[0].dataType)
    arrow = pa.list_(
        pa.struct([("family", pa.string()), ("probability", pa.float64()), ("begin", pa.int64()), ("end", pa.int64())])
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, text_column):
                data, offsets = utf8(part.column(text_column))
                paragraphs = Paragraphs(data, offsets)
                found: list[list] = [[] for _ in range(part.num_rows)]
                for text, family, chance, begin, end in known.statements(paragraphs):
                    found[text].append(
                        {
                            "family": known.families[family], "probability": chance,
                            "begin": int(begin - offsets[text]), "end": int(end - offsets[text]),
                        }
                    )
                counts = np.bincount(paragraphs.text, minlength=part.num_rows).astype(np.int64)
                arrays = [*part.columns, pa.array(counts), pa.array(found, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, *names])

    return docs.mapInArrow(work, with_columns(docs, **dict(zip(names, kinds, strict=True))))
