"""Licence scans: a trained classifier of paragraphs, confirmed by comparison with notices.

A paragraph is a line; a line of many words is cut between sentences into pieces of about PIECE_WORDS words. Its features
are the words and word pairs that occur in licence notices, each once, divided by the root of the number of distinct words
and pairs, and a bias. A multinomial logistic regression over the licence families and one class for everything else is
trained on the notices, varied by dropped, changed and added words, against paragraphs of the corpus and sentences that
only talk about licences. Its logits are divided by a temperature fitted on held-out variations, so that the share of the
unknown class is calibrated. A prediction counts when a notice of the family confirms it: enough of the notice's words and
word pairs occur in the paragraph.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.llm import batches

# The unknown class is trained on lines of so many texts, chosen by hash of their id, of these on so many lines of at most
# so many characters, chosen by hash.
SAMPLE_TEXTS, SAMPLE_LINES, LINE_CHARS = 500, 2_000, 2_000
PIECE_WORDS = 40
# A family is reported from this probability on, if so much of a notice occurs.
MIN_PROBABILITY, MIN_OVERLAP = 0.5, 0.5
# A line of the corpus with so much of a notice is no example of the unknown class.
NOTICE_LIKE = 0.2
UNKNOWN = "unknown"

# Notices of the licence families: fixed values, the customary wording.
NOTICES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "This software is distributed under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
        "Licensed under the GNU GPL v2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0": (
        "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
    ),
}
# Sentences about licences that grant none.
TALK = (
    "You need a driving licence to rent a car in most countries.",
    "The pub was licensed in 1890 and still serves ale.",
    "Please read the license before you install the software.",
    "The general public was invited to the version of the play.",
    "All members have reserved the right to vote.",
    "The work of the foundation is free and public.",
    "Permission to build was granted without restriction by the council.",
)

FAMILIES = [*NOTICES, UNKNOWN]
_PARAGRAPH = "struct<start:int,end:int,family:string,probability:double,overlap:double>"
SCHEMA = f"doc_id bigint, n_paragraphs bigint, n_unknown bigint, families array<string>, paragraphs array<{_PARAGRAPH}>"
_ARROW_PARAGRAPH = pa.list_(
    pa.struct(
        [
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("family", pa.string()),
            ("probability", pa.float64()),
            ("overlap", pa.float64()),
        ]
    )
)


def pieces(lines: batches.Lines) -> np.ndarray:
    """Index of the first word of every paragraph piece."""
    count = len(lines.new)
    at = np.arange(count)
    start = np.maximum.accumulate(np.where(lines.new, at, 0))
    sentences = np.flatnonzero(lines.sentence)
    step = (sentences - start[sentences]) // PIECE_WORDS
    cut = lines.new[sentences]
    cut[1:] |= step[1:] != step[:-1]
    return sentences[cut]


class Vocabulary:
    """Words and pairs of all notices, and of each notice."""

    def __init__(self):
        table = batches.word_table()
        self.notices, self.owner, known = [], [], []
        for number, notices in enumerate(NOTICES.values()):
            for notice in notices:
                hashes = _hashes(notice, table)
                known += [hashes, batches.grams(hashes, 2)]
                self.notices.append(np.unique(np.concatenate(known[-2:])))
                self.owner.append(number)
        self.known = np.unique(np.concatenate(known))

    def features(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(paragraph, feature, value) of the known words and pairs; paragraph p is words first[p]:first[p + 1]."""
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        pair = batches.grams(hashes, 2)
        inside = np.ones(len(pair), bool)
        inside[first[1:-1] - 1] = False
        units = np.concatenate([hashes, pair[inside]])
        owners = np.concatenate([owner, owner[: len(pair)][inside]])
        sizes = np.bincount(owners, minlength=len(first) - 1)
        at = np.minimum(np.searchsorted(self.known, units), len(self.known) - 1)
        hit = np.flatnonzero(self.known[at] == units)
        found = np.unique(np.stack([owners[hit], at[hit]], 1), axis=0)
        return found[:, 0], found[:, 1], 1 / np.sqrt(sizes[found[:, 0]])

    def overlap(self, hashes: np.ndarray, family: int) -> float:
        """Largest share of the words and pairs of one of the family's notices that occurs in the paragraph."""
        own = np.concatenate([hashes, batches.grams(hashes, 2)])
        of_family = [n for n, owner in zip(self.notices, self.owner, strict=True) if owner == family]
        return max(float(np.isin(notice, own).mean()) for notice in of_family)


def _hashes(text: str, table: np.ndarray) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return batches.words(data, np.array([0, len(data)]), table).hashes


class Model:
    """Weights (feature, class), bias and temperature."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.weights, self.bias, self.temperature = weights, bias, temperature

    def logits(self, paragraph: np.ndarray, feature: np.ndarray, value: np.ndarray, count: int) -> np.ndarray:
        out = np.tile(self.bias, (count, 1))
        np.add.at(out, paragraph, self.weights[feature] * value[:, None])
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def variations(corpus: list[str], each: int, seed: int) -> list[tuple[str, int]]:
    """Notices with words dropped, changed or added, and texts of the unknown class, with their class."""
    rng, out = random.Random(seed), []
    fill = [w for t in corpus for w in t.split()[:50]] or ["text", "of", "another", "kind"]
    for number, notices in enumerate(NOTICES.values()):
        for notice in notices:
            for _ in range(each):
                words = notice.split()
                noise = rng.choice((0.0, 0.05, 0.15))
                words = [rng.choice(fill) if rng.random() < noise else w for w in words if rng.random() >= noise / 2]
                if rng.random() < 0.5:
                    more = [rng.choice(fill) for _ in range(rng.randint(1, 12))]
                    words = words + more if rng.random() < 0.5 else more + words
                out.append((" ".join(words), number))
    unknown = [*corpus, *(t for t in TALK for _ in range(each))]
    # Single words of notices among others are no notice.
    loose = [w for notices in NOTICES.values() for n in notices for w in n.split()]
    for _ in range(10 * each):
        words = [rng.choice(loose) for _ in range(rng.randint(1, 4))] + [rng.choice(fill) for _ in range(rng.randint(4, 20))]
        rng.shuffle(words)
        unknown.append(" ".join(words))
    return [*out, *((t, len(FAMILIES) - 1) for t in unknown)]


def _stop(data: np.ndarray, line_end: int, following: np.ndarray) -> int:
    """Where a paragraph ends that goes up to the end of its line or the next word, without white space."""
    stop = int(min(line_end, *following)) if len(following) else int(line_end)
    while data[stop - 1] in batches.WHITE_SPACE:
        stop -= 1
    return stop


def _matrix(vocabulary: Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = batches.word_table()
    words = [_hashes(t, table) for t in texts]
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    keep = np.flatnonzero(np.diff(first) > 0)
    bounds = np.append(first[keep], first[-1])
    paragraph, feature, value = vocabulary.features(np.concatenate(words), bounds)
    return keep[paragraph], feature, value


def train(corpus: list[str], seed: int = 7, rounds: int = 400) -> Model:
    """Fit on one set of variations, and the temperature on another."""
    vocabulary = Vocabulary()
    examples = variations(corpus, 20, seed)
    labels = np.array([y for _, y in examples])
    paragraph, feature, value = _matrix(vocabulary, [t for t, _ in examples])
    count, classes = len(examples), len(FAMILIES)
    model = Model(np.zeros((len(vocabulary.known), classes)), np.zeros(classes), 1.0)
    model.bias[-1] = 3.0
    weight = 1 / np.bincount(labels, minlength=classes)[labels] / classes
    weight[labels == classes - 1] *= 4  # most paragraphs are no notices
    one_hot = np.eye(classes)[labels]
    speed = [np.zeros_like(model.weights), np.zeros(classes)]
    for _ in range(rounds):
        error = (model.probabilities(model.logits(paragraph, feature, value, count)) - one_hot) * weight[:, None]
        slope = np.zeros_like(model.weights)
        np.add.at(slope, feature, error[paragraph] * value[:, None])
        slope += 1e-5 * model.weights
        for at, (part, g) in enumerate(((model.weights, slope), (model.bias, error.sum(0)))):
            speed[at] += g**2
            part -= 0.5 * g / (np.sqrt(speed[at]) + 1e-8)
    held = variations(corpus, 5, seed + 1)
    y = np.array([y for _, y in held])
    logits = model.logits(*_matrix(vocabulary, [t for t, _ in held]), len(held))

    def loss(t: float) -> float:
        p = Model(model.weights, model.bias, t).probabilities(logits)
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    model.temperature = min((2.0 ** (k / 4) for k in range(-12, 13)), key=loss)
    return model


def fit(
    docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, sample_lines: int = SAMPLE_LINES, line_chars: int = LINE_CHARS
) -> Model:
    """Train with lines of at most `sample_texts` ids as the unknown class: at most `sample_lines` different ones without
    cue words and of at most `line_chars` characters, so that what is fetched is bounded.

    NULL ids and texts give none; an empty table leaves the sentences about licences as the unknown class.
    """
    chosen = docs.select(F.col("doc_id").alias("id")).where("id IS NOT NULL").distinct()
    chosen = chosen.orderBy(F.xxhash64("id", F.lit("licence")), "id").limit(sample_texts)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    line = texts.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line").between(1, line_chars))
    clean = line.where(~F.col("line").rlike("(?i)licen|copyright|rights reserved|spdx|permission")).distinct()
    clean = clean.orderBy(F.xxhash64("line"), "line").limit(sample_lines)
    # Lines like a notice are no examples of other text, whatever words they use.
    vocabulary, table = Vocabulary(), batches.word_table()
    lines = [row["line"] for row in clean.collect()]
    hashes = [_hashes(line, table) for line in lines]
    like = [max(vocabulary.overlap(h, k) for k in range(len(NOTICES))) if len(h) else 0.0 for h in hashes]
    return train(sorted(line for line, share in zip(lines, like, strict=True) if share < NOTICE_LIKE))


def scan_licenses(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): families confirmed in it, and the paragraphs they were found in.

    A span goes from the first word to the last character that is no white space; of equally probable families the first
    listed one counts. `n_unknown` counts paragraphs of no confirmed family. NULL and wordless texts have no paragraphs. Repeated rows and
    NULL ids keep their rows; no documents give no rows. Other columns are ignored.
    """
    model = fit(docs, sample_texts)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.temperature))

    def scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary, table = Model(*shared.value), Vocabulary(), batches.word_table()
        for batch in stream:
            for lo, hi, data, offsets in batches.slices(batch.column(1)):
                words = batches.words(data, offsets, table)
                lines = batches.lines(data, offsets, words)
                first = pieces(lines)
                row = np.searchsorted(words.first, first, side="right") - 1
                count = np.bincount(row, minlength=hi - lo)
                rows = [[] for _ in range(hi - lo)]
                if len(first):
                    bounds = np.append(first, len(words.hashes))
                    paragraph, feature, value = vocabulary.features(words.hashes, bounds)
                    # Paragraphs without a feature are what the bias says.
                    some, place = np.unique(paragraph, return_inverse=True)
                    p = model.probabilities(model.logits(place, feature, value, len(some)))
                    best = p.argmax(1)
                    sure = (best < len(FAMILIES) - 1) & (p[np.arange(len(some)), best] >= MIN_PROBABILITY)
                    for i in np.flatnonzero(sure):
                        k, family = some[i], int(best[i])
                        a, b = bounds[k], bounds[k + 1]
                        overlap = vocabulary.overlap(words.hashes[a:b], family)
                        if overlap >= MIN_OVERLAP:
                            begin = offsets[row[k]]
                            start, end = words.start[a], _stop(data, lines.high[b - 1], words.start[b : b + 1])
                            at = np.count_nonzero((data[begin:start] & 0xC0) != 0x80)
                            size = np.count_nonzero((data[start:end] & 0xC0) != 0x80)
                            chance = round(float(p[i, best[i]]), 6)
                            rows[row[k]].append((int(at), int(at + size), FAMILIES[family], chance, round(overlap, 6)))
                confirmed = np.array([len(r) for r in rows], np.int64)
                names = ("start", "end", "family", "probability", "overlap")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(count, pa.int64()),
                        pa.array(count - confirmed, pa.int64()),
                        pa.array([sorted({x[2] for x in r}) for r in rows], pa.list_(pa.string())),
                        pa.array([[dict(zip(names, x, strict=True)) for x in r] for r in rows], _ARROW_PARAGRAPH),
                    ],
                    ["doc_id", "n_paragraphs", "n_unknown", "families", "paragraphs"],
                )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(scan, SCHEMA)
