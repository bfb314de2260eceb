"""Licence scan: paragraphs classified by a sparse word n-gram logistic
regression, with an unknown class, confirmed by comparison with templates.

The model is trained from the notices below and from a bounded sample of the
corpus' paragraphs that share little with any of them, the unknown class. What
the classifier names a licence must also hold most word pairs of one of that
family's notices.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, record

UNKNOWN = "unknown"
#: Notices of each family.
NOTICES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\")",
                   "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Licensed under the BSD 3-Clause License.", "Released under the BSD License.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License."),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL v3.",
                "SPDX-License-Identifier: GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    "mit": ("Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "mpl-2.0": ("Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
}
WORD = re.compile(r"[^\W_]+")


def grams(paragraph: str, buckets: int) -> np.ndarray:
    """Distinct hash buckets of the words and word pairs."""
    words = WORD.findall(paragraph.lower())
    return np.array(sorted({xxhash.xxh3_64_intdigest(g) % buckets for g in [*words, *map(" ".join, zip(words, words[1:]))]}), np.int64)


def _pairs(paragraph: str) -> set:
    words = WORD.findall(paragraph.lower())
    return set(zip(words, words[1:]))


PAIRS = {family: [_pairs(n) for n in notices] for family, notices in NOTICES.items()}


def confirmed(paragraph: str, family: str) -> float:
    """The largest share of a notice's word pairs that the paragraph holds."""
    have = _pairs(paragraph)
    return max((len(p & have) / len(p) for p in PAIRS.get(family, [])), default=0.0)


class Model:
    """Multinomial logistic regression on hashed grams; the first class is unknown."""

    def __init__(self, families: list[str], buckets: int):
        self.names, self.buckets = [UNKNOWN, *families], buckets
        self.weights, self.bias, self.sharpness = np.zeros((buckets, len(self.names))), np.zeros(len(self.names)), 1.0

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        z = np.array([self.weights[g].sum(axis=0) / max(1, len(g)) ** 0.5 for g in found]).reshape(-1, len(self.names)) + self.bias
        z = np.exp(self.sharpness * (z - z.max(axis=1, keepdims=True)))
        return z / z.sum(axis=1, keepdims=True)


def train(unknown: list[str], *, buckets: int = 1 << 14, epochs: int = 150, rate: float = 2.0, decay: float = 1e-4) -> Model:
    """Fit on the notices, alone and inside unknown text, and on unknown
    paragraphs; the sharpness of the probabilities is calibrated on a third of
    the rows, which is not fitted on."""
    model = Model(sorted(NOTICES), buckets)
    rows = [(p, 0) for p in unknown]
    for y, family in enumerate(model.names[1:], 1):
        for i, notice in enumerate(NOTICES[family]):
            rows += [(notice, y)] * 3
            rows += [(f"{notice} {p[:80]}", y) for p in unknown[i :: max(1, len(unknown) // 6)]]
    found, label = [grams(p, buckets) for p, _ in rows], np.array([y for _, y in rows])
    held = np.arange(len(rows)) % 3 == 2
    fit = [i for i in range(len(rows)) if not held[i]]
    size = np.bincount(label[fit], minlength=len(model.names))
    share = (1 / np.maximum(1, size))[label] / len(model.names)
    owner = np.repeat(np.arange(len(rows)), [len(g) for g in found])
    at, inside = np.concatenate(found), ~held[np.repeat(np.arange(len(rows)), [len(g) for g in found])]
    scale = 1 / np.sqrt(np.maximum(1, [len(g) for g in found]))
    target = np.eye(len(model.names))[label]
    for _ in range(epochs):
        error = (model.scores(found) - target) * (share * ~held)[:, None] * 10
        move = np.zeros_like(model.weights)
        np.add.at(move, at[inside], (error * scale[:, None])[owner[inside]])
        model.weights -= rate * (move + decay * model.weights)
        model.bias -= rate * error.sum(axis=0) * 0.1

    def loss(sharpness: float) -> float:
        model.sharpness = sharpness
        return -np.log(model.scores([found[i] for i in np.flatnonzero(held)])[np.arange(held.sum()), label[held]] + 1e-12).mean()

    model.sharpness = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0), key=loss) if held.any() else 1.0
    return model


def learn_from(docs: DataFrame, text_col: str = "text", *, max_unknown: int = 600) -> Model:
    """train() with an unknown class of at most max_unknown paragraphs (the first
    by md5) that hold less than half of any notice's word pairs."""
    lines = docs.select(F.explode(F.split(F.col(f"`{text_col}`").cast("string"), "\n")).alias("p")).where(r"p rlike '[^\\x20\\x09-\\x0D]'")
    found = [r.p for r in lines.orderBy(F.md5("p"), "p").limit(max_unknown).collect()]
    return train([p for p in found if max(confirmed(p, f) for f in NOTICES) < 0.5])


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *, least_score: float = 0.5, least_shared: float = 0.7) -> DataFrame:
    """One row (doc_id, n_paragraphs, licences) for each row of docs: its
    paragraphs (lines with a word) and the distinct families, in order, that the
    classifier finds in them and the templates confirm, as array of struct
    (paragraph, family, score, shared) in ``found``.

    Null and empty texts have no paragraphs. Whole texts are read, each row by
    itself; null and repeated ids are values like any other; other columns are
    not read."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    hit = pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("score", pa.float64()), ("shared", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_paragraphs", pa.int64()), ("licences", pa.list_(pa.string())), ("found", pa.list_(hit))])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [[p for p in (text or "").split("\n") if p.strip(" \t\n\x0b\x0c\r")] for text in batch.column(1).to_pylist()]
            # every paragraph is classified; one that the batch repeats, once
            distinct = list(dict.fromkeys(p for lines in texts for p in lines))
            scores = model.scores([grams(p, model.buckets) for p in distinct])
            named = {}
            for p, row, best in zip(distinct, scores, scores.argmax(axis=1).tolist()):
                if best and row[best] >= least_score and (shared := confirmed(p, model.names[best])) >= least_shared:
                    named[p] = {"family": model.names[best], "score": float(row[best]), "shared": shared}
            hits = [[{"paragraph": i, **named[p]} for i, p in enumerate(lines) if p in named] for lines in texts]
            families = [sorted({h["family"] for h in out}) for out in hits]
            return record(schema, batch.column(0), [len(lines) for lines in texts], families, hits)

        return step

    return map_rows(rows, make, "doc_id long, n_paragraphs long, licences array<string>, "
                    "found array<struct<paragraph:long,family:string,score:double,shared:double>>", 4 << 20)
