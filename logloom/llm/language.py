"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a hash of its code
point. An n-gram's vector binds (multiplies) the vectors of its letters, each
rotated by its place; a text's vector bundles (adds) those of its n-grams, and
a language's prototype bundles the unit vectors of its training texts. A text
gets the language whose prototype has the largest cosine.

A batch counts its distinct n-grams and multiplies counts by n-gram vectors in
blocks. Prototypes are summed as integers, so that no order of tasks changes
them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GOLD, map_rows, mix64, record, slices

_U = np.uint64
UNKNOWN = "und"
#: Scale at which unit vectors are summed as integers.
SCALE = 1 << 20
#: Distinct n-grams whose vectors are made at a time: several arrays of this many vectors.
BLOCK = 1024


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letter_vectors(codes: np.ndarray, dims: int) -> np.ndarray:
    """Bits (len(codes), dims) drawn from a hash of the code point and place."""
    with np.errstate(over="ignore"):
        draws = mix64(mix64(codes.astype(_U)[:, None] + GOLD) + np.arange(1, dims // 64 + 1, dtype=_U) * GOLD)
    return np.unpackbits(draws.view(np.uint8), axis=1)


def ngrams(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts: n-gram keys (uint64, 21 bits a place) and their text's
    index. Case is folded; what is not a letter is one space, also at the ends."""
    keys, owner = [], []
    is_letter = letters()
    for i, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(is_letter[codes], codes, 32)
        if not (codes != 32).any():
            continue
        codes = np.concatenate([[32], codes, [32]])
        codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]].astype(_U)
        key = np.zeros(max(len(codes) - n + 1, 0), _U)
        for place in range(n):
            key = (key << _U(21)) | codes[place : place + len(key)]
        keys.append(key)
        owner.append(np.full(len(key), i))
    if not keys:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owner)


def bundle(texts: list[str | None], n: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (len(texts), dims) and which texts have a letter."""
    out = np.zeros((len(texts), dims), np.float32)
    keys, owner = ngrams(texts, n)
    grams, at = np.unique(keys, return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    cuts = np.searchsorted(at, np.arange(0, len(grams) + BLOCK, BLOCK))
    for b in range(len(cuts) - 1):
        lo, hi = cuts[b], cuts[b + 1]
        if lo == hi:
            continue
        some = grams[b * BLOCK : (b + 1) * BLOCK]
        bits = np.zeros((len(some), dims), np.uint8)
        for place in range(n):
            codes = (some >> _U(21 * (n - 1 - place))) & _U((1 << 21) - 1)
            seen, which = np.unique(codes, return_inverse=True)
            bits ^= np.roll(letter_vectors(seen, dims), place, axis=1)[which]
        counts = np.bincount(owner[lo:hi] * len(some) + at[lo:hi] - b * BLOCK, minlength=len(texts) * len(some))
        signs = bits.astype(np.float32)
        signs *= -2
        signs += 1
        out += counts.reshape(len(texts), len(some)).astype(np.float32) @ signs
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    has = np.zeros(len(texts), bool)
    has[owner] = True
    return out / np.where(norm > 0, norm, 1), has


def _batches(batch: pa.RecordBatch, rows: int = 128) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield from slices(batch.slice(start, rows), 4 << 20)


def _sums(n: int, dims: int):
    schema = pa.schema([("lang", pa.string()), ("dim", pa.int32()), ("value", pa.int64())])

    def flush(total: dict) -> pa.RecordBatch:
        langs = list(total)
        return record(schema, np.repeat(np.array(langs, object), dims), np.tile(np.arange(dims, dtype=np.int32), len(langs)),
                      np.concatenate([total[x] for x in langs]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in _batches(batch):
                units, has = bundle(part.column(0).to_pylist(), n, dims)
                units = np.rint(units * SCALE).astype(np.int64)
                for lang, unit, ok in zip(part.column(1).to_pylist(), units, has):
                    if ok:
                        total[lang] = total.get(lang, 0) + unit
                if len(total) > 256:
                    yield flush(total)
                    total = {}
        if total:
            yield flush(total)

    return run


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, n: int = 3, dims: int = 1024,
          max_languages: int = 1000) -> dict[str, np.ndarray]:
    """Prototypes (unit vectors) of the languages that lang_col names. Rows with
    null text or language, and texts without a letter, teach nothing. Tasks sum
    vectors; the driver gets dims numbers a language, and more than
    max_languages languages are an error."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("text is not null and lang is not null")
    sums = rows.mapInArrow(_sums(n, dims), "lang string, dim int, value long").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v")).orderBy("lang").limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    out = {r.lang: np.array([x.value for x in r.v], float) for r in found}
    return {lang: v / (np.linalg.norm(v) or 1) for lang, v in out.items()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", *, n: int = 3) -> DataFrame:
    """docs with a struct column ``language``: lang_pred (``und`` for null text,
    text without a letter, or without prototypes) and score, the cosine with
    that prototype in 0 to 1 (0 for ``und``). Ties go to the first language by
    code point. Whole texts are read; each row is judged by itself, so repeated
    rows agree. A column of docs named ``language`` is replaced."""
    own = [c for c in docs.columns if c != "language"]
    names = sorted(prototypes)
    dims = len(prototypes[names[0]]) if names else 64
    table = np.array([prototypes[x] for x in names], np.float32).reshape(len(names), dims)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            pred, score = [], []
            for lo in range(0, len(texts), 128):
                units, has = bundle(texts[lo : lo + 128], n, dims)
                cosine = units @ table.T
                for row, ok in zip(cosine, has):
                    best = int(row.argmax()) if ok and len(names) else None
                    pred.append(UNKNOWN if best is None else names[best])
                    score.append(0.0 if best is None else float(min(1, max(0, row[best]))))
            verdict = pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], verdict], names=[*batch.schema.names[:-1], "language"])

        return step

    # columns by place, so that no name of docs clashes with the text's
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)], F.col(f"`{text_col}`").cast("string").alias("text"))
    types = ", ".join([f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(own)] + ["language struct<lang_pred:string,score:double>"])
    out = map_rows(rows, make, types, 4 << 20)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)], "language")


def length_class(text: Column) -> Column:
    """Whole binary logarithm of the letters of a text; -1 without any."""
    letters_ = F.length(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\p{L}]", ""))
    return F.coalesce(F.floor(F.log2(letters_ + F.lit(0.0))), F.lit(-1)).cast("int")


def least_scores(judged: DataFrame, text_col: str = "text", lang_col: str = "lang", *, share: float = 0.01, margin: float = 0.75,
                 least_rows: int = 50, bins: int = 256) -> dict[str, dict[int, float]]:
    """Of predicted rows: for each language and length class the score under which
    a text is not of that language, margin times the quantile ``share`` of the
    scores of all rows whose label is predicted. A class of fewer than least_rows
    is pooled with the shorter ones, whose scores are lower, then with the longer;
    languages with fewer rows have none. Scores are counted by bins on Spark."""
    found: dict[str, dict[int, np.ndarray]] = {}
    rows = judged.where(F.col("language.lang_pred") == F.col(f"`{lang_col}`").cast("string"))
    for r in rows.groupBy(F.col("language.lang_pred").alias("lang"), length_class(F.col(f"`{text_col}`")).alias("k"),
                          F.least(F.floor(F.col("language.score") * bins), F.lit(bins - 1)).cast("int").alias("bin")).count().collect():
        found.setdefault(r.lang, {}).setdefault(r.k, np.zeros(bins, np.int64))[r.bin] += r["count"]
    out: dict[str, dict[int, float]] = {}
    for lang, classes in found.items():
        if sum(x.sum() for x in classes.values()) < least_rows:
            continue
        for k in classes:
            total = np.zeros(bins, np.int64)
            for other in sorted((x for x in classes if x <= k), reverse=True) + sorted(x for x in classes if x > k):
                total = total + classes[other]
                if total.sum() >= least_rows:
                    break
            at = int(np.searchsorted(np.cumsum(total), share * total.sum(), side="right"))
            out.setdefault(lang, {})[k] = margin * at / bins
    return out


def least_score(least: dict[str, dict[int, float]], text_col: str = "text", *, otherwise: float = 0.0) -> Column:
    """The least score of a predicted row: that of its language at its length, or
    at the nearest shorter length with one, else the nearest longer."""
    out = F.lit(float(otherwise))
    k = length_class(F.col(f"`{text_col}`"))
    for lang, classes in sorted(least.items()):
        value = F.lit(classes[min(classes)])
        for c in sorted(classes):
            value = F.when(k >= c, F.lit(classes[c])).otherwise(value)
        out = F.when(F.col("language.lang_pred") == lang, value).otherwise(out)
    return out
