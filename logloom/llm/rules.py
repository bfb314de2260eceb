"""Quality rules: text statistics and a learned decision list, all in Spark columns.

The statistics are array and string functions over the whole text. The list is
learned by sequential covering: a rule, a conjunction of thresholds on the
statistics, is grown condition by condition for information gain, pruned on
rows held back from the growing, kept if it is precise there, and the rows it
covers leave the sample before the next rule. The list is then one ordered
``CASE WHEN`` expression over the statistics.

Only the labelled sample reaches the driver, and ``max_labelled`` bounds it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Symbols counted as junk.
SYMBOLS = "#*$%&|<>"
#: ASCII white space, which separates words.
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "[A-Z]+"


def _ratio(a: str, b: str):
    return lambda s: F.coalesce(F.try_divide(s[a].cast("double"), s[b].cast("double")), F.lit(0.0))


#: Statistics that rules may test, as functions of the ``stats`` struct.
FEATURES = {
    "words": lambda s: s["n_words"].cast("double"),
    "word_length": _ratio("word_chars", "n_words"),
    "symbols_per_word": _ratio("n_symbols", "n_words"),
    "capitals_per_char": _ratio("n_capitals", "word_chars"),
    "exclaims_per_word": _ratio("n_exclaims", "n_words"),
    "duplicate_lines": _ratio("n_dup_lines", "n_lines"),
    "repeated_words": _ratio("n_repeat_words", "n_words"),
    "words_per_line": _ratio("n_words", "n_lines"),
}


def _repeat_places(order: Column) -> Column:
    """Of windows (h, i) in the order of their hashes: the places, sorted, of
    those whose hash comes twice or more."""
    again = F.transform(order, lambda x, j: F.when(
        (x["h"] == F.get(order, j - 1)["h"]) | (x["h"] == F.get(order, j + 1)["h"]), x["i"]))
    return F.sort_array(F.filter(again, lambda i: i.isNotNull()))


def _covered(at: Column) -> Column:
    """Words in the three-word windows at the sorted places ``at``."""
    new = F.transform(at, lambda i, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), i - F.get(at, j - 1))))
    return F.aggregate(new, F.lit(0), lambda a, x: a + x)


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_capitals (A-Z), n_exclaims,
    n_lines (lines with a word), n_dup_lines and n_repeat_words (long) of the
    whole text in a struct column ``stats``; null text counts as empty. Columns
    of docs stay, but for one named ``stats``.

    Each step is a projection of its own: Spark does not merge one whose result
    is used more than once, so arrays are built once a row and the functions
    outside the lambdas are compiled. Only texts with a repeated window sort
    their windows.
    """
    kept = [c for c in docs.columns if c != "stats"]
    # the input is one struct, so its names cannot clash with those of the steps
    start = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in") if kept else F.lit(None).alias("_in"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    body = F.btrim("t", F.lit(BLANKS))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    step = start.select("_in", "t", F.when(body != "", F.split(body, SPACE)).otherwise(F.array().cast("array<string>")).alias("w"), lines.alias("x"))
    n = F.size("w")
    pairs = F.zip_with("w", F.slice("w", F.lit(2), n), lambda a, b: F.xxhash64(a, b))
    step = step.select("*", pairs.alias("p")).select("_in", "t", "w", "x", F.slice(F.zip_with(
        "p", F.slice("w", F.lit(3), n), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(n - 2, F.lit(0))).alias("h"))
    order = F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = step.select("_in", "t", n.alias("n"), F.size("x").alias("lines"), (F.size("x") - F.size(F.array_distinct("x"))).alias("dup"), order.alias("o"))
    step = step.select("*", F.when(F.col("o").isNotNull(), _repeat_places(F.col("o"))).alias("at"))
    values = {
        "n_words": F.col("n"),
        "word_chars": F.length(_without(F.col("t"), BLANKS)),
        "n_symbols": F.length("t") - F.length(_without(F.col("t"), SYMBOLS)),
        "n_capitals": F.length("t") - F.length(F.regexp_replace("t", CAPITALS, "")),
        "n_exclaims": F.length("t") - F.length(_without(F.col("t"), "!")),
        "n_lines": F.col("lines"),
        "n_dup_lines": F.col("dup"),
        "n_repeat_words": F.when(F.col("at").isNull(), F.lit(0)).otherwise(_covered(F.col("at"))),
    }
    # a generator's output is computed once a row: a filter on it is not pushed
    # down to the scan, where Spark would copy every step into it
    counted = step.select("_in", F.inline(F.array(F.struct(F.struct(*[v.cast("long").alias(k) for k, v in values.items()]).alias("stats")))))
    return counted.select(*[F.col("_in")[c].alias(c) for c in kept], "stats")


def base_failed(stats: str = "stats") -> Column:
    """The fixed rules: fewer than 50 words, or more than half of the words in
    three-word windows that come twice."""
    return F.expr(f"{stats}.n_words < 50 or 100 * {stats}.n_repeat_words > 50 * {stats}.n_words")


@dataclass(frozen=True)
class Rule:
    """Reject when every condition (feature, '<=' or '>', threshold) holds."""

    conditions: tuple[tuple[str, str, float], ...]

    def __str__(self) -> str:
        return " and ".join(f"{name} {op} {value:.6g}" for name, op, value in self.conditions)

    def column(self, stats: str = "stats") -> Column:
        out = F.lit(True)
        for name, op, value in self.conditions:
            x = FEATURES[name](F.col(stats))
            out &= x <= value if op == "<=" else x > value
        return out

    def covers(self, table: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(table), bool)
        for name, op, value in self.conditions:
            x = table[:, names.index(name)]
            out &= x <= value if op == "<=" else x > value
        return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], max_conditions: int) -> list[tuple[str, str, float]]:
    """Conditions, each the one of most information gain on the rows left."""
    rule: list[tuple[str, str, float]] = []
    while len(rule) < max_conditions and bad.any() and not bad.all():
        before, best = np.log2(bad.mean()), (1e-9, None)
        for f, name in enumerate(names):
            values = np.unique(x[:, f])
            cuts = (values[:-1] + values[1:]) / 2
            if len(cuts) > 128:
                cuts = np.unique(cuts[np.linspace(0, len(cuts) - 1, 128).astype(int)])
            order = np.argsort(x[:, f], kind="stable")
            at = np.searchsorted(x[order, f], cuts, side="right")
            bad_below = np.r_[0, np.cumsum(bad[order])][at]
            for op, p, n in (("<=", bad_below, at), (">", bad.sum() - bad_below, len(bad) - at)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where((p > 0) & (n > 0), p * (np.log2(p / n) - before), 0)
                if len(gain) and gain.max() > best[0]:
                    i = int(gain.argmax())
                    best = (gain[i], (name, op, float(cuts[i])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside = Rule((best[1],)).covers(x, names)
        x, bad = x[inside], bad[inside]
    return rule


def learn(rows: list[tuple], names: list[str], *, max_rules: int = 8, max_conditions: int = 3, min_precision: float = 0.9,
          min_covered: int = 3) -> list[Rule]:
    """A decision list from rows (label is bad, held back for pruning, statistics
    in the order of names): rules that reject, in the order they were found."""
    if not rows:
        return []
    bad = np.array([bool(r[0]) for r in rows])
    held = np.array([bool(r[1]) for r in rows])
    x = np.array([r[2:] for r in rows], float)
    rules: list[Rule] = []
    while len(rules) < max_rules and bad.any():
        conditions = _grow(x[~held], bad[~held], names, max_conditions)
        best = None
        for k in range(1, len(conditions) + 1):  # prune: the shortest of the best prefixes on the rows held back
            rule = Rule(tuple(conditions[:k]))
            inside = rule.covers(x, names)
            p, n = int((inside & held & bad).sum()), int((inside & held).sum())
            worth = (p + 1) / (n + 2)
            if best is None or worth > best[0] + 1e-12:
                best = (worth, rule, inside)
        if best is None:
            break
        _, rule, inside = best
        if inside.sum() < min_covered or bad[inside].mean() < min_precision:
            break
        rules.append(rule)
        x, bad, held = x[~inside], bad[~inside], held[~inside]
    return rules


def learn_from(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
               max_labelled: int = 20_000, **limits) -> list[Rule]:
    """Learn from the documents that labels (id_col, label_col: 0 bad, 1 good)
    covers and that pass the fixed rules. At most max_labelled labelled ids are
    used, in the order of the md5 of the id, so only they are broadcast and only
    their texts are read. Ids with null or contradicting labels are left out; no
    labels give an empty list."""
    sample = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg(F.min(label_col).alias("_lo"), F.max(label_col).alias("_hi"))
        .where("_lo = _hi")
        .orderBy(F.md5(F.col("_id").cast("string")), "_id")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_body"))
    table = text_statistics(texts.join(F.broadcast(sample), "_id"), "_body")
    names = list(FEATURES)
    rows = table.select(base_failed(), "_id", F.col("_lo") == 0, F.pmod(F.crc32(F.md5(F.col("_id").cast("string")).cast("binary")), F.lit(3)) == 0,
                        *[f(F.col("stats")) for f in FEATURES.values()])
    found = [tuple(r)[2:] for r in sorted(rows.collect(), key=tuple) if not r[0]]
    return learn(found, names, **limits)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """docs with ``stats`` and a struct ``verdict``: base_failed, rule (text of
    the first rule that rejects, else null) and kept. Empty and null texts fail
    the fixed rules. Rows are judged one by one: repeated rows stay repeated."""
    table = text_statistics(docs, text_col)
    own = [F.col(f"`{c}`") for c in table.columns if c != "verdict"]
    hit = F.lit(None).cast("string")
    for rule in reversed(rules):
        hit = F.when(rule.column(), F.lit(str(rule))).otherwise(hit)
    failed = base_failed()
    return table.select(*own, F.struct(
        failed.alias("base_failed"), hit.alias("rule"), (~failed & hit.isNull()).alias("kept")).alias("verdict"))
