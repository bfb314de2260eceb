"""Phrase collocations against counting every gram by itself."""

import random
import re
from collections import Counter

from logloom.llm import common, phrases

COLUMNS = "doc_id long, text string, lang string, gram string, k long, head string, f long"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, g, "clash", 1, "clash", 1) for i, (t, g) in enumerate(rows)], COLUMNS)


def _pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def _brute(rows, min_count, percent, top):
    out = []
    for lang in {g or "und" for _, g in rows}:
        f = Counter()
        for text, g in rows:
            if (g or "und") == lang:
                f.update(tuple(w[i : i + k]) for w in _pieces(text) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = []
        for g, a in f.items():
            if len(g) < 2 or a < min_count:
                continue
            if any(len(h) > len(g) and c >= min_count and 100 * c >= percent * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, c in f.items()):
                continue
            score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def _rows(n=150, seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "ß", "x-1", "中", "a\x00b"]
    chain = "it is what it is they say. so be it then"
    make = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!? ", "\x0b"]) for _ in range(rng.randint(0, 40)))
    return [((make() + chain if i % 3 == 0 else make()), rng.choice(["en", "fr", None])) for i in range(n)]


ODD = [(None, "en"), ("", "en"), (" \t.,\n", None), ("same same same same same", "fr"), ("same same same same same", "fr"), ("word " * 50_000, "de"), ("ÀB", "und")]


def test_against_counting(spark):
    rows = _rows() + ODD
    for min_count, percent, top in ((2, 80, 2000), (5, 50, 7)):
        got = phrases.collocations(_table(spark, rows), min_count=min_count, percent=percent, top=top).collect()
        assert sorted(tuple(r) for r in got) == _brute(rows, min_count, percent, top)


def test_small_batches_count_the_same(spark):
    rows = _rows(60)
    got = phrases.graph(_table(spark, rows), min_count=1, batch_bytes=500).collect()
    f = Counter()
    for text, g in rows:
        f.update((g or "und", " ".join(w[i : i + k])) for w in _pieces(text) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    assert {(r.lang, r.gram): r.f for r in got if r.k} == f and all(len(r.gram.split(" ")) == r.k for r in got if r.k)


def test_empty(spark):
    assert phrases.collocations(_table(spark, [])).count() == 0
    assert phrases.collocations(_table(spark, ODD[:3])).count() == 0


def test_paths(spark, monkeypatch):
    """A passage is one run; a ring's edges are runs of their own; runs are cut into chunks."""
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(passage, "en")] * 3 + [("a b c " * 9, "en")] + [("p q r s t. o q r s u", "fr")]
    grams = phrases.graph(_table(spark, rows), min_count=1)
    runs = sorted((r.lang, " ".join(r.words), tuple(r.flows)) for r in phrases.paths(grams).collect())
    assert ("en", passage, (3,) * 37) in runs
    # r has two words before it and two after: its node parts the runs
    assert [r for r in runs if r[0] == "fr"] == [("fr", x, (1,)) for x in ("o q r s", "p q r s", "q r s t", "q r s u")]
    ring = [r for r in runs if r[0] == "en" and r[1][0] in "abc"]
    assert len(ring) == 3 and all(len(f) == 1 for _, _, f in ring)
    monkeypatch.setattr(phrases, "CHUNK", 10)
    cut = {r.chunk: (r.words[0], r.words[-1], len(r.flows)) for r in phrases.paths(grams).collect() if len(r.flows) > 1 or r.chunk}
    assert cut == {0: ("w0", "w12", 10), 1: ("w10", "w22", 10), 2: ("w20", "w32", 10), 3: ("w30", "w39", 7)}
    want = phrases._longer_at_nodes(phrases.paths(grams)).collect()
    monkeypatch.undo()
    assert sorted(map(tuple, want)) == sorted(map(tuple, phrases._longer_at_nodes(phrases.paths(grams)).collect()))


def test_scores_past_64_bits(spark):
    big = 3 * 10**18
    row = spark.createDataFrame([(big, big + 1, big + 5)], "f long, a long, b long").select(phrases._score(("a", "b")).alias("s")).first()
    assert row.s.score == 2_000_000 * big // (2 * big + 6)


def test_rare_words_and_nodes_are_not_stored_whole(spark, monkeypatch):
    stored = []

    def stage(df, compression=None):
        out = common.stage(df, compression)
        stored.append(out)
        return out

    monkeypatch.setattr(phrases, "stage", stage)
    texts = ["a b c d"] * 4 + [f"a b x{i} y{i}" for i in range(20)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    found = {(r.k, r.gram): r.f for r in phrases.graph(docs, min_count=4).collect()}
    # collisions aside, the filters keep a, b, c, d and part the pieces at the others
    assert found == {(0, None): 96, (1, "a"): 24, (1, "b"): 24, (1, "c"): 4, (1, "d"): 4, (2, "a b"): 24, (2, "b c"): 4, (2, "c d"): 4,
                     (3, "a b c"): 4, (3, "b c d"): 4, (4, "a b c d"): 4}
    words = stored[0].collect()
    assert sorted(r.f for r in words if r.lang is None) == [4, 4, 24, 24] and [r.f for r in words if r.lang] == [96]
    # the 20 rare grams that pass filters without bits leave no third word
    monkeypatch.setattr(phrases.Filter, "__call__", lambda self, h: h == h)
    stored.clear()
    assert {(r.k, r.gram): r.f for r in phrases.graph(docs, min_count=4).collect()} == found
    heads = {r.head for r in stored[1].collect() if r.head}
    assert heads and all(h.count(" ") < 2 for h in heads if "x" in h)
