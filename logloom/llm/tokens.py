"""Token ids of whole texts by a public byte-level tokenizer file.

Texts are cut as the tokenizer's own pattern cuts them, and merges never cross
a cut, so the joined ids of the splits are those of the whole text. A batch of
texts is cut at once: a table gives each character its class, the cuts are
array expressions over neighbouring classes, Arrow numbers the distinct splits
(the splits are offsets into the batch's bytes, nothing is copied), and each
split is encoded once a worker process, whose next tasks find it known
(``SPLIT_CACHE`` bounds the memory). Texts with
characters outside ``PLAIN`` or with a special token are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa

#: Splits whose ids a worker process keeps; beyond it the cache starts anew.
SPLIT_CACHE = 1 << 19
#: Splits that the tokenizer encodes at a time, and bytes of texts that are best
#: encoded at once: the arrays of a batch are many times its size, and a worker
#: process seldom gives that memory back.
LEARN, TEXTS = 4096, 1 << 20
#: Characters that every Unicode version classes alike.
PLAIN = re.compile(r"[\t\n\r\x20-\x7E\xA1-\xA9\xBF-\u024F]*")
SPECIAL = "<|endoftext|>"
#: Classes of the characters up to U+024F, as the tokenizer's pattern has them.
SPACE, LETTER, DIGIT, OTHER = range(4)
CLASSES = np.array([SPACE if c.isspace() else LETTER if c.isalpha() else DIGIT if c.isdecimal() else OTHER for c in map(chr, range(0x250))], np.uint8)
#: The endings that the pattern cuts off with their apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def cuts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where splits begin in the code points of texts laid end to end, each
    beginning at one of starts (no text is empty).

    A split is a run of letters, of digits or of other characters, with the one
    blank before it; the white space left is a split of its own, and of white space
    before a text's next character the last one is set apart. An apostrophe
    that begins a run takes one of ENDINGS that follows it.
    """
    n = len(points)
    kind = CLASSES[points]
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    space, blank = kind == SPACE, points == 0x20
    begin = first[:n].copy()
    # a new class, unless the blank before belongs to the run
    begin[1:] |= (kind[1:] != kind[:-1]) & ~(blank[:-1] & ~first[1:n])
    # the last white space of several before another character
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])
    begin[last] = True
    quote = np.flatnonzero(points == ord("'"))
    quote = quote[begin[quote]]  # begins its split, with no blank before it
    for ending in ENDINGS:
        size = len(ending) + 1
        at = quote[quote + size <= n]
        for i, c in enumerate(ending, 1):
            at = at[(points[at + i] == ord(c)) & ~first[at + i]]
        begin[at + 1] = False
        begin[at[at + size < n] + size] = True
    return np.flatnonzero(begin)


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """The worker process's encoder of a tokenizer file: read once, not once a task."""
    return Encoder(path)


class Encoder:
    """Calls give the little-endian uint32 ids of each of some texts as bytes."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        self.forget()

    def forget(self) -> None:
        """Empty the cache: places of the known splits, and per place where its ids begin and how many."""
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, "<u4")
        self.base = self.size = np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and SPECIAL not in t and (t.isascii() and t.isprintable() or PLAIN.fullmatch(t))]
        for i in {i for i, t in enumerate(texts) if t}.difference(plain):
            out[i] = np.array(self.whole([texts[i]])[0], "<u4").tobytes()
        if plain:
            for i, ids in zip(plain, self.split([texts[i] for i in plain])):
                out[i] = ids.tobytes()
        return out

    def learn(self, splits: list[str]) -> None:
        self.known.update(zip(splits, range(len(self.known), len(self.known) + len(splits))))
        sizes, ids = [], []
        # the tokenizer's own record of a split is large: a few at a time
        for lo in range(0, len(splits), LEARN):
            some = splits[lo : lo + LEARN]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
            ids.append(np.array(found.ids, "<u4"))
        size = np.concatenate(sizes)
        self.base = np.concatenate((self.base, len(self.ids) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.ids = np.concatenate((self.ids, *ids))

    def split(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of plain, not empty texts, through their distinct splits."""
        if len(self.known) >= SPLIT_CACHE:
            self.forget()
        joined = "".join(texts)
        data = joined.encode()
        starts = np.cumsum([0] + [len(t) for t in texts])
        if joined.isascii():
            points = np.frombuffer(data, np.uint8)
            at = begin = cuts(points, starts[:-1])
        else:  # characters below U+0250 take one or two bytes
            points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            begin = cuts(points, starts[:-1])
            wide = points > 0x7F
            at = begin + np.cumsum(wide, dtype=np.int32)[begin] - wide[begin]
        offsets = np.append(at, len(data)).astype(np.int64)
        found = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        splits = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        # one look for each distinct split; those not known yet are numbered in their order
        place, new = list(map(self.known.get, splits)), []
        if None in place:
            new = [s for s, p in zip(splits, place) if p is None]
            fresh = iter(range(len(self.known), len(self.known) + len(new)))
            place = [next(fresh) if p is None else p for p in place]
            self.learn(new)
        place = np.array(place, np.int64)[found.indices.to_numpy()]
        lengths = self.size[place]
        ends = np.cumsum(lengths)
        flat = self.ids[np.repeat(self.base[place] - (ends - lengths), lengths) + np.arange(ends[-1])]
        bounds = np.append(0, ends)[np.searchsorted(begin, starts)]
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
