"""Language-model scores by logistic context mixing.

A token is a word and a closing space, or the end mark alone. It is coded bit by
bit: for every bit, several predictors look up how often it was 0 and 1 in their
context (none, the last one, two or three bytes, the whole prefix of the word),
hashed into tables of fixed size; a mixer adds their stretched probabilities
with weights that a gate selects, learned online, and a last adaptive stage
corrects the mixed probability by what followed alike ones.

What is spelled is a word that no other predictor knows. In running text a token
comes from one of six sources: what followed the same word earlier in this text,
this text's earlier words, what followed the same word in all training texts,
what followed the same last bytes over the space there, the corpus' words, or
spelling. Which source it is, is a row of bits that are summed over; the
probability of each is mixed like the others, from the sources' records in the
text so far, gated by how much the source has seen, and corrected by a last
adaptive stage.

All training documents are counted, each occurrence once: words, and tokens by
the hash of their context (64 bits, so that contexts do not share counts), by
blocks of documents and then over the corpus; the counts return to each block.
Both mixers learn online over all training text, partition by partition and block
by block, each text without its own counts; their weights are averaged by visits
and their adaptive counts summed by slot. Only the spelling's hashed tables
(``slot_bits``) and the mixers' weights reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLD, map_rows, mix64, record, slices, stage

_U = np.uint64
SPACE, END = b" ", b"\n"
ORDERS = 5
#: Bits coded together.
EVENTS = 1 << 18
GATES = 12
STEPS = 33


def _events(tokens: list[bytes], slot_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the bits of all tokens, in order: slots (ORDERS, bits), the bit, and the token's index."""
    sizes = np.array([len(t) for t in tokens])
    data = np.frombuffer(b"".join(tokens), np.uint8)
    owner = np.repeat(np.arange(len(tokens)), sizes)
    at = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    wide = data.astype(_U)

    def back(k: int) -> np.ndarray:  # the byte k places before, 0 before the start of the word
        out = np.zeros(len(data), _U)
        out[k:] = wide[: len(data) - k] if k else wide
        out[at < k] = 0
        return out

    with np.errstate(over="ignore"):
        b1, b2, b3 = back(1), back(2), back(3)
        contexts = [np.minimum(at, 1).astype(_U), b1, b1 | b2 << _U(8), b1 | b2 << _U(8) | b3 << _U(16)]
        # whole prefix: a hash that grows byte by byte, for all words at the same place at once
        prefix = np.zeros(len(data), _U)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(1, (sizes.max() if len(sizes) else 0) + 1))
        for place in range(1, len(cuts)):
            here = order[cuts[place - 1] : cuts[place]]
            prefix[here] = mix64(prefix[here - 1] * _U(257) + wide[here - 1] + _U(1))
        contexts.append(prefix)
        hashed = [mix64(c * _U(0x100000001B3) + _U(o + 1) * GOLD) for o, c in enumerate(contexts)]
        node = np.concatenate([(1 << k) | (data >> (8 - k)).astype(np.int64) for k in range(8)]).reshape(8, -1).T.reshape(-1)
        slots = np.stack([
            (mix64(np.repeat(h, 8) + node.astype(_U) * _U(0xD1B54A32D192ED03)) >> _U(64 - slot_bits)).astype(np.int64) for h in hashed])
    bits = np.unpackbits(data)
    return slots, bits, np.repeat(owner, 8)


def _chunks(tokens: list[bytes]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(tokens):
        if total and total + len(t) > EVENTS // 8:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(tokens):
        yield start, len(tokens)


def _counts(slot_bits: int):
    """Of (word, c): counts of bits 0 and 1 by slot of all predictors."""
    schema = pa.schema([("slot", pa.int32()), ("n0", pa.int64()), ("n1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << slot_bits
        total = np.zeros((2, ORDERS * size), np.int64)
        flat = total.reshape(-1)
        for batch in batches:
            for part in slices(batch, 4 << 20):
                tokens, c = part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False)
                for lo, hi in _chunks(tokens):
                    slots, bits, owner = _events(tokens[lo:hi], slot_bits)
                    n, side = c[lo:hi][owner], bits.astype(np.int64) * (ORDERS * size)
                    for o in range(ORDERS):
                        np.add.at(flat, side + (slots[o] + o * size), n)
        seen = np.flatnonzero(total.any(axis=0))
        for lo in range(0, len(seen), 1 << 16):
            s = seen[lo : lo + (1 << 16)]
            yield record(schema, s.astype(np.int32), total[0][s], total[1][s])

    return run


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -14, 14)))


class Mixer:
    """Gated logistic mixing of the predictors' counts, and the last adaptive stage."""

    def __init__(self, tables: np.ndarray):
        self.tables = tables  # (2, ORDERS, slots), float32
        self.stretched = None
        self.weights = np.full((GATES, ORDERS), 0.3)
        self.visits = np.zeros(GATES)
        grid = _squash(np.linspace(-12, 12, STEPS))
        self.adapt = np.stack([grid * 64, (1 - grid) * 64])  # ones and zeros seen at each step

    def inputs(self, slots: np.ndarray, own: np.ndarray | None = None, bits: np.ndarray | None = None):
        """Stretched probabilities (ORDERS, bits) and gates; own is how often the bits' word occurs, to leave it out."""
        if own is None:
            if self.stretched is None:
                self.stretched = self.stretch(*self.tables), _log2(1 + self.tables[:, -1].sum(axis=0), GATES)
            return np.stack([table.take(at) for table, at in zip(self.stretched[0], slots)]), self.stretched[1].take(slots[-1])
        n0, n1 = (np.stack([np.maximum(0, table.take(at) - mine) for table, at in zip(tables, slots)]) for tables, mine in zip(self.tables, (own * (bits == 0), own * (bits == 1))))
        return self.stretch(n0, n1), _log2(1 + n0[-1] + n1[-1], GATES)

    @staticmethod
    def stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
        return np.clip(np.log((n1.astype(float) + 0.02) / (n0 + 0.02)), -12, 12)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"stretched": None}

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(sum(a * w.take(gate) for a, w in zip(x, self.weights.T.copy())), -12, 12)

    def refine(self, z: np.ndarray) -> np.ndarray:
        at = (z + 12) * (STEPS - 1) / 24
        lo = np.minimum(at.astype(int), STEPS - 2)
        rate = self.adapt[0] / self.adapt.sum(axis=0)
        part = at - lo
        return np.clip((_squash(z) + (1 - part) * rate[lo] + part * rate[lo + 1]) / 2, 1e-7, 1 - 1e-7)

    def learn(self, tokens: list[bytes], counts: np.ndarray, slot_bits: int, rate: float = 0.006, step: int = 2048) -> None:
        """One online pass over words; a word weighs by its count."""
        share = np.minimum(counts / max(counts.mean(), 1e-9), 50.0)
        for lo, hi in _chunks(tokens):
            slots, bits, owner = _events(tokens[lo:hi], slot_bits)
            x, gate = self.inputs(slots, counts[lo:hi][owner], bits)
            weigh = share[lo:hi][owner]
            for s in range(0, len(bits), step):
                e = slice(s, s + step)
                z = self.mixed(x[:, e], gate[e])
                error = (bits[e] - _squash(z)) * weigh[e]
                many = np.bincount(gate[e], weigh[e], GATES)[:, None]
                self.visits += many[:, 0]
                move = np.stack([np.bincount(gate[e], error * a[e], GATES) for a in x], axis=1)
                self.weights += rate * move / np.maximum(many, 1) * np.minimum(many, 64) / 8
                near = np.rint((z + 12) * (STEPS - 1) / 24).astype(int)
                self.adapt[0] += np.bincount(near, weigh[e] * bits[e], STEPS)
                self.adapt[1] += np.bincount(near, weigh[e] * (1 - bits[e]), STEPS)

    def log10(self, tokens: list[bytes], slot_bits: int) -> np.ndarray:
        out = np.zeros(len(tokens))
        for lo, hi in _chunks(tokens):
            slots, bits, owner = _events(tokens[lo:hi], slot_bits)
            p = self.refine(self.mixed(*self.inputs(slots)))
            out[lo:hi] = np.bincount(owner, np.log10(np.where(bits == 1, p, 1 - p)), hi - lo)
        return out


def _log2(x: np.ndarray, levels: int) -> np.ndarray:
    """The whole part of the binary logarithm of x >= 1, below levels."""
    return np.minimum(np.frexp(x)[1].astype(np.int64) - 1, levels - 1)


def _ordered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers from 0 on in order, their places (equal ones ascending), and where each new one starts."""
    n = len(x)
    shift = n.bit_length()
    if n and int(x.max()).bit_length() + shift < 63:
        y = np.sort(x << shift | np.arange(n))
        order, y = y & ((1 << shift) - 1), y >> shift
    else:
        order = np.argsort(x, kind="stable")
        y = x[order]
    return y, order, np.flatnonzero(np.r_[True, y[1:] != y[:-1]]) if n else np.zeros(0, np.int64)


def _unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` of numbers from 0 on with the inverse."""
    y, order, starts = _ordered(x)
    which = np.empty(len(x), np.int64)
    which[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)]))
    return y[starts], which


def _earlier(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each number came before in x, and how often it is in x."""
    _, order, starts = _ordered(x)
    sizes = np.diff(np.r_[starts, len(x)])
    before, times = np.empty(len(x)), np.empty(len(x), np.int64)
    before[order] = np.arange(len(x)) - np.repeat(starts, sizes)
    times[order] = np.repeat(sizes, sizes)
    return before, times


#: Sources of a token but spelling, the last one: in the order in which their bits are asked.
SOURCES = 5
LEVELS = 16


class _Places(dict):
    """A number for each new key."""

    def __missing__(self, key: bytes) -> int:
        found = self[key] = len(self)
        return found


def running(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, END first and the start of a text (empty) second; and of all tokens
    the word's place, and of each text how many tokens it has."""
    place = _Places({END: 0, b"": 1})
    at, sizes, last = [], [], np.zeros(1, np.int32)
    for text in texts:
        found = text.lower().split()
        at += np.fromiter(map(place.__getitem__, found), np.int32, len(found)), last
        sizes.append(len(found) + 1)
    return list(place), np.concatenate(at), np.array(sizes, np.int64)


def _before(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The place of the word before each token."""
    out = np.r_[1, at[:-1]]
    out[np.cumsum(sizes)[:-1]] = 1
    return out


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


def contexts(words: list[bytes], word: np.ndarray, at: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """64-bit hashes of a block's contexts, from those of its words: token after the word before, token
    after that word's last two bytes over the space, and those bytes alone. Each
    once, ascending; and of each of the three kinds the tokens' places among
    them. Third, the words' ends, numbered."""
    width, ends = len(words), _Places()
    end = np.fromiter((ends[w[-2:]] for w in words), np.int64, width)
    last = np.array([xxhash.xxh3_64_intdigest(e, 1) for e in ends], _U)
    pair, pair_at = _unique(before.astype(np.int64) * width + at)
    first, second = pair // width, pair % width
    close, close_at = _unique(end[first] * width + second)
    with np.errstate(over="ignore"):
        keys = np.concatenate([mix64(mix64(word[first] + GOLD) + word[second]), mix64(mix64(last[close // width] + GOLD * _U(3)) + word[close % width]),
                               mix64(last + GOLD * _U(5))])
    order = np.argsort(keys)
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    in_pair, in_close, in_ends = np.split(place, [len(pair), len(pair) + len(close)])
    return keys[order], [in_pair[pair_at], in_close[close_at][pair_at], in_ends[end[before]]], end


def _packed(x: np.ndarray, kind: str) -> bytes:
    """Numbers for a shuffle: byte planes, compressed."""
    x = np.ascontiguousarray(x, kind)
    planes = np.empty((x.itemsize, len(x)), np.uint8)
    for k, plane in enumerate(planes):
        plane[:] = x.view(np.uint8)[k :: x.itemsize]
    return len(x).to_bytes(8, "little") + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(x) else b"")


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    kind, n = np.dtype(kind), int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, kind)
    out = np.empty(n, kind)
    for k, plane in enumerate(np.frombuffer(pa.decompress(data[8:], n * kind.itemsize, "zstd", asbytes=True), np.uint8).reshape(-1, n)):
        out.view(np.uint8)[k :: kind.itemsize] = plane
    return out


def _joined(words: list[bytes]) -> bytes:
    return _packed(np.frombuffer(b"\n".join(words), np.uint8), "u1")


def _split(data: bytes) -> list[bytes]:
    joined = _unpacked(data, "u1").tobytes()
    return joined.split(b"\n") if joined else []


#: A block: PARTS runs of documents that the sources' mixer learns from together, unless they have more bytes.
PARTS = 4
BLOCK_BYTES = 8 << 20
BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("parts", pa.list_(pa.int64())), ("bytes", pa.list_(pa.int64())),
                    ("sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("at", pa.binary())])
BLOCKS_DDL = "block long, ids array<long>, held array<boolean>, parts array<long>, bytes array<long>, sizes array<long>, words binary, at binary"


def _block(rows: list[tuple]) -> pa.RecordBatch:
    ids, texts, held, numbers = zip(*rows)
    words, at, sizes = running(texts)
    return record(BLOCKS, [numbers[0]], [ids], [held], [[n >> 9 for n in numbers]], [[len(t) for t in texts]], [sizes], [_joined(words[2:])], [_packed(at, "<i4")])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, text, held_out, row): a row a block, its tokens as places in its words."""

    waiting, size, parts = [], 0, 0
    for batch in batches:
        for part in slices(batch, 4 << 20):
            for row in zip(*(c.to_pylist() for c in part.columns)):
                new = not waiting or row[3] >> 9 != waiting[-1][3] >> 9
                if waiting and (size + len(row[1]) > BLOCK_BYTES or new and parts == PARTS):
                    yield _block(waiting)
                    waiting, size, parts, new = [], 0, 0, True
                waiting.append(row)
                size, parts = size + len(row[1]), parts + new
    if waiting:
        yield _block(waiting)


def _tokens(block: dict) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words, places of the tokens and of those before, and whether they are learned from."""
    words, at, sizes = _split(block["words"]), _unpacked(block["at"], "<i4").astype(np.int64), np.array(block["sizes"], np.int64)
    return [END, b"", *words], at, _before(at, sizes), np.repeat(~np.array(block["held"], bool), sizes)


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of blocks, and how often each occurs in the block's training texts."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    for batch in batches:
        for part in slices(batch, 1):
            words, at, _, train = _tokens(part.to_pylist()[0])
            yield record(schema, words[2:], np.bincount(at[train], minlength=len(words))[2:])


def _dealt(hashed: np.ndarray, deal: int) -> np.ndarray:
    """Which of 2^deal shares a hash belongs to."""
    return (hashed >> _U(64 - deal)).astype(np.int64)


def _block_shares(deal: int, keys: bool):
    """Of a block, a row a share with the words of that share, or with its context
    hashes (as differences) and how often its training texts have them."""
    schema = pa.schema([("share", pa.int64()), ("block", pa.int64()), ("what", pa.binary()), ("n", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                block = part.to_pylist()[0]
                if keys:
                    words, at, before, train = _tokens(block)
                    found, which, _ = contexts(words, hashes(words), at, before)
                    n = sum(np.bincount(w[train], minlength=len(found)) for w in which)
                    share = _dealt(found, deal)
                else:
                    words = _split(block["words"])
                    order = np.argsort(share := _dealt(hashes(words), deal), kind="stable")
                    share, found = share[order], [words[i] for i in order.tolist()]
                cuts = np.searchsorted(share, np.arange((1 << deal) + 1))
                rows = [(s, block["block"], _packed(np.diff(found[lo:hi], prepend=_U(0)), "<u8") if keys else _joined(found[lo:hi]), _packed(n[lo:hi], "<i4") if keys else b"")
                        for s, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if hi > lo]
                if rows:
                    yield record(schema, *zip(*rows))

    return run


SHARES_DDL = "share long, block long, what binary, n binary"
RETURNED = pa.schema([("block", pa.int64()), ("share", pa.int64()), ("c", pa.binary()), ("lp", pa.binary())])
RETURNED_DDL = "block long, share long, c binary, lp binary"


def _key_counts(rows: pa.Table) -> pa.Table:
    """Of a share of all blocks' context hashes: how often all training texts have
    them, in the order in which each block gave them."""
    given = [np.cumsum(_unpacked(x, "<u8"), dtype=_U) for x in rows.column("what").to_pylist()]
    n = np.concatenate([_unpacked(x, "<i4") for x in rows.column("n").to_pylist()])
    cuts = np.cumsum([len(x) for x in given])[:-1]
    keys, which = np.unique(np.concatenate(given), return_inverse=True)
    c = np.bincount(which, n, len(keys)).astype(np.int64)[which]
    return pa.table([rows.column("block"), rows.column("share"), pa.array([_packed(x, "<i8") for x in np.split(c, cuts)], pa.binary()), pa.nulls(rows.num_rows, pa.binary())], schema=RETURNED)


def _word_counts(rows: pa.Table, scored: pa.Table) -> pa.Table:
    """Of a share of all blocks' words, and what is known of them: the corpus' counts
    and the spelling's log10 probabilities, in the order in which each block gave them."""
    place = {w: i for i, w in enumerate(scored.column("word").to_pylist())}
    c, lp = scored.column("c").to_numpy(), scored.column("lp").to_numpy()
    out = []
    for what in rows.column("what").to_pylist():
        words = _split(what)
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        out.append((_packed(c[at], "<i8"), _packed(lp[at], "<f4")))
    return pa.table([rows.column("block"), rows.column("share"), *(pa.array([x[i] for x in out], pa.binary()) for i in (0, 1))], schema=RETURNED)


class Sources:
    """Gated logistic mixing of the bits that choose a token's source, and their last adaptive stage."""

    SHAPES = ((SOURCES, LEVELS, SOURCES + 1), (SOURCES, LEVELS), (2, SOURCES, STEPS))

    def __init__(self):
        self.weights, self.visits = np.zeros(self.SHAPES[0]), np.zeros(self.SHAPES[1])
        for k in range(SOURCES):
            self.weights[k, :, k] = 0.5
        grid = np.tile(_squash(np.linspace(-12, 12, STEPS)), (SOURCES, 1))
        self.prior = np.stack([grid * 64, (1 - grid) * 64])
        self.adapt = np.zeros_like(self.prior)
        self.moved = np.full(self.SHAPES[0], 1e-4)

    def pack(self) -> np.ndarray:
        """What is summed over blocks: weights by visits, visits, adaptive counts."""
        return np.concatenate([(self.weights * self.visits[:, :, None]).ravel(), self.visits.ravel(), self.adapt.ravel()])

    @classmethod
    def merged(cls, total: np.ndarray) -> "Sources":
        out = cls()
        weights, out.visits, out.adapt = (x.reshape(shape) for x, shape in zip(np.split(total, np.cumsum([int(np.prod(s)) for s in cls.SHAPES])[:-1]), cls.SHAPES))
        met = out.visits > 0
        out.weights[met] = weights[met] / out.visits[met][:, None]
        return out

    def refined(self, k, z: np.ndarray) -> np.ndarray:
        at = (z + 12) * (STEPS - 1) / 24
        lo = np.minimum(at.astype(int), STEPS - 2)
        ones, zeros = self.prior + self.adapt
        rate, part = (ones / (ones + zeros)).ravel(), at - lo
        lo = lo + STEPS * k
        return np.clip((_squash(z) + (1 - part) * rate.take(lo) + part * rate.take(lo + 1)) / 2, 1e-6, 1 - 1e-6)

    @staticmethod
    def estimates(owner, at, before, c, n, m, followed, lasts, total, earlier=None):
        """Probabilities (SOURCES, tokens) of the tokens in each source, how much
        the source has seen (0: nothing, so it cannot be the one), and the inputs.
        earlier: how often the token's pair, the token and the word before came
        before as such in the text, where that is known."""
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        first = np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
        past = np.arange(len(at)) - first
        if earlier is None:
            width = int(max(at.max(), before.max())) + 1
            earlier = [_earlier(x)[0] for x in ((owner * width + before) * width + at, owner * width + at, owner * width + before)]
        pair, seen, context = earlier
        top = np.stack([pair, seen, n, m, c]).astype(float)
        below = np.stack([context, past, followed, lasts, np.broadcast_to(total, len(at))]).astype(float)
        q = np.divide(top, below, out=np.zeros_like(top), where=below > 0)
        hits, tries = np.cumsum(q > 0, axis=1) - (q > 0), np.cumsum(below > 0, axis=1) - (below > 0)
        hits -= hits.take(first, axis=1)
        tries -= tries.take(first, axis=1) + hits  # of them, those that did not hold the token
        half = np.log(np.arange(past.max() + 2) + 0.5)
        x = np.concatenate([half.take(hits) - half.take(tries), np.ones((1, len(at)))])
        return np.minimum(q, 1), below, x

    def mixed(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """at: gates, numbered over all sources."""
        return np.clip(sum(a * w.take(at) for a, w in zip(x, np.moveaxis(self.weights, 2, 0).reshape(len(x), -1))), -12, 12)

    def bits(self, below: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = _log2(1 + below, LEVELS) + LEVELS * np.arange(SOURCES)[:, None]
        return at, self.mixed(at, x), below > 0

    def log10(self, q, below, x, lp, step: int = 1 << 13) -> np.ndarray:
        """log10 probabilities of the tokens, with lp that of their spelling."""
        out = np.empty(len(lp))
        for s in range(0, len(lp), step):
            e = slice(s, s + step)
            _, z, can = self.bits(below[:, e], x[:, e])
            p = self.refined(np.arange(SOURCES)[:, None], z) * can
            left, known = 1.0, 0.0
            for k in range(SOURCES):
                known = known + left * p[k] * q[k, e]
                left = left * (1 - p[k])
            with np.errstate(divide="ignore"):
                out[e] = np.logaddexp(np.log(known), np.log(left) + lp[e] * np.log(10)) / np.log(10)
        return out

    def learn(self, q, below, x, lp, step: int = 1024, rate: float = 0.1) -> None:
        """One online pass; a bit's share of a token is the probability that it was asked."""
        gates, can_be, spelled = _log2(1 + below, LEVELS) + LEVELS * np.arange(SOURCES)[:, None], below > 0, 10 ** np.maximum(lp, -250)
        ladder = STEPS * np.arange(SOURCES)[:, None]
        for s in range(0, len(lp), step):
            e = slice(s, s + step)
            at, can = gates[:, e], can_be[:, e]
            z = self.mixed(at, x[:, e])
            p = _squash(z) * can
            parts, left = np.empty((SOURCES + 1, z.shape[1])), 1.0
            for k in range(SOURCES):
                parts[k] = left * p[k] * q[k, e]
                left = left * (1 - p[k])
            parts[-1] = left * spelled[e]
            asked = np.cumsum(parts[::-1], axis=0)[::-1]
            share = can / np.maximum(asked[0], 1e-300)
            weigh, yes = asked[:-1] * share, parts[:-1] * share
            at, near = at.ravel(), (np.rint((z + 12) * (STEPS - 1) / 24).astype(int) + ladder).ravel()
            off = yes - weigh * p
            move = np.stack([np.bincount(at, (off * a).ravel(), SOURCES * LEVELS) for a in x[:, e]], axis=1).reshape(self.moved.shape)
            self.moved += move**2
            self.weights += rate * move / np.sqrt(self.moved)
            self.visits += np.bincount(at, weigh.ravel(), SOURCES * LEVELS).reshape(self.visits.shape)
            for k, found in enumerate((yes, weigh - yes)):
                self.adapt[k] += np.bincount(near, found.ravel(), SOURCES * STEPS).reshape(SOURCES, STEPS)


def _text_chunks(sizes: list[int], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most about ``most`` bytes; one text may exceed it."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _spelling(known: DataFrame, tables: np.ndarray, slot_bits: int) -> Mixer:
    """The spelling's mixer, learned online over all words by partition; weights
    are averaged by visits and adaptive counts summed by slot."""
    spark = known.sparkSession
    shared = spark.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = Mixer(shared.value)
        prior = mixer.adapt.copy()
        for batch in batches:
            for part in slices(batch, 1 << 20):
                mixer.learn([w + SPACE for w in part.column(0).to_pylist()], part.column(1).to_numpy(zero_copy_only=False).astype(float), slot_bits)
        if mixer.visits.any():
            yield _numbered(np.concatenate([(mixer.weights * mixer.visits[:, None]).ravel(), mixer.visits, (mixer.adapt - prior).ravel()]))

    # in the order of a hash, so that no partition is of alike words
    total = _summed(known.select("word", "c").sortWithinPartitions(F.xxhash64("word")).mapInArrow(run, NUMBERED), GATES * ORDERS + GATES + 2 * STEPS)
    mixer = Mixer(tables)
    weights, mixer.visits, adapt = np.split(total, [GATES * ORDERS, GATES * ORDERS + GATES])
    met = mixer.visits > 0
    mixer.weights[met] = weights.reshape(GATES, ORDERS)[met] / mixer.visits[met][:, None]
    mixer.adapt += adapt.reshape(2, STEPS)
    return mixer


NUMBERED = "slot int, value double"


def _numbered(values: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.arange(len(values)), pa.int32()), pa.array(values, pa.float64())], names=["slot", "value"])


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    found = rows.groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[found.column("slot").to_numpy()] = found.column("value").to_numpy()
    return out


def _answered(total: int, distinct: int, ends: int, end_score: float, deal: int):
    """Of a block and the answers of the shares: the row of ``_taught``."""

    def blocks(block: pa.Table, returned: pa.Table) -> pa.Table:
        block = block.to_pylist()[0]
        words, at, before, train = _tokens(block)
        by_share = returned.sort_by("share")
        spelled = pc.is_valid(by_share.column("lp"))
        named, counted = by_share.filter(spelled), by_share.filter(pc.invert(spelled))
        hashed = hashes(words)
        _, which, end = contexts(words, hashed, at, before)
        counts = np.concatenate([_unpacked(x, "<i8") for x in counted.column("c").to_pylist()])
        c_of, lp_of = np.full(len(words), float(ends)), np.full(len(words), end_score)
        order = 2 + np.argsort(_dealt(hashed[2:], deal), kind="stable")
        if len(order):
            c_of[order] = np.concatenate([_unpacked(x, "<i8") for x in named.column("c").to_pylist()])
            lp_of[order] = np.concatenate([_unpacked(x, "<f4") for x in named.column("lp").to_pylist()])
        return _taught(total, distinct, block, (words, at, before, train), which, counts, end, c_of, lp_of)

    return blocks


def _features(total: int, distinct: int, ends: int, end_score: float):
    """Of a block's words and what other blocks count of its contexts, and its texts:
    a row for each text, and one with what the block's training texts teach."""

    def blocks(table: pa.Table, texts: pa.Table) -> pa.Table:
        rows = [(*row, i) for i, row in enumerate(zip(*(texts.column(name).to_pylist() for name in ("doc_id", "text", "held_out"))))]
        block = _block(rows).to_pylist()[0]
        words, at, before, train = _tokens(block)
        known = {w: (c, lp) for w, c, lp in zip(*(table.column(name).to_pylist() for name in ("word", "c", "lp"))) if w is not None}
        known[END] = known[b""] = (ends, end_score)
        other = {k: c for w, k, c in zip(*(table.column(name).to_pylist() for name in ("word", "key", "c"))) if w is None}
        keys, which, end = contexts(words, hashes(words), at, before)
        counts = np.array([other.get(k, 0) for k in keys.view(np.int64).tolist()]) + sum(np.bincount(w[train], minlength=len(keys)) for w in which)
        c_of, lp_of = np.array([known[w] for w in words], float).T
        out = []
        for part in _taught(total, distinct, block, (words, at, before, train), which, counts, end, c_of, lp_of).to_pylist():
            out += [{"doc_id": i, "held_out": h, "n_tokens": n, "n_known": k, "base_score": s, "size": z, "learned": None}
                    for i, h, n, k, s, z in zip(*(part[name] for name in ("ids", "held", "sizes", "known", "base", "size")))]
            out += [dict.fromkeys(out[0]) | {"learned": part["learned"]}] if part["learned"] else []
        return pa.Table.from_pylist(out)

    return blocks


def _taught(total: int, distinct: int, block: dict, tokens: tuple, which: list[np.ndarray], counts: np.ndarray, end: np.ndarray, c_of: np.ndarray, lp_of: np.ndarray) -> pa.Table:
    """A block's row: its tokens' counts and what the training texts of its parts teach."""
    words, at, before, train = tokens
    pairs, close, ends = which
    n, m, lasts = (counts[w] for w in which)
    below, wide = total + 0.5 * (distinct + 1), max(len(words), len(counts))
    length = np.array([len(w) + 1 for w in words])
    length[0] = 1
    ids, held, size_of, sizes = block["ids"], block["held"], block["bytes"], np.array(block["sizes"])
    starts, learned = np.r_[0, np.cumsum(sizes)], None
    for part_lo, part_hi in _runs(np.array(block["parts"])):
        mixer = Sources()
        for lo, hi in _text_chunks(size_of[part_lo:part_hi]):
            lo, hi = lo + part_lo, hi + part_lo
            e = slice(starts[lo], starts[hi])
            t = train[e]
            if not t.any():
                continue
            # each text without its own counts
            owner = _unique(np.repeat(np.arange(hi - lo), sizes[lo:hi])[t])[1]
            a, b = at[e][t], before[e][t]
            (pair, in_pair), (seen, in_seen), (context, in_context) = (_earlier(owner * wide + x) for x in (pairs[e][t], a, b))
            in_last, in_lasts = (_earlier(owner * wide + x[e][t])[1] for x in (close, ends))
            q, below_it, x = Sources.estimates(owner, a, b, c_of[a] - in_seen, n[e][t] - in_pair, m[e][t] - in_last, c_of[b] - in_context,
                                               lasts[e][t] - in_lasts, total - np.bincount(owner)[owner], (pair, seen, context))
            mixer.learn(q, below_it, x, lp_of[a])
        if mixer.visits.any():
            learned = mixer.pack() + (0 if learned is None else learned)
    owner, c = np.repeat(np.arange(len(sizes)), sizes), c_of[at]
    known, size = (np.bincount(owner, x, len(sizes)).astype(np.int64) for x in (c > 0, length[at]))
    row = (ids, held, size_of, sizes, known, np.bincount(owner, np.log10((c + 0.5) / below), len(sizes)), size,
           _packed(at, "<i4"), _packed(c_of, "<i8"), _packed(lp_of, "<f4"), _packed(end, "<i4"), _packed(n, "<i8"), _packed(m, "<i8"),
           _packed(_by_end(end[before], lasts, int(end.max()) + 1), "<i8"), None if learned is None else learned.tobytes())
    return pa.table([pa.array([x], f.type) for x, f in zip(row, FEATURES)], schema=FEATURES)


def _by_end(end: np.ndarray, lasts: np.ndarray, wide: int) -> np.ndarray:
    """The counts of words' ends by the end's number."""
    out = np.zeros(wide, np.int64)
    out[end] = lasts
    return out


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True])
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())


FEATURES = pa.schema([("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("bytes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("known", pa.list_(pa.int64())),
                      ("base", pa.list_(pa.float64())), ("size", pa.list_(pa.int64())), *[(x, pa.binary()) for x in ("at", "c", "lp", "end", "n", "m", "lasts", "learned")]])
FEATURES_DDL = ("ids array<long>, held array<boolean>, bytes array<long>, sizes array<long>, known array<long>, base array<double>, size array<long>, "
                "at binary, c binary, lp binary, end binary, n binary, m binary, lasts binary, learned binary")


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _kept(df: DataFrame) -> DataFrame:
    """``stage``, after which the shuffle files of its job are deleted at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        return stage(df, "zstd")
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", *, slot_bits: int = 19) -> DataFrame:
    """One row (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, bits_per_byte) for each row of docs; held_out is a condition on the
    columns of docs, and rows where it is not true are learned from.

    A-Z is lower-cased; tokens are the words and one end. base_score is the
    word-frequency log10 probability with half a count added, score the mixing
    model's log10 probability of the tokens in their order; bits_per_byte is the latter over
    the bytes of the words, their spaces and the end mark. Null and empty texts are the
    end alone. Null and repeated ids are values like any other. Without training
    documents every count is 0 and every bit even odds, as corrected by nothing.
    Other columns are not read, but those in held_out. The mixers learn from all
    training text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit("").cast("binary")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.monotonically_increasing_id().alias("row"))
    blocks = _kept(rows.mapInArrow(_blocks, BLOCKS_DDL))
    vocabulary = _kept(blocks.select(*BLOCKS.names).mapInArrow(_block_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")))
    known = vocabulary.where("c > 0")
    words, distinct = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends, tokens = blocks.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda x: ~x))), F.lit(0)),
                              F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    deal = max(3, (tokens >> 21).bit_length())
    total, distinct = words + ends, distinct + (ends > 0)
    # the hashed tables, from every training word
    tokens = known.select(F.concat("word", F.lit(SPACE)).alias("token"), "c").union(
        spark.range(1).select(F.lit(END).alias("token"), F.lit(max(ends, 1)).cast("long").alias("c")))
    found = tokens.mapInArrow(_counts(slot_bits), "slot int, n0 long, n1 long").groupBy("slot").agg(
        F.sum("n0").cast("float").alias("n0"), F.sum("n1").cast("float").alias("n1")).toArrow()
    size = 1 << slot_bits
    tables = np.zeros((2, ORDERS * size), np.float32)
    at = found.column("slot").to_numpy()
    tables[0][at], tables[1][at] = found.column("n0").to_numpy(), found.column("n1").to_numpy()
    mixer = _spelling(known, tables.reshape(2, ORDERS, size), slot_bits)
    end_score = float(mixer.log10([END], slot_bits)[0])
    shared = spark.sparkContext.broadcast(mixer)

    def make():
        schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("lp", pa.float64()), ("share", pa.int64())])
        model = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = batch.column(0).to_pylist()
            return record(schema, *batch.columns, model.log10([w + SPACE for w in words], slot_bits), _dealt(hashes(words), deal))

        return step

    scored = map_rows(vocabulary, make, "word binary, c long, lp double, share long", 1 << 20)
    # words and contexts go to their share, which counts them over the corpus and answers each block in the order of its question
    named = _kept(blocks.mapInArrow(_block_shares(deal, False), SHARES_DDL).groupBy("share").cogroup(scored.groupBy("share")).applyInArrow(_word_counts, RETURNED_DDL))
    counted = _kept(blocks.mapInArrow(_block_shares(deal, True), SHARES_DDL).groupBy("share").applyInArrow(_key_counts, RETURNED_DDL))
    found = _kept(blocks.groupBy("block").cogroup(named.union(counted).groupBy("block")).applyInArrow(
        _answered(total, distinct, ends, end_score, deal), FEATURES_DDL))

    size = sum(int(np.prod(s)) for s in Sources.SHAPES)

    def taught(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                out += np.frombuffer(x)
        if out.any():
            yield _numbered(out)

    chosen = spark.sparkContext.broadcast(Sources.merged(_summed(found.select("learned").where("learned is not null").mapInArrow(taught, NUMBERED), size)))

    def finish():
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = chosen.value
            for batch in batches:
                for part in slices(batch, 1):
                    x = part.to_pylist()[0]
                    sizes = np.array(x["sizes"], np.int64)
                    at, c_of, lp_of, end, n, m, lasts = (_unpacked(x[name], kind) for name, kind in (
                        ("at", "<i4"), ("c", "<i8"), ("lp", "<f4"), ("end", "<i4"), ("n", "<i8"), ("m", "<i8"), ("lasts", "<i8")))
                    c_of, at = c_of.astype(float), at.astype(np.int64)
                    starts = np.r_[0, np.cumsum(sizes)]
                    for lo, hi in _text_chunks(x["bytes"]):
                        e, many = slice(starts[lo], starts[hi]), hi - lo
                        owner, before = np.repeat(np.arange(many), sizes[lo:hi]), _before(at[e], sizes[lo:hi])
                        q, seen, inputs = Sources.estimates(owner, at[e], before, c_of[at[e]], n[e], m[e], c_of[before], lasts[end[before]], total)
                        s = np.bincount(owner, model.log10(q, seen, inputs, lp_of[at[e]].astype(float)), many)
                        yield record(schema, x["ids"][lo:hi], x["held"][lo:hi], x["sizes"][lo:hi], x["known"][lo:hi], np.full(many, total),
                                     x["base"][lo:hi], s, -s / np.log10(2) / np.array(x["size"][lo:hi]))

        return run

    return found.drop("learned").mapInArrow(finish(), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                            "train_tokens long, base_score double, score double, bits_per_byte double")
