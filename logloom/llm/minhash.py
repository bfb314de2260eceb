"""Near-duplicate documents by SuperMinHash signatures.

Every element of a document's shingle set walks a pseudo-random permutation of
the signature's slots; at step j it offers slot p_j the value j + r (r uniform
in [0, 1)), and each slot keeps its smallest offer. Slots that agree estimate
the Jaccard similarity with less variance than plain MinHash, and a document
stops as soon as no slot can still improve, which for sets larger than the
signature is after a step or two.

Bands of slots give buckets. Candidate links are confirmed on the full shingle
sets; confirmed links are reduced by union-find inside each task and joined by
distributed components. No bucket is ever expanded into all its pairs in a
join: exact copies are one class, and buckets are searched in star rounds (all
members against the smallest id, then, in buckets that still hold several
components, against members drawn anew); what is left is compared in blocks, a
bucket's largest component with the others and these among each other.
Signatures, a byte a slot, go first everywhere: sets travel only for members that
agree in as many slots as a link leaves but once in a million times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLD, connected_components, forest, map_rows, mix64, record, stage

_U = np.uint64
#: Words whose hashes a task keeps; beyond it the cache starts anew.
WORD_CACHE = 1 << 20
#: Elements that walk their permutations together (times the signature's slots in bytes).
WALK = 1 << 17
#: Bits of the filter of candidates' ids: 4 MB on the driver and in each worker, whatever the input.
FILTER_BITS = 1 << 25


class Shingles:
    """Distinct hashed k-word shingles of lower-cased texts."""

    def __init__(self, k: int):
        self.k, self.seen = k, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Sorted uint64 hashes; empty without a word, one element for fewer than k words."""
        if not text or not (found := text.lower().split()):
            return np.empty(0, _U)
        seen = self.seen
        if len(seen) > WORD_CACHE:
            seen.clear()
        try:
            ids = [seen[w] for w in found]
        except KeyError:
            for w in set(found):
                seen[w] = xxhash.xxh3_64_intdigest(w)
            ids = [seen[w] for w in found]
        h = np.array(ids, _U)
        n, k = len(h), self.k
        if n < k:
            return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=n)], _U)
        with np.errstate(over="ignore"):
            acc = np.zeros(n - k + 1, _U)
            for i in range(k):
                acc = mix64(acc * _U(0x100000001B3) + h[i : n - k + 1 + i] + GOLD)
        return np.unique(acc)


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Signatures of uint64 sets as a (len(sets), m) array: step j in the upper
    16 bits, the uniform draw in the lower 48. Empty sets keep the maximum."""
    top = np.iinfo(_U).max
    sig = np.full((len(sets), m), top, _U)
    flat = sig.reshape(-1)

    def draw(x: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            r = mix64(x + _U(j + 1) * GOLD)
            k = mix64(r + _U(0xD1B54A32D192ED03))
        return (r >> _U(16)) + (_U(j) << _U(48)), (_U(j) + k % _U(m - j)).astype(np.int64)

    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return sig
    x, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    value, slot = draw(x, 0)
    np.minimum.at(flat, doc * m + slot, value)
    open_docs = (sig.max(axis=1) > (_U(1) << _U(48))) & (sizes > 0)
    rest = np.flatnonzero(open_docs)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(rest):  # groups of documents whose elements walk on together
        upto, total = at, 0
        while upto < len(rest) and (upto == at or total + sizes[rest[upto]] <= WALK):
            total += sizes[rest[upto]]
            upto += 1
        here = rest[at:upto]
        own = np.concatenate([np.arange(ends[d] - sizes[d], ends[d]) for d in here])
        at = upto
        ex, ed = x[own], doc[own]
        perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(ex), 1))
        perm[np.arange(len(ex)), slot[own]] = 0
        for j in range(1, m):
            if j % 4 == 1:  # documents that step j can no longer improve stop here
                go = here[sig[here].max(axis=1) > (_U(j) << _U(48))]
                if len(go) < len(here):
                    here, stay = go, np.isin(ed, go)
                    ex, ed, perm = ex[stay], ed[stay], perm[stay]
                if not len(here):
                    break
            value, k = draw(ex, j)
            rows = np.arange(len(ex))
            target = perm[rows, k]
            perm[rows, k] = perm[:, j]
            np.minimum.at(flat, ed * m + target, value)
    return sig


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """One int64 bucket key for each band of each signature."""
    rows = sig.shape[1] // bands
    with np.errstate(over="ignore"):
        acc = np.broadcast_to(np.arange(1, bands + 1, dtype=_U) * GOLD, (len(sig), bands)).copy()
        for i in range(rows):
            acc = mix64(acc * _U(0x100000001B3) + sig[:, i : bands * rows : rows])
    return acc.view(np.int64)


def least_agreeing(m: int, percent: int, escape: float = 1e-6) -> int:
    """The most slots k of m such that fewer than k agree with a chance of at
    most escape where the similarity is percent / 100 (binomial: SuperMinHash
    varies less)."""
    p, chance = percent / 100, 0.0
    for k in range(m + 1):
        chance += math.comb(m, k) * p**k * (1 - p) ** (m - k)
        if chance > escape:
            return k
    return m


def _profile(k: int, bands: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def make():
        shingles = Shingles(k)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            signatures = super_minhash(sets, bands * rows)
            keys = band_keys(signatures, bands)
            offsets = np.arange(0, (len(sets) + 1) * bands, bands, dtype=np.int32)
            return record(
                schema, batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in signatures.astype(np.uint8)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
            )

        return step

    return make


def _agreeing(least: int):
    """Of the candidate pairs with a byte of each slot, those with least equal bytes or more."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            near = pa.array((a == b).sum(axis=1) >= least)
            return record(schema, batch.column(0).filter(near), batch.column(1).filter(near))

        return step

    return make


def candidate_sets(texts: DataFrame, ends: DataFrame, k: int, bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, shingles) of the texts whose doc_id is among the distinct ones of ends.

    A filter of ``bits`` bits, one for each id's hash, is made by Spark and drops
    most other texts where they are read, in the task that makes the sets; the
    semi-join behind it is exact and shuffles the sets that are left. When ids
    fill the filter, all sets reach the semi-join.
    """
    at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    words = ends.where("doc_id is not null").select(at.alias("at")).groupBy(F.expr("shiftright(at, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("found")).toArrow()
    mask = np.zeros(-(-bits // 64), np.int64)
    mask[words["word"].to_numpy()] = words["found"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(mask)
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])

    def make():
        mask, shingles = shared.value, Shingles(k)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((mask[at >> 6] >> (at & 63)) & 1 == 1))
            return record(schema, batch.column(0), pa.array([shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary()))

        return step

    near = map_rows(texts.select("doc_id", "text", at.alias("at")), make, "doc_id long, shingles binary")
    return near.join(ends, "doc_id", "left_semi")


def _links(percent: int):
    """Of the candidate pairs with their sets, a spanning forest of those that hold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            holds = np.zeros(len(a), bool)
            for i, (s, t) in enumerate(zip(batch.column(2), batch.column(3))):
                s, t = np.frombuffer(s.as_buffer(), _U), np.frombuffer(t.as_buffer(), _U)
                both = len(np.intersect1d(s, t, assume_unique=True))
                holds[i] = 100 * both >= percent * (len(s) + len(t) - both)
            return record(schema, *forest(a[holds], b[holds]))

        return step

    return make


def gram(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, in column blocks of bounded size."""
    n = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.r_[True, every[1:] != every[:-1]]
    group = np.cumsum(first) - 1
    often = np.bincount(group) > 1  # elements of one set meet nothing
    keep = often[group]
    owner, group = owner[keep], (np.cumsum(often) - 1)[group[keep]]
    out = np.zeros((n, n), np.float32)
    width = 4096
    cuts = np.searchsorted(group, np.arange(0, (group[-1] + 1 if len(group) else 0) + width, width))
    for i in range(len(cuts) - 1):
        lo, hi = cuts[i], cuts[i + 1]
        if lo < hi:
            block = np.zeros((n, width), np.float32)
            block[owner[lo:hi], group[lo:hi] - i * width] = 1
            out += block @ block.T
    return out


def _by_block(schema: pa.Schema, solve):
    """Rows (block, rep, label, side, data), each block whole and in order:
    solve(block, reps, labels, sides, data) of each gives columns, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for block, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if block != key:
                    if len(rows) > 1 and (out := solve(key, *zip(*rows))) is not None:
                        yield record(schema, *out)
                    key, rows = block, []
                rows.append(row)
        if len(rows) > 1 and (out := solve(key, *zip(*rows))) is not None:
            yield record(schema, *out)

    return run


def _apart(labels, sides) -> np.ndarray:
    """Which pairs a block compares: those of different labels, and where it has two sides, of different ones."""
    label, side = np.array(labels), np.array(sides)
    return (label[:, None] != label[None, :]) & ((side[:, None] != side[None, :]) | (side[:, None] == 0))


def _near(labels, sides, sigs, least: int) -> np.ndarray:
    """Which pairs of a block's members a block compares and agree in least slots or more."""
    near, every = _apart(labels, sides), np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), -1)
    for i, sig in enumerate(every):
        if near[i].any():
            near[i] &= (every == sig).sum(axis=1) >= least
    return near


def _block_near(least: int):
    """Of a block's members, each once, those whose signature agrees with another's
    in least slots or more."""
    schema = pa.schema([("block", pa.int64()), ("rep", pa.int64()), ("label", pa.int64()), ("side", pa.int32()), ("sig", pa.binary())])

    def solve(block, reps, labels, sides, sigs):
        kept = np.flatnonzero(_near(labels, sides, sigs, least).any(axis=1)).tolist()
        if not kept:
            return None
        return [block] * len(kept), *([x[i] for i in kept] for x in (reps, labels, sides, sigs))

    return _by_block(schema, solve)


def _block_links(percent: int, least: int, set_rows: int):
    """A spanning forest of the links between labels inside each block: the sets of
    agreeing members, those of at most twice set_rows members at once."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(block, reps, labels, sides, sigs, sets):
        near, reps, links = _near(labels, sides, sigs, least), np.array(reps, np.int64), []
        sets = [np.frombuffer(s, _U) for s in sets]
        for lo in range(0, len(reps), set_rows):
            for at in range(lo, len(reps), set_rows):
                part = near[lo : lo + set_rows, at : at + set_rows]
                if not part.any():
                    continue
                some = np.union1d(lo + np.flatnonzero(part.any(axis=1)), at + np.flatnonzero(part.any(axis=0)))
                size, both = np.array([len(sets[i]) for i in some]), gram([sets[i] for i in some])
                holds = (100 * both >= percent * (size[:, None] + size[None, :] - both)) & near[np.ix_(some, some)]
                i, j = np.nonzero(np.triu(holds, 1))
                links.append(forest(reps[some[i]], reps[some[j]]))
        return forest(*(np.concatenate(x) for x in zip(*links))) if links else None

    return _by_block(schema, solve)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle_words: int = 5,
                    percent: int = 80, bands: int = 30, rows: int = 4, block_rows: int = 2048,
                    block_shingles: int = 1 << 22, set_rows: int = 128, stars: int = 6) -> DataFrame:
    """Groups of near-duplicate documents: one row (doc_id, n_shingles,
    component_id, kept) for each row of docs.

    Two documents are linked when 100 * |A n B| >= percent * |A u B| on their
    sets of distinct shingle_words-word shingles (a shorter text is one shingle
    of all its words); component_id is the smallest doc_id reachable by links.
    A link of similarity s escapes all bands with a chance of about
    (1 - s^rows)^bands: 1e-7 for 80 % and 30 bands of 4 slots, 8e-7 for 85 % and
    24 bands of 5. A pair that shares a bucket goes on only if ``least_agreeing``
    slots agree, which drops a link once in 1e6 times. What is left is confirmed
    on the whole sets. ``stars``, ``block_rows`` and ``block_shingles`` (members of a
    block, and the size of their sets) and ``set_rows`` (sets compared at once) say
    how the search is cut up, not what it finds: the blocks compare whatever the
    rounds left.

    Null or empty text, or text without a word: n_shingles 0, linked with
    nothing. Null ids: the row stays, component_id is null and kept true.
    Rows that repeat an id are one node; each row is returned. Other columns of
    docs are not read, whatever their names.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    least = least_agreeing(bands * rows, percent)
    base = stage(map_rows(texts, _profile(shingle_words, bands, rows),
                          "doc_id long, n_shingles long, set_key binary, sig binary, bands array<long>"))
    # one class for each distinct set; its smallest id stands for the copies
    classes = base.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    slots = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = slots.groupBy("bucket").agg(F.count("*").alias("members"), F.min("rep").alias("hub")).where("members > 1")
    members = stage(slots.join(shared, "bucket"))
    # a repeated id is one node with a signature for each of its texts
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    sigs = stage(base.where("n_shingles > 0").select("doc_id", "sig").distinct().join(ids, "doc_id", "left_semi"))
    alike = f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"

    def confirm(pairs: DataFrame) -> DataFrame:
        """The links among distinct candidate pairs: signatures first, sets of those that agree."""
        a = sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa"))
        b = sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb"))
        near = stage(map_rows(pairs.join(b, "b").join(a, "a").select("a", "b", "sa", "sb"), _agreeing(least), "a long, b long"))
        ends = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        sets = stage(candidate_sets(texts, ends, shingle_words))
        a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
        b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
        return stage(map_rows(near.join(b, "b").join(a, "a").select("a", "b", "sa", "sb"), _links(percent), "a long, b long"))

    # round 1: every member against its bucket's smallest id; sizes alone rule out most chance meetings
    hubs = members.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n")).distinct()
    star = members.where("rep <> hub").select("hub", "rep", "n").distinct().join(hubs, "hub")
    links = confirm(star.where(alike).select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    found = connected_components(links)
    left = members.where("rep <> hub and members > 2").select("bucket", "rep", "n")

    # further rounds: each bucket that is still of several components, against a member drawn anew
    for draw in range(stars):
        left = left.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            "bucket", "rep", "n", F.coalesce("component", "rep").alias("label"))
        mixed = left.groupBy("bucket").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"),
            F.max(F.struct(F.xxhash64("rep", F.lit(draw)).alias("drawn"), "rep", "label", "n")).alias("at"),
        ).where("lo <> hi").select("bucket", "size", F.col("at.rep").alias("hub"), F.col("at.label").alias("hub_label"), F.col("at.n").alias("hub_n"))
        left = stage(left.join(mixed, "bucket"))
        # after the first draw only buckets that do not fit one block are worth a round
        pairs = left.where(f"label <> hub_label and {alike}" + (f" and size > {block_rows}" if draw else ""))
        pairs = stage(pairs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct())
        left = left.select("bucket", "rep", "n")
        tried = pairs.count()
        if not tried:
            break
        more = confirm(pairs)
        links = links.union(more)
        found = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
        if more.count() * 100 < tried:  # members that are no links of each other are for the blocks
            break

    # the rest, in blocks of bounded size: a bucket's largest component is compared with
    # the others, and these among each other; members of one component are not
    rest = left.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("label"))
    of = rest.groupBy("bucket", "label").agg(F.count("*").alias("of_label"), F.sum("n").alias("shingles"))
    of = of.groupBy("bucket").agg(F.sum("of_label").alias("size"), F.sum("shingles").alias("shingles"),
                                  F.max(F.struct("of_label", "label", "shingles")).alias("top")).where("size > top.of_label")
    blocks_of = lambda n, shingles: F.ceil(F.greatest(n / block_rows, shingles / block_shingles)).cast("int")
    rest = rest.join(of.select("bucket", F.col("top.label").alias("top"), blocks_of(F.col("top.of_label"), F.col("top.shingles")).alias("tops"),
                               blocks_of(F.col("size") - F.col("top.of_label"), F.col("shingles") - F.col("top.shingles")).alias("others")), "bucket")
    h = F.xxhash64("rep")
    is_top = F.col("label") == F.col("top")
    own = F.pmod(h, F.when(is_top, F.col("tops")).otherwise(F.col("others"))).cast("int")
    rest = rest.select("bucket", "rep", "label", is_top.alias("is_top"), own.alias("own"), "tops", "others")
    meet = F.explode(F.sequence(F.lit(0), F.when(F.col("is_top"), F.col("others")).otherwise(F.col("tops")) - 1))
    across = rest.withColumn("other", meet).select(
        F.xxhash64("bucket", F.lit(0), F.when(F.col("is_top"), F.col("own")).otherwise(F.col("other")),
                   F.when(F.col("is_top"), F.col("other")).otherwise(F.col("own"))).alias("block"),
        "rep", "label", F.when(F.col("is_top"), 1).otherwise(2).alias("side"))
    among = rest.where("not is_top").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        F.xxhash64("bucket", F.lit(1), F.least("own", "other"), F.greatest("own", "other")).alias("block"), "rep", "label", F.lit(0).alias("side"))
    blocks = across.union(among).distinct()
    whole = blocks.join(sigs.withColumnRenamed("doc_id", "rep"), "rep").select("block", "rep", "label", "side", "sig")
    near = stage(whole.repartition("block").sortWithinPartitions("block").mapInArrow(_block_near(least), "block long, rep long, label long, side int, sig binary"))
    sets = candidate_sets(texts, near.select(F.col("rep").alias("doc_id")).distinct(), shingle_words)
    whole = near.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select("block", "rep", "label", "side", "sig", "shingles")
    last = stage(whole.repartition("block").sortWithinPartitions("block").mapInArrow(_block_links(percent, least, set_rows), "a long, b long"))

    found = connected_components(links.union(last))
    classes = classes.select("set_key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component_id"))
    return base.join(classes, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
