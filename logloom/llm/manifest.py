"""Merkle manifest of a table: one hash tree a group, one more over the groups.

Rows are leaves in the order of their ids. Every 8 consecutive nodes become one
(a last run may hold fewer, even one) until one is left, the group's subroot;
the subroots, in the order of their groups, become the root in the same way.

The tree is a postorder append log: a node is written when its last leaf is. A
builder owns an aligned block of 8^4 neighbours, a whole subtree, so its nodes
are one contiguous segment of the log and builders need nothing of each other.
The block roots are the leaves of the builders above, and so on. The place of a
node follows from subtree sizes alone (``postorder``), so a proof addresses its
siblings in a segment by arithmetic; nothing is searched and no tree is kept.

A segment is one row: at most 4,681 digests. No task holds more than a segment.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

ARITY = 8
#: Levels that one builder closes, and the neighbours in its block.
LEVELS = 4
BLOCK = ARITY**LEVELS
#: Rows of the table of counts that are still broadcast (a few dozen bytes each).
MAX_BROADCAST_ROWS = 200_000
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def hashed(digests: list[bytes]) -> bytes:
    """The digest of some digests, taken as lower-case hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def postorder(level: int, index: int, n: int) -> int:
    """The place, from 0, of a node in the postorder log of a tree over n leaves.

    Before a leaf stand the whole subtrees of the digits of its number; a node
    stands ``level`` places after the last leaf below it, and nodes that hold
    the last leaf of all follow it one by one."""
    last = min((index + 1) * ARITY**level, n) - 1
    place, size, rest = level, 1, last
    while rest:
        rest, digit = divmod(rest, ARITY)
        place += digit * size
        size = size * ARITY + 1
    return place


def height(n: int) -> int:
    """Levels above n leaves; a lone leaf is its own root."""
    out = 0
    while n > 1:
        n = -(-n // ARITY)
        out += 1
    return out


class Segment:
    """Addresses the nodes of a block's segment, written in postorder: ``places``
    by level and number."""

    def __init__(self, count: int, levels: int):
        self.counts = [count]
        for _ in range(levels):
            self.counts.append(-(-self.counts[-1] // ARITY))
        self.places = [[postorder(level, i, count) for i in range(c)] for level, c in enumerate(self.counts)]


@functools.lru_cache(maxsize=64)
def segment(count: int, levels: int) -> Segment:
    return Segment(count, levels)


def build_segment(digests: list[bytes], levels: int) -> list[bytes]:
    """Digests of a block's subtree in the order of completion: a stack holds at
    most seven open nodes a level."""
    out: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(levels + 1)]
    for i, digest in enumerate(digests):
        last = i == len(digests) - 1
        for level in range(levels + 1):
            out.append(digest)
            if level == levels:
                break
            open_[level].append(digest)
            if not last and len(open_[level]) < ARITY:
                break
            digest = hashed(open_[level])
            open_[level] = []
    return out


SEGMENTS = "grp string, n long, block long, ids array<long>, nodes binary, claims binary"
SEGMENT_SCHEMA = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("nodes", pa.binary()), ("claims", pa.binary())])


def _levels_left(n: int, base: int) -> int:
    """Levels that a builder over nodes of level base closes in a tree over n leaves."""
    return max(0, min(LEVELS, height(n) - base))


def _build(base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, digests, claims = None, [], [], []

        def close() -> pa.RecordBatch:
            grp, n, block = key
            nodes = b"".join(build_segment(digests, _levels_left(n, base)))
            claimed = b"".join(c or d for c, d in zip(claims, digests)) if any(claims) else None
            return pa.record_batch([pa.array([x], f.type) for x, f in zip((grp, n, block, ids, nodes, claimed), SEGMENT_SCHEMA)], schema=SEGMENT_SCHEMA)

        for batch in batches:
            for grp, n, block, id_, digest, claim in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (grp, n, block):
                    if key is not None:
                        yield close()
                    key, ids, digests, claims = (grp, n, block), [], [], []
                ids.append(id_)
                digests.append(digest)
                claims.append(claim)
        if key is not None:
            yield close()

    return run


def segments(rows: DataFrame, base: int) -> DataFrame:
    """Rows (grp, n, place, id, digest, claim), the level-``base`` nodes of trees
    over n leaves, as one staged row a block."""
    block = rows.select("grp", "n", F.expr(f"place div {BLOCK}").alias("block"), "place", "id", "digest", "claim")
    dealt = block.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")
    return stage(dealt.select("grp", "n", "block", "id", "digest", "claim").mapInArrow(_build(base), SEGMENTS))


def numbered(leaves: DataFrame) -> DataFrame:
    """Staged leaves (grp, id, digest, claim, seq) with their place in their group
    by (id, digest), nulls first, and the group's count n: range partitions are
    written sorted, with the row's number in its partition, and get their first
    place from the counts of the partitions before."""
    ordered = leaves.repartitionByRange("grp", "id", "digest", "seq").sortWithinPartitions("grp", "id", "digest", "seq")
    number = F.monotonically_increasing_id()
    written = stage(ordered.select("grp", "id", "digest", "claim", F.shiftright(number, 33).cast("int").alias("part"), number.bitwiseAND((1 << 33) - 1).alias("row")))
    counts = written.groupBy("grp", "part").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(counts.select("grp", "part", F.sum("rows").over(group).alias("n"), (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("base")))
    # a row for each partition and each group: sent whole only when it is known to be small
    small = F.broadcast(bases) if bases.count() <= MAX_BROADCAST_ROWS else bases
    return written.join(small, ["grp", "part"]).select("grp", "n", (F.col("base") + F.col("row")).alias("place"), "id", "digest", "claim")


def _tops(found: DataFrame, base: int) -> DataFrame:
    """Roots of the blocks whose group goes on above them, as rows of the next base."""
    digest = F.expr("substring(nodes, octet_length(nodes) - 31, 32)")
    return found.where(F.col("n") > ARITY ** (base + LEVELS)).select(
        "grp", "n", F.col("block").alias("place"), F.lit(None).cast("long").alias("id"), digest.alias("digest"), F.lit(None).cast("binary").alias("claim"))


def build_trees(rows: DataFrame) -> list[DataFrame]:
    """The log of all groups: segments by level 0, 4, 8, ... of their lowest nodes."""
    out = [segments(rows, 0)]
    largest = out[0].agg(F.max("n")).first()[0] or 0
    base = 0
    while largest > ARITY ** (base + LEVELS):
        out.append(segments(_tops(out[-1], base), base + LEVELS))
        base += LEVELS
    return out


def _subroots(log: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the segments that end in their group's root."""
    found = None
    for i, seg in enumerate(log):
        last = seg.where(F.col("n") <= ARITY ** ((i + 1) * LEVELS)).select("grp", F.expr("substring(nodes, octet_length(nodes) - 31, 32)").alias("digest"))
        found = last if found is None else found.union(last)
    return found


@dataclass(frozen=True)
class Manifest:
    """The log of the groups' trees, the log of the tree over the groups, whose
    leaves are the subroots, and the root (hex; null of an empty table)."""

    log: list[DataFrame]
    top: list[DataFrame]
    groups: DataFrame  # grp, place (in the tree over the groups), subroot
    root: str | None


def _group(value: Column) -> Column:
    """Text that sorts as the group does, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def field(value: Column) -> Column:
    """A value as hashed into a leaf: ``-`` for null, else its UTF-8 byte count, ``:``, itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def build(rows: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang", digest: Column, claim: Column | None = None) -> Manifest:
    """The manifest of rows. ``digest`` is the leaf (hex sha256) of a row; ``claim``
    what is presented for it at verification, null for the leaf itself.

    Leaves of a group ascend by (id, digest), null ids first; rows that repeat an
    id are leaves each, repeated rows too. Rows with a null group are a group of
    their own, before all others. An empty table has no groups and no root.
    Other columns are not read, whatever their names.
    """
    claimed = F.lit(None).cast("string") if claim is None else claim
    # hashed once: what follows reads 32 bytes a row
    leaves = stage(rows.select(_group(F.col(f"`{group_col}`")).alias("grp"), F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(digest).alias("digest"),
                               F.unhex(claimed).alias("claim"), F.monotonically_increasing_id().alias("seq")))
    log = build_trees(numbered(leaves))
    subroots = _subroots(log)
    # the groups are the leaves of one more tree, in the same way
    names = stage(subroots.select(F.lit("").alias("grp"), F.lit(None).cast("long").alias("id"), F.col("grp").alias("name"), "digest"))
    counted = names.repartitionByRange("name").sortWithinPartitions("name")
    number = F.monotonically_increasing_id()
    written = stage(counted.select("name", "digest", F.shiftright(number, 33).cast("int").alias("part"), number.bitwiseAND((1 << 33) - 1).alias("row")))
    # a row a partition of names
    parts = written.groupBy("part").agg(F.count("*").alias("rows"))
    parts = parts.select("part", F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("base"))
    total = written.count()
    groups = stage(written.join(parts, "part").select(F.col("name").alias("grp"), (F.coalesce("base", F.lit(0)) + F.col("row")).alias("place"), F.col("digest").alias("subroot")))
    top = build_trees(groups.select(F.lit("").alias("grp"), F.lit(total).cast("long").alias("n"), "place", F.lit(None).cast("long").alias("id"), F.col("subroot").alias("digest"), F.lit(None).cast("binary").alias("claim")))
    last = _subroots(top).first()
    return Manifest(log, top, groups, None if last is None else bytes(last.digest).hex())


# ------------------------------------------------------------------ proofs

PATHS = "grp string, place long, path binary, sides binary"
PATH_SCHEMA = pa.schema([("grp", pa.string()), ("place", pa.int64()), ("path", pa.binary()), ("sides", pa.binary())])


def siblings(nodes: bytes, shape: Segment, place: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Of leaf ``place`` of a segment, level by level: the digests left and right of
    the path as bytes, and how many stand left and right."""
    found, sides = [], []
    index = place
    for level in range(len(shape.counts) - 1):
        first = index - index % ARITY
        upto = min(first + ARITY, shape.counts[level])
        for i in range(first, upto):
            if i != index:
                at = 32 * shape.places[level][i]
                found.append(nodes[at : at + 32])
        sides.append((index - first, upto - index - 1))
        index //= ARITY
    return found, sides


def fold(digest: bytes, path: bytes, sides: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    at = 0
    for left, right in zip(sides[::2], sides[1::2]):
        mid, end = at + 32 * left, at + 32 * (left + right)
        digest = hashlib.sha256((path[at:mid] + digest + path[mid:end]).hex().encode()).digest()
        at = end
    return digest


def _descend(base: int):
    """Segments with their block root's path: the paths of their lowest nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, n, block, nodes, path, sides in zip(*(c.to_pylist() for c in batch.columns)):
                levels = _levels_left(n, base)
                shape = segment(_leaves_in(len(nodes) // 32, levels), levels)
                out = []
                for i in range(shape.counts[0]):
                    own, ways = siblings(nodes, shape, i)
                    out.append((grp, block * BLOCK + i, b"".join(own) + path, bytes(x for w in ways for x in w) + sides))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), PATH_SCHEMA)], schema=PATH_SCHEMA)

    return run


def _leaves_in(size: int, levels: int) -> int:
    """Leaves of a segment of that many nodes."""
    low, high = 1, size
    while low < high:  # the size grows with the leaves
        mid = (low + high) // 2
        if sum(-(-mid // ARITY**k) for k in range(levels + 1)) < size:
            low = mid + 1
        else:
            high = mid
    return low


def _paths(log: list[DataFrame], roots: DataFrame) -> list[DataFrame]:
    """For the segments of each level from the top down, (grp, place, path, sides)
    of their block roots; ``roots`` holds (grp, path, sides) of the groups' roots."""
    out: list[DataFrame] = [None] * len(log)
    for i in reversed(range(len(log))):
        here = log[i].where((F.col("n") <= ARITY ** ((i + 1) * LEVELS))).select("grp", "block").join(roots, "grp").select("grp", F.col("block").alias("place"), "path", "sides")
        if i + 1 < len(log):
            here = here.union(_with_paths(log[i + 1], out[i + 1]).mapInArrow(_descend((i + 1) * LEVELS), PATHS))
        out[i] = stage(here)
    return out


def _with_paths(seg: DataFrame, paths: DataFrame) -> DataFrame:
    return seg.join(paths.withColumnRenamed("place", "block"), ["grp", "block"]).select("grp", "n", "block", "nodes", "path", "sides")


PROOFS = pa.schema([("grp", pa.string()), ("place", pa.int64()), ("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                    ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("path", pa.binary()), ("sides", pa.binary())])


def prove(manifest: Manifest, with_paths: bool = False) -> DataFrame:
    """For each leaf: grp, place, id, leaf, subroot, root, proof_sha256 (the digest of
    its siblings from the bottom to the root, left to right), folded_root (from the
    claim, or the leaf without one, and those siblings) and, if asked for, path (the
    siblings, 32 bytes each) and sides (two bytes a level: how many stand left and
    right), which ``fold`` takes. An empty manifest has no rows."""
    top_roots = manifest.top[0].select("grp").distinct().select("grp", F.lit(b"").alias("path"), F.lit(b"").alias("sides"))
    ways = _paths(manifest.top, top_roots)
    # the paths of the subroots, by their place among the groups
    up = _with_paths(manifest.top[0], ways[0]).mapInArrow(_descend(0), PATHS).select("place", "path", "sides")
    roots = stage(manifest.groups.join(up, "place").select("grp", "path", "sides"))
    blocks = _paths(manifest.log, roots)[0].withColumnRenamed("place", "block")
    rows = manifest.log[0].join(blocks, ["grp", "block"]).join(manifest.groups.select("grp", "subroot"), "grp")
    root = manifest.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, n, block, ids, nodes, claims, path, sides, subroot in zip(*(c.to_pylist() for c in batch.columns)):
                shape = segment(len(ids), _levels_left(n, 0))
                above, out = path.hex().encode(), []
                for i, id_ in enumerate(ids):
                    own, ways = siblings(nodes, shape, i)
                    own = b"".join(own)
                    at = 32 * shape.places[0][i]
                    leaf_ = nodes[at : at + 32]
                    claim = claims[32 * i : 32 * i + 32] if claims else leaf_
                    turns = bytes(x for w in ways for x in w) + sides
                    out.append((grp, block * BLOCK + i, id_, leaf_.hex(), subroot.hex(), root, hashlib.sha256(own.hex().encode() + above).hexdigest(),
                                fold(claim, own + path, turns).hex(), own + path if with_paths else None, turns if with_paths else None))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), PROOFS)], schema=PROOFS)

    types = "grp string, place long, id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, path binary, sides binary"
    return rows.select("grp", "n", "block", "ids", "nodes", "claims", "path", "sides", "subroot").mapInArrow(run, types)


def nodes(manifest: Manifest) -> DataFrame:
    """The groups' log as rows (grp, position, level, place, digest): position counts
    a group's nodes in the order of completion, from 0 without gaps."""
    schema = pa.schema([("grp", pa.string()), ("position", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string())])
    out = None
    for i, seg in enumerate(manifest.log):

        def run(batches: Iterator[pa.RecordBatch], base: int = i * LEVELS) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for grp, n, block, held in zip(*(c.to_pylist() for c in batch.columns)):
                    levels, rows = _levels_left(n, base), []
                    shape = segment(_leaves_in(len(held) // 32, levels), levels)
                    # the lowest nodes of an upper segment are the roots of the segments below
                    for level in range(1 if base else 0, levels + 1):
                        for k in range(shape.counts[level]):
                            place = block * ARITY ** (LEVELS - level) + k
                            at = 32 * shape.places[level][k]
                            rows.append((grp, postorder(base + level, place, n), base + level, place, held[at : at + 32].hex()))
                    if rows:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        made = seg.select("grp", "n", "block", "nodes").mapInArrow(run, "grp string, position long, level int, place long, digest string")
        out = made if out is None else out.union(made)
    return out


def documents_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents with a tampering trial: where 3 divides the unsigned
    crc32 of the id as text, the text is presented with A-Z lower-cased. Returns
    doc_id, leaf, subroot, root, proof_sha256, folded_root and verified."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.translate(F.col("text").cast("string"), A_TO_Z, A_TO_Z.lower())
    claim = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf(*fields, tampered))
    manifest = build(docs, digest=leaf(*fields, F.col("text")), claim=claim)
    return prove(manifest).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                  (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql(levels: int = 8) -> str:
    """DuckDB SQL for ``documents_manifest`` of groups of at most 8^levels rows: one
    grouping a level, and the siblings of each leaf gathered level by level."""
    step = "list_reduce([{x}, 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)"
    crc = ("list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), "
           "lambda a, b: " + step.format(x="xor(a, b)") + ")")

    def leaf_sql(text: str) -> str:
        parts = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"

    lower = f"translate(text, '{A_TO_Z}', '{A_TO_Z.lower()}')"
    out = [f"""WITH d AS (SELECT doc_id, lang, {leaf_sql('text')} AS leaf, CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN {leaf_sql(lower)} END AS claim FROM documents),
l0 AS (SELECT CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS c, doc_id, claim FROM d),
p0 AS (SELECT g, i AS leaf_i, i, doc_id, h AS leaf, '' AS path, coalesce(claim, h) AS f FROM l0)"""]

    def climb(a: str, b: str) -> None:
        # a run's nodes in a row each; a lone node of its group stays as it is
        out.append(f"""r{b} AS (SELECT g, i // 8 AS i, any_value(c) AS c, list(h ORDER BY i) AS run FROM l{a} GROUP BY g, i // 8),
l{b} AS (SELECT g, i, CASE WHEN c = 1 THEN run[1] ELSE sha256(list_aggregate(run, 'string_agg', '')) END AS h, (c + 7) // 8 AS c FROM r{b}),
q{b} AS (SELECT p.*, r.c, coalesce(list_aggregate(run[:p.i % 8], 'string_agg', ''), '') AS lo, coalesce(list_aggregate(run[p.i % 8 + 2:], 'string_agg', ''), '') AS hi FROM p{a} p JOIN r{b} r ON r.g = p.g AND r.i = p.i // 8),
p{b} AS (SELECT g, leaf_i, i // 8 AS i, doc_id, leaf, path || lo || hi AS path, CASE WHEN c = 1 THEN f ELSE sha256(lo || f || hi) END AS f FROM q{b})""")

    for k in range(levels):
        climb(str(k), str(k + 1))
    top = levels + 1
    out.append(f"l{top} AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS c, g AS name FROM l{levels})")
    out.append(f"p{top} AS (SELECT '' AS g, leaf_i, t.i, doc_id, leaf, path, f, t.h AS subroot FROM p{levels} p JOIN l{top} t ON t.name = p.g)")
    for k in range(top, top + 4):
        climb(str(k), str(k + 1))
        out[-1] = out[-1].replace("leaf, path || lo", "leaf, subroot, path || lo")
    end = top + 4
    return ", ".join(out) + f""" SELECT doc_id, leaf, subroot, l.h AS root, sha256(path) AS proof_sha256, f AS folded_root, f = l.h AS verified FROM p{end} p JOIN l{end} l ON l.g = p.g"""
