"""Phrase collocations from a weighted de Bruijn graph.

A text's pieces are runs of words. At every word stands the longest gram, of
four words, or of what is left at the end of its piece: an edge from the node
of its first three words to that of its last three. Only these are counted.
Everything shorter follows from the graph: a node's count is the flow of its
edges plus the pieces that end in it, a pair's the flow of the nodes that start
with it plus the pieces that end in it, and so on.

Pieces are first parted at words and pairs too rare for any phrase that counts.
Tasks combine edges by number before they are words again, so a frequent gram
leaves a batch as one row; what is shuffled is dealt out by node, never by word.
Of the edges with enough weight, those that meet in a node with one way in and
one way out are compacted into paths by pointer doubling; what lies inside a
longer phrase is found on the paths, and at their ends by one aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLD, map_rows, mix64, slices, stage

GAP, END = 32, 10
#: Bytes to bytes: lower case for A-Z, one sign for what ends a piece, one for what parts words.
_FROM = bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t"
_TO = bytes(range(97, 123)) + b"\n" * 9 + b" "
BYTES = bytes.maketrans(_FROM, _TO)
#: Edges of a path that one row holds.
CHUNK = 4096

EDGES = pa.schema([("lang", pa.string()), ("head", pa.string()), ("last", pa.string()), ("c", pa.int64())])
COUNTS = pa.schema([("lang", pa.string()), ("h", pa.int32()), ("c", pa.int64())])
#: Rows of a task's edges that are combined once more before they leave it.
COMBINE = 1 << 21
_U = np.uint64


class Tokens:
    """The words of a batch (lang, text as bytes), in the order of their langs:
    ``piece`` and ``x`` (the number of the word in its lang) by position, and for
    the numbers their ``lang``, ``word`` and ``hash``."""

    def __init__(self, batch: pa.RecordBatch):
        self.langs, of_row = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        order = np.argsort(of_row, kind="stable")
        texts = batch.column(1).take(pa.array(order)).to_pylist()
        # a line end after each text ends its last piece
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = np.frombuffer((b"\n".join(texts) + b"\n").translate(BYTES), np.uint8)
        line = data == END
        part = line | (data == GAP)
        starts = np.flatnonzero(~part & np.r_[True, part[:-1]])
        stops = np.flatnonzero(part & np.r_[False, ~part[:-1]])
        self.piece = np.cumsum(line, dtype=np.int32)[starts]
        lang = of_row[order][np.searchsorted(ends, starts, side="right")] if len(starts) else np.empty(0, np.int64)
        offsets = np.r_[0, np.cumsum(stops - starts)].astype(np.int32)
        found = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~part])]).dictionary_encode()
        self.words = found.dictionary
        keys, self.x = np.unique(lang.astype(np.int64) * max(len(self.words), 1) + found.indices.to_numpy(), return_inverse=True)
        self.lang, self.word = np.divmod(keys, max(len(self.words), 1))
        of_word = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()], _U)
        of_lang = np.array([xxhash.xxh3_64_intdigest(g) for g in self.langs], _U)
        with np.errstate(over="ignore"):
            self.hash = mix64(of_word[self.word] + of_lang[self.lang] * GOLD) if len(keys) else np.empty(0, _U)

    def keep(self, mask: np.ndarray) -> None:
        """Only the positions of mask stay; what is left out parts pieces."""
        parts = np.cumsum(np.r_[True, self.piece[1:] != self.piece[:-1]] | ~mask | np.r_[False, ~mask[:-1]]) if len(mask) else self.piece
        self.x, self.piece = self.x[mask], parts[mask]

    def pair_hashes(self) -> np.ndarray:
        """Of each position but the last, the hash of its word and the next."""
        with np.errstate(over="ignore"):
            h = self.hash[self.x]
            return mix64(h[:-1] * _U(0x100000001B3) + h[1:])

    def joined(self) -> np.ndarray:
        """Positions but the last whose next word is in the same piece."""
        return self.piece[1:] == self.piece[:-1]


class Filter:
    """A set of hashes as bits of fixed size: what was put in is always found."""

    def __init__(self, bits: int, rows: list):
        self.shift, table = _U(64 - bits), np.zeros(1 << (bits - 6), _U)
        if rows:
            table[[r[0] for r in rows]] = np.array([r[1] for r in rows], np.int64).view(_U)
        self.table = table

    def __call__(self, h: np.ndarray) -> np.ndarray:
        slot = h >> self.shift
        return (self.table[slot >> _U(6)] >> (slot & _U(63))) & _U(1) == 1

    @classmethod
    def of(cls, counted: DataFrame, min_count: int, bits: int) -> "Filter":
        """Of the hashes h counted at least min_count times: at most 2^(bits - 6)
        rows, the words of the bit table, come to the driver, whatever the input."""
        slot = F.shiftrightunsigned("h", 32 - bits)
        rows = counted.where(F.col("h").isNotNull() & (F.col("f") >= min_count)).groupBy(F.shiftright(slot, 6).alias("at")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, shiftrightunsigned(h, {32 - bits}) & 63)")).alias("bits"))
        return cls(bits, [tuple(r) for r in rows.collect()])


def _upper(h: np.ndarray) -> np.ndarray:
    """The upper half of hashes, by which they are counted."""
    return (h >> _U(32)).astype(np.uint32).view(np.int32)


def _counted(h: np.ndarray) -> pa.RecordBatch:
    h, c = np.unique(_upper(h), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.nulls(len(h), pa.string()), pa.array(h), pa.array(c.astype(np.int64))], schema=COUNTS)


def _word_counts():
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = Tokens(batch)
        c = np.bincount(t.x, minlength=len(t.hash)).astype(np.int64)
        total = np.bincount(t.lang, weights=c, minlength=len(t.langs)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([None] * len(c) + list(t.langs), pa.string()), pa.array([*_upper(t.hash).tolist(), *[None] * len(total)], pa.int32()),
                                           pa.array(np.r_[c, total])], schema=COUNTS)

    return step


def _pair_counts(words):
    def make():
        often = words.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            t = Tokens(batch)
            t.keep(often(t.hash)[t.x])
            return _counted(t.pair_hashes()[t.joined()])

        return step

    return make


def _edges(words, pairs):
    def make():
        word_often, pair_often = words.value, pairs.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            t = Tokens(batch)
            t.keep(word_often(t.hash)[t.x])
            n = len(t.x)
            if not n:
                return None
            # a pair that is rare for certain parts pieces
            parted = ~t.joined() | ~pair_often(t.pair_hashes())
            piece = np.r_[np.cumsum(np.r_[0, parted]), -1, -1, -1]
            x = np.r_[t.x + 1, 0, 0, 0].astype(_U)

            def after(k: int) -> np.ndarray:
                return np.where(piece[k : n + k] == piece[:n], x[k : n + k], _U(0))

            low, shift = _U((1 << 32) - 1), _U(32)
            first, a = np.unique((x[:n] << shift) | after(1), return_inverse=True)
            second, b = np.unique((after(2) << shift) | after(3), return_inverse=True)
            grams, counts = np.unique((a.astype(_U) << shift) | b.astype(_U), return_counts=True)
            a, b = first[grams >> shift], second[grams & low]
            ids = [x.astype(np.int64) for x in (a >> shift, a & low, b >> shift, b & low)]

            def word(i: np.ndarray) -> pa.Array:
                return t.words.take(pa.array(t.word[np.maximum(i - 1, 0)], mask=i == 0))

            head = pc.binary_join_element_wise(*[word(i) for i in ids[:3]], " ", null_handling="skip")
            named = pa.array(t.langs, pa.string()).take(pa.array(t.lang[ids[0] - 1]))
            return pa.RecordBatch.from_arrays([named, head, word(ids[3]), pa.array(counts.astype(np.int64))], schema=EDGES)

        return step

    return make


def _combined(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Edges of several batches, each once; those of a node next to each other."""
    table = pa.Table.from_batches(held).group_by(["lang", "head", "last"], use_threads=False).aggregate([("c", "sum")])
    table = table.rename_columns(["lang", "head", "last", "c"]).sort_by([("lang", "ascending"), ("head", "ascending")])
    return table.cast(EDGES).to_batches(max_chunksize=1 << 16)


def edges(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, batch_bytes: int = 12 << 20,
          word_bits: int = 24, pair_bits: int = 27) -> tuple[DataFrame, DataFrame]:
    """(lang, head, last, c), the longest grams of docs, combined within batches of
    texts: head holds the first three words, last the fourth, null at a piece's end;
    and (lang, f), each lang's words in all.

    A gram of min_count occurrences holds no rarer word or pair. So two passes count
    these by hash (hashes that collide count as one, never as less) and leave bits of
    fixed size, 2 MB and 16 MB; the last pass parts pieces at what is rare for
    certain. On larger inputs the bits fill and part less; what is counted is exact
    either way."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).where("text is not null")
    types = "lang string, h int, c long"
    # of the words only those often enough are read again
    words = stage(map_rows(rows, _word_counts, types, batch_bytes).groupBy("lang", "h").agg(F.sum("c").alias("f")).where(
        F.col("h").isNull() | (F.col("f") >= min_count)), "zstd")
    word_filter = spark.sparkContext.broadcast(Filter.of(words, min_count, word_bits))
    pairs = map_rows(rows, _pair_counts(word_filter), types, batch_bytes).groupBy("h").agg(F.sum("c").alias("f"))
    pair_filter = spark.sparkContext.broadcast(Filter.of(pairs, min_count, pair_bits))
    make = _edges(word_filter, pair_filter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, held, n = make(), [], 0
        for batch in batches:
            for part in slices(batch, batch_bytes):
                if (out := step(part)) is not None:
                    held.append(out)
                    n += out.num_rows
                if n >= COMBINE:
                    yield from _combined(held)
                    held, n = [], 0
        if held:
            yield from _combined(held)

    found = rows.mapInArrow(run, "lang string, head string, last string, c long")
    return found, words.where("lang is not null and f > 0").select("lang", "f")


def _first(gram: Column, n: int) -> Column:
    return F.call_function("substring_index", gram, F.lit(" "), F.lit(n))


def _after_first(gram: Column) -> Column:
    """A gram without its first word."""
    return F.call_function("substring", gram, F.length(_first(gram, 1)) + 2)


def _size(gram: Column) -> Column:
    return F.length(gram) - F.length(F.replace(gram, F.lit(" "), F.lit(""))) + 1


def graph(docs: DataFrame, *, min_count: int = 30, **columns) -> DataFrame:
    """(k, lang, gram, f): every gram of k = 1 to 4 words with f >= min_count
    occurrences, and for k = 0 each lang's words in all (gram null).

    The edges are shuffled once, by node, and leave one row a node with its flow,
    and one for each edge of enough weight; the flows of pairs, then of words, are
    each aggregated from the level above."""
    rows, total = edges(docs, min_count=min_count, **columns)
    summed = rows.repartition("lang", "head").groupBy("lang", "head", "last").agg(F.sum("c").alias("f"))
    node = Window.partitionBy("lang", "head")
    heavy = F.col("last").isNotNull() & (F.col("f") >= min_count)
    flows = summed.withColumn("flow", F.sum("f").over(node)).withColumn("nth", F.row_number().over(node.orderBy("last")))
    # a node of less weight only adds to the pair that it starts with
    name = F.when(F.col("flow") >= min_count, F.col("head")).otherwise(_first(F.col("head"), 2))
    found = stage(flows.where((F.col("nth") == 1) | heavy).select(
        "lang", name.alias("head"), F.when(F.col("nth") == 1, F.col("flow")).alias("flow"), F.when(heavy, F.col("last")).alias("last"), "f"), "zstd")
    nodes = found.where("flow is not null").select("lang", F.col("head").alias("gram"), F.col("flow").alias("f"))
    # a node of fewer than three words is a piece's end: it adds to the pair or word of its own words
    pairs = stage(nodes.groupBy("lang", _first(F.col("gram"), 2).alias("gram")).agg(F.sum("f").alias("f")), "zstd")
    single = stage(pairs.groupBy("lang", _first(F.col("gram"), 1).alias("gram")).agg(F.sum("f").alias("f")), "zstd")

    def level(df: DataFrame, k: int) -> DataFrame:
        return df.where((F.col("f") >= min_count) & (_size(F.col("gram")) == k)).select(F.lit(k).alias("k"), "lang", "gram", "f")

    four = found.where("last is not null").select(F.lit(4).alias("k"), "lang", F.concat_ws(" ", "head", "last").alias("gram"), "f")
    total = total.select(F.lit(0).alias("k"), "lang", F.lit(None).cast("string").alias("gram"), "f")
    return stage(four.union(level(nodes, 3)).union(level(pairs, 2)).union(level(single, 1)).union(total), "zstd")


# ------------------------------------------------------------------ paths


def _of(grams: DataFrame, k: int) -> DataFrame:
    return grams.where(F.col("k") == k).select("lang", "gram", "f")


def paths(grams: DataFrame, max_rounds: int = 64) -> DataFrame:
    """The four-word edges of ``graph``, compacted: (lang, path, chunk, words, flows),
    the words of a run of edges and the count of each edge. ``path`` is the run's
    first edge; runs meet only in nodes with more ways in or out than one. Runs of
    more than CHUNK edges are several chunks, each starting with the last three
    words of the one before. An edge of a closed ring stays a run of its own.

    Every edge points at the one before it and takes over that one's pointer round
    by round, so a run of n edges takes log2(n) rounds; each is written.
    """
    edge = stage(_of(grams, 4).select("lang", "gram", "f", _first(F.col("gram"), 3).alias("src"), _after_first(F.col("gram")).alias("dst")), "zstd")
    out = edge.groupBy("lang", F.col("src").alias("node")).agg(F.count("*").alias("out"))
    into = edge.groupBy("lang", F.col("dst").alias("node")).agg(F.count("*").alias("into"), F.min("gram").alias("before"))
    unary = out.join(into, ["lang", "node"]).where("`out` = 1 and `into` = 1").select("lang", F.col("node").alias("src"), "before")
    state = stage(edge.join(unary, ["lang", "src"], "left").select(
        "lang", "gram", F.coalesce("before", "gram").alias("ptr"), F.col("before").isNull().alias("done"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("dist")), "zstd")
    left = state.where("not done").count()
    for _ in range(max_rounds):
        if not left:
            break
        to = state.select("lang", F.col("gram").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("done").alias("done2"), F.col("dist").alias("dist2"))
        moved = state.where("not done").join(to, ["lang", "ptr"]).select("lang", "gram", F.col("ptr2").alias("ptr"), F.col("done2").alias("done"), (F.col("dist") + F.col("dist2")).alias("dist"))
        state = stage(state.where("done").union(moved), "zstd")
        before, left = left, state.where("not done").count()
        if left == before:  # a run ends sooner each round: what is left are rings
            break
    else:
        raise RuntimeError(f"paths did not settle in {max_rounds} rounds")
    ranked = state.select("lang", "gram", F.when(F.col("done"), F.col("ptr")).otherwise(F.col("gram")).alias("path"), F.when(F.col("done"), F.col("dist")).otherwise(0).alias("dist"))
    rows = ranked.join(edge, ["lang", "gram"]).groupBy("lang", "path", F.expr(f"dist div {CHUNK}").alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("dist", "gram", "f"))).alias("run"))
    last = F.transform("run", lambda e: F.call_function("substring_index", e["gram"], F.lit(" "), F.lit(-1)))
    return rows.select("lang", "path", "chunk", F.concat(F.split(_first(F.col("run")[0]["gram"], 3), " "), last).alias("words"), F.transform("run", lambda e: e["f"]).alias("flows"))


def _longer_at_nodes(found: DataFrame) -> DataFrame:
    """(lang, gram, longer): for each three-word node the largest count of an edge at
    it. Inside a run a node has the two edges beside it; ends meet in an aggregation."""
    node = lambda i: F.concat_ws(" ", F.slice("words", i, 3))
    inner = found.where(F.size("flows") > 1).select("lang", F.explode(F.transform(F.sequence(F.lit(1), F.size("flows") - 1), lambda i: F.struct(
        node(i + 1).alias("gram"), F.greatest(F.get("flows", i - 1), F.get("flows", i)).alias("longer")))).alias("x")).select("lang", "x.gram", "x.longer")
    ends = found.select("lang", F.explode(F.array(F.struct(node(F.lit(1)).alias("gram"), F.get("flows", F.lit(0)).alias("longer")),
                                                  F.struct(node(F.size("flows") + 1).alias("gram"), F.element_at("flows", -1).alias("longer")))).alias("x")).select("lang", "x.gram", "x.longer")
    return inner.union(ends).groupBy("lang", "gram").agg(F.max("longer").alias("longer"))


def _exact(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(20,0)")


def _score(*cuts: tuple[str, str]) -> Column:
    """The lowest-scoring cut (score, k, l, r), ties to the smallest k."""
    return F.array_min(F.array(*[F.struct(
        F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _exact("f"), _exact(left) + _exact(right)).alias("score"),
        F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")) for k, (left, right) in enumerate(cuts, 1)]))


def candidates(grams: DataFrame, percent: int = 80) -> DataFrame:
    """(lang, phrase, a, l, r, score, kept) for each gram of two to four words: the
    parts of its lowest-scoring cut, floor(2000000 a / (l + r)), and whether no
    longer gram around it has at least percent of its count. Only the grams' own
    prefixes and suffixes are joined, level by level."""

    def attach(upper: DataFrame, lower: DataFrame, key: Column, names: dict[str, str]) -> DataFrame:
        side = lower.select("lang", F.col("gram").alias("key"), *[F.col(a).alias(b) for a, b in names.items()])
        return upper.withColumn("key", key).join(side, ["lang", "key"]).drop("key")

    gram = F.col("gram")
    one = _of(grams, 1)
    two = attach(attach(_of(grams, 2), one, _first(gram, 1), {"f": "first1"}), one, _after_first(gram), {"f": "last1"})
    two = stage(two, "zstd")
    three = attach(_of(grams, 3), two, _first(gram, 2), {"f": "first2", "first1": "first1"})
    three = stage(attach(three, two, _after_first(gram), {"f": "last2", "last1": "last1"}), "zstd")
    four = attach(_of(grams, 4), three, _first(gram, 3), {"f": "first3", "first2": "first2", "first1": "first1"})
    four = attach(four, three, _after_first(gram), {"f": "last3", "last2": "last2", "last1": "last1"})

    # a gram of four words around a pair holds one of three that counts no less
    around = three.select("lang", _first(gram, 2).alias("gram"), "f").union(three.select("lang", _after_first(gram).alias("gram"), "f"))
    around = around.groupBy("lang", "gram").agg(F.max("f").alias("longer"))
    longest = _longer_at_nodes(paths(grams))
    scored = [(two, around, _score(("first1", "last1"))), (three, longest, _score(("first1", "last2"), ("first2", "last1"))),
              (four, None, _score(("first1", "last3"), ("first2", "last2"), ("first3", "last1")))]
    out = None
    for table, longer, cut in scored:
        own = table.select("lang", "gram", "f", cut.alias("cut"))
        own = own.join(longer, ["lang", "gram"], "left") if longer is not None else own.withColumn("longer", F.lit(None).cast("long"))
        kept = F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * _exact("longer") < F.lit(percent).cast("decimal(3,0)") * _exact("f"))
        own = own.select("lang", gram.alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score", kept.alias("kept"))
        out = own if out is None else out.union(own)
    return out


def collocations(docs: DataFrame, *, min_count: int = 30, percent: int = 80, top: int = 2000, **columns) -> DataFrame:
    """Each lang's first ``top`` phrases by score, count (both descending) and phrase
    (UTF-8 byte order): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z); ``[.,;:!?\\x0A-\\x0D]`` ends a piece, blanks and tabs
    part words; all else belongs to words. Rows with a null lang count as ``und``;
    null and empty texts have no words; repeated rows count as often as they come.
    An empty table, and a lang without a phrase of min_count occurrences, gives no
    rows. Ids are not read, nor are other columns, whatever their names.
    """
    grams = graph(docs, min_count=min_count, **columns)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates(grams, percent).where("kept").withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    words = grams.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(min_count: int = 30, percent: int = 80, top: int = 2000) -> str:
    """DuckDB SQL for ``collocations``: every gram of one to four words counted by itself."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(f"SELECT lang, {k} AS k, w[i:i + {k - 1}] AS g FROM spots WHERE i + {k - 1} <= len(w)" for k in (1, 2, 3, 4))
    return rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
every AS (SELECT lang, k, g, count(*) AS f FROM ({grams}) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM every WHERE k = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, g, list_aggregate(g, 'string_agg', ' ') AS phrase, f FROM every WHERE f >= {min_count}),
c AS (SELECT lang, k, g, phrase, f AS a FROM f WHERE k > 1),
cuts AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
halves AS MATERIALIZED (SELECT *, list_aggregate(g[:cut], 'string_agg', ' ') AS first_part, list_aggregate(g[cut + 1:], 'string_agg', ' ') AS rest FROM cuts),
s AS (SELECT u.*, x.f AS l, y.f AS r, (2000000::HUGEINT * u.a) // (x.f + y.f) AS score
FROM halves u JOIN f x ON x.lang = u.lang AND x.phrase = u.first_part JOIN f y ON y.lang = u.lang AND y.phrase = u.rest),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, a, unnest(list_transform(range(1, k), lambda i: g[i:i + 1])) AS g FROM c WHERE k > 2 UNION ALL SELECT lang, a, unnest([g[1:3], g[2:4]]) FROM c WHERE k = 4),
longer AS MATERIALIZED (SELECT lang, list_aggregate(g, 'string_agg', ' ') AS phrase, max(a) AS longer FROM inside GROUP BY ALL),
kept AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < {percent}::HUGEINT * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= {top}"""
