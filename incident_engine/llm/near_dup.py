"""Near duplicates by SetSketch: mergeable registers, banded; candidates estimated, then verified.

A register holds, on an exponential scale, the least of the exponential variables that a hash draws for
the elements of a set; registers of the union are the maxima of the sets' registers, and two sets agree in
a register with a probability that rises with their Jaccard similarity. Equal sets are one class from the
start. Classes that agree in a whole band are candidates: each is first compared with the most typical class
of the buckets it shares most, in rounds, as long as these link at least half of what they compare. Buckets
that then still hold different components are compared in blocks of bounded size, on full sets and emitting
links only, so that no link between candidates is missed and copies are never expanded into all pairs. A large
component fills blocks of its own, which meet the others but not each other: the cost of a family of copies
follows its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.llm import words as W
from incident_engine.llm.batches import flat, map_texts, slices
from incident_engine.llm.components import components

WORDS = 5
#: Links need percent * |union| <= 100 * |intersection|; this is the percent unless a caller gives another.
PERCENT = 85
#: Registers of a set, and the probability with which a pair at the limit may miss all bands.
REGISTERS, MISS = 192, 3e-7
#: Base and rate of the registers' scale, and its last value.
BASE, RATE, TOP = 1.001, 20.0, 65535
#: A candidate is verified unless its estimate lies this many deviations under the limit.
DEVIATIONS = 7.0
#: Most classes on one side of a block comparison.
BLOCK = 384

_rng = np.random.Generator(np.random.PCG64(8051))
_XOR = _rng.integers(0, 2**64, REGISTERS, dtype=np.uint64)
_MUL = _rng.integers(0, 2**64, REGISTERS, dtype=np.uint64) | np.uint64(1)


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows for a limit: the longest bands by which a pair at the limit is missed with MISS at most."""
    for rows in range(REGISTERS, 0, -1):
        agree = (percent / 100) ** rows
        bands = 1 if agree == 1 else math.ceil(math.log(MISS) / math.log1p(-agree)) if agree > 0 else REGISTERS + 1
        if bands * rows <= REGISTERS:
            return bands, rows
    raise ValueError(f"{REGISTERS} registers are too few to find pairs of {percent} percent")


def shingle_sets(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the n + 1 offsets of the texts in them."""
    data, offsets = flat(column)
    data = W.LOWER[data]
    starts, ends, at = W.find_words(data, offsets)
    words = W.span_hashes(data, starts, ends)
    first = np.flatnonzero(W.whole_windows(at, len(words), size))
    hashes, of = W.shingle_hashes(words, size)[first], W.text_of(at)[first]
    counts = np.diff(at)
    short = np.flatnonzero((counts > 0) & (counts < size))  # the whole sequence is the one shingle
    if len(short):
        one = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            one[has] = W.mix(one[has] * np.uint64(0x9DDFEA08EB382D69) + words[at[short[has]] + k] + np.uint64(k + 1))
        hashes, of = np.concatenate([hashes, one]), np.concatenate([of, short])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[fresh], of[fresh]
    return hashes, np.searchsorted(of, np.arange(len(offsets)))


def registers(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SetSketch registers of non-empty sets, one row each."""
    least = np.empty((len(at) - 1, REGISTERS), np.uint64)
    work = np.empty_like(hashes)
    for i in range(REGISTERS):
        np.bitwise_xor(hashes, _XOR[i], out=work)
        np.multiply(work, _MUL[i], out=work)
        least[:, i] = np.minimum.reduceat(work, at[:-1])
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)) + 1, 0, TOP).astype("<u2")


def identity(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums by which equal non-empty sets, and no others but by chance, agree."""
    two = (np.add.reduceat(W.mix(hashes ^ np.uint64(c)), at[:-1]) for c in (0x51ED27, 0xA3C59AC3))
    a, b = (x.view(np.int64) for x in two)
    return a, b


def _sketch(column: pa.Array) -> list[pa.Array]:
    hashes, at = shingle_sets(column)
    sizes = np.diff(at)
    full = np.flatnonzero(sizes)
    k1, k2, rows = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), [b""] * len(sizes)
    if len(full):
        tight = np.append(at[:-1][full], len(hashes))
        k1[full], k2[full] = identity(hashes, tight)
        for i, row in zip(full.tolist(), registers(hashes, tight)):
            rows[i] = row.tobytes()
    return [pa.array(sizes), pa.array(k1), pa.array(k2), pa.array(rows, pa.binary())]


SKETCH = T.StructType([T.StructField(n, T.LongType()) for n in ("n", "k1", "k2")] + [T.StructField("sketch", T.BinaryType())])


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n (set size), k1 and k2 (the set's identity) and the registers of every row."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return map_texts(narrow, "text", "s", SKETCH, _sketch).select("id", "s.*")


def merge_registers(a: bytes, b: bytes) -> bytes:
    """Registers of the union of two sets."""
    return np.maximum(np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2")).tobytes()


def estimate(a: np.ndarray, b: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Jaccard similarity of register rows by maximum likelihood of the signs of their differences.

    With u and v the shares of the set sizes, a register of the first set is the larger with probability
    p(u - v J), of the second with p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)

    def gain(j: np.ndarray) -> np.ndarray:
        one, two = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return more * np.log(one) + less * np.log(two) + same * np.log(np.maximum(1 - one - two, 1e-12))

    for _ in range(30):  # the likelihood has one peak
        x, y = low + (high - low) / 3, high - (high - low) / 3
        up = gain(x) < gain(y)
        low, high = np.where(up, x, low), np.where(up, high, y)
    return (low + high) / 2


def _buckets(classes: DataFrame, percent: int) -> DataFrame:
    """key, node for each band of each class."""
    bands, length = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)[:, : bands * length].reshape(-1, bands, length)
            keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(rows), 1))
            for r in range(length):
                keys = W.mix(keys * np.uint64(0x9DDFEA08EB382D69) + rows[:, :, r])
            nodes = np.repeat(batch.column("node").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(nodes)], ["key", "node"])

    return classes.select("node", "sketch").mapInArrow(run, "key long, node long")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimated similarity may reach the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = percent / 100
        floor = limit - DEVIATIONS * np.sqrt(limit * (1 - limit) / (REGISTERS))
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("s_a", "s_b"))
            n1, n2 = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            good = (estimate(one, two, n1, n2) >= floor) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _links(pairs: DataFrame, texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the limit. `texts` holds id, text."""
    keys = classes.select(F.col("node").alias("id"), "k1")

    def side(nodes: DataFrame, node: str, text: str) -> DataFrame:
        """nodes with the text and expected identity of their class."""
        return nodes.join(keys.withColumnRenamed("id", node).withColumnRenamed("k1", f"k_{node}"), node).join(
            texts.withColumnRenamed("id", node).withColumnRenamed("text", text), node
        )

    members = side(pairs, "b", "t_b")
    centres = side(pairs.select("a").distinct(), "a", "t_a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[object, np.ndarray, int] = (None, np.zeros(0, np.uint64), 0)
        for batch in batches:
            mine = batch.column("t_b").cast(pa.large_string())
            good = np.zeros(batch.num_rows, bool)
            theirs = batch.column("t_a")
            a, k_a, k_b = (batch.column(c).to_numpy() for c in ("a", "k_a", "k_b"))
            _, offsets = flat(mine)
            for i, j in slices(offsets):
                hashes, at = shingle_sets(mine.slice(i, j - i))
                own = identity(hashes, at)[0] if len(hashes) and np.diff(at).all() else None
                for x in range(i, j):
                    if (a[x], k_a[x]) != last[0]:
                        other, _ = shingle_sets(theirs.slice(x, 1))
                        last = ((a[x], k_a[x]), other, int(identity(other, np.array([0, len(other)]))[0][0]) if len(other) else 0)
                    one = hashes[at[x - i] : at[x - i + 1]]
                    if last[2] != k_a[x] or own is None or own[x - i] != k_b[x]:
                        continue
                    both = len(np.intersect1d(one, last[1], assume_unique=True))
                    good[x] = 100 * both >= percent * (len(one) + len(last[1]) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return members.join(centres, "a").mapInArrow(run, "a long, b long").distinct()


def _block_links(texts: pa.Array, nodes: np.ndarray, parts: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between texts of different parts and sides (all pairs if there is one side): shared shingles by matrix products."""
    hashes, at = shingle_sets(texts)
    sizes = np.diff(at).astype(float)
    _, column, df = np.unique(hashes, return_inverse=True, return_counts=True)
    row = W.text_of(at)
    shared = df[column] > 1
    order = np.argsort(column[shared], kind="stable")
    row, column = row[shared][order], column[shared][order]
    one, two = (np.flatnonzero(side == k) for k in (side.min(), side.max()))
    both = np.zeros((len(one), len(two)), np.float32)
    names, place = np.unique(column, return_inverse=True)
    edges = np.searchsorted(place, np.arange(0, len(names) + 4096, 4096))
    for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
        has = np.zeros((len(nodes), 4096), np.float32)
        has[row[i:j], place[i:j] - 4096 * k] = 1
        both += has[one] @ has[two].T
    union = sizes[one][:, None] + sizes[two][None, :] - both
    a, b = np.nonzero((100 * both >= percent * union) & (parts[one][:, None] != parts[two][None, :]))
    a, b = nodes[one[a]], nodes[two[b]]
    return np.minimum(a, b), np.maximum(a, b)


def _blocks(left: DataFrame) -> DataFrame:
    """node, part, block of the classes in buckets (key, node, part), by clusters of buckets that share classes.

    A part that fills half a block or more has blocks of its own; smaller ones lie whole in a block.
    """
    chains = left.groupBy("key").agg(F.min("node").alias("a")).join(left.select("key", F.col("node").alias("b")), "key")
    clusters = components(chains.select("a", "b").distinct())
    placed = left.select("node", "part").distinct().join(clusters, "node")
    sizes = placed.groupBy("component", "part").agg(F.count(F.lit(1)).alias("size")).withColumn("own", F.col("size") >= BLOCK // 2)
    small = sizes.groupBy("component").agg(F.coalesce(F.sum(F.when(~F.col("own"), F.col("size"))), F.lit(0)).alias("small"))
    blocks = F.ceil(F.when(F.col("own"), F.col("size")).otherwise(F.col("small")) / BLOCK)
    sizes = sizes.join(small, "component").select("component", "part", "own", blocks.alias("blocks"))
    number = F.pmod(F.xxhash64(F.when(F.col("own"), F.col("node")).otherwise(F.col("part"))), F.col("blocks"))
    block = F.struct("component", "own", F.when(F.col("own"), F.col("part")).otherwise(F.lit(0)).alias("of"), number.alias("number"))
    return placed.join(sizes, ["component", "part"]).select("node", "part", block.alias("block"))


def _meetings(left: DataFrame, placed: DataFrame) -> DataFrame:
    """low, high: the pairs of blocks that have a bucket in common and are not of one part."""
    at = left.join(placed.select("node", "block"), "node").select("key", "block").distinct()
    pairs = at.withColumnRenamed("block", "low").join(at.withColumnRenamed("block", "high"), "key")
    one_part = (F.col("low.own") & F.col("high.own")) & (F.col("low.of") == F.col("high.of"))
    return pairs.where((F.col("low") <= F.col("high")) & ~one_part).select("low", "high").distinct()


def _left_links(left: DataFrame, texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links between different parts of buckets (key, node, part), by pairs of blocks."""
    placed = _blocks(left).checkpoint()
    meetings = _meetings(left, placed)
    two = F.array(*(F.struct(F.lit(k).alias("side"), F.col(x).alias("block")) for k, x in enumerate(("low", "high"))))
    sides = meetings.select("low", "high", F.explode(F.when(F.col("low") == F.col("high"), F.slice(two, 1, 1)).otherwise(two)).alias("x")).select("low", "high", "x.*")
    full = placed.join(classes.select("node", "k1"), "node").join(texts.withColumnRenamed("id", "node"), "node")
    dealt = full.join(sides, "block").select("low", "high", "side", "node", "part", "k1", "text")

    def run(group: pa.Table) -> pa.Table:
        column = group["text"].combine_chunks().cast(pa.large_string())
        hashes, at = shingle_sets(column)
        filled = np.flatnonzero(np.diff(at))
        own = np.zeros(len(column), np.int64)
        if len(filled):
            own[filled] = identity(hashes, np.append(at[:-1][filled], len(hashes)))[0]
        keep = np.flatnonzero(own == group["k1"].to_numpy())
        nodes, at = np.unique(group["node"].to_numpy()[keep], return_index=True)
        keep = keep[at]
        if not len(keep):
            return pa.table({"a": nodes, "b": nodes})
        part, side = (group[c].to_numpy()[keep] for c in ("part", "side"))
        a, b = _block_links(column.take(pa.array(keep)), nodes, part, side, percent)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("low", "high").applyInArrow(run, "a long, b long").distinct()


def _typical_pairs(left: DataFrame, spent: DataFrame | None) -> DataFrame:
    """a, b: each class of buckets (key, node, part) with the centre of the buckets that it shares most.

    A bucket's centre is the class that meets most others in all its buckets, ties by the least, spent ones
    left out: among near copies of one text, the one nearest to that text.
    """
    sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    met = left.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("met"))
    able = left.join(met, "node")
    if spent is not None:
        able = able.join(spent, "node", "left_anti")
    rank = F.struct(-F.col("met"), "node")
    centres = able.groupBy("key").agg(F.min_by("node", rank).alias("a"), F.min_by("part", rank).alias("part_a"))
    shared = left.join(centres, "key").where("part <> part_a").groupBy("node", "a").agg(F.count(F.lit(1)).alias("bands"))
    return shared.groupBy(F.col("node").alias("b")).agg(F.min_by("a", F.struct(-F.col("bands"), "a")).alias("a"))


def _unsettled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """key, node, part of the buckets (key, node) that hold several parts."""
    placed = members.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    mixed = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    return placed.join(mixed.select("key"), "key")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """id, n, component for every row of `docs`: set size and smallest id of its near duplicates.

    Words are lower-cased in A to Z and shingled by five; a shorter text is one shingle of all its words.
    Null and empty texts, and rows without id, are linked with nothing: their component is their own id.
    Pairs are linked from a Jaccard similarity of `percent` / 100 on, for which the bands are sized.
    Rows of equal text are linked; rows with the same id but other texts are judged on their own text.
    """
    rows = sketches(docs, doc_id, text).checkpoint()
    real = rows.where("n > 0 AND id IS NOT NULL")
    classes = real.groupBy("k1", "k2", "n").agg(F.min("id").alias("node"), F.first("sketch").alias("sketch")).checkpoint()
    buckets = _buckets(classes, percent)
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = buckets.join(shared.select("key"), "key").checkpoint()
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))

    left, links, spent, fruitful = members.withColumn("part", F.col("node")), None, None, True
    while fruitful:
        pairs = _typical_pairs(left, spent).checkpoint()
        found = _links(_likely(pairs, classes, percent).checkpoint(), texts, classes, percent).checkpoint()
        links = found if links is None else links.unionByName(found)
        centres = pairs.select(F.col("a").alias("node")).distinct()
        spent = centres if spent is None else spent.unionByName(centres)
        parts = components(links)
        left = _unsettled(members, parts).checkpoint()
        fruitful = 2 * found.count() >= pairs.count() > 0
    if left.head(1):
        parts = components(links.unionByName(_left_links(left, texts, classes, percent)))
    named = classes.join(parts, "node", "left").select("k1", "k2", F.col("n").alias("size"), F.coalesce("component", "node").alias("component"))
    keyed = real.join(named, (real.k1 == named.k1) & (real.k2 == named.k2) & (real.n == named["size"])).select("id", "n", "component")
    alone = rows.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component"))
    return keyed.unionByName(alone)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their near duplicates, own columns only.

    Rows without an id stay.
    """
    found = near_duplicates(docs, doc_id, text, percent)
    gone = found.where("id <> component").select(F.col("id").alias(doc_id)).distinct()
    return docs.join(gone, doc_id, "left_anti")
