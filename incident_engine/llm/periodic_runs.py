"""Periodic runs of words, found by tiles whose size follows the period and stitched by Spark.

A run is a maximal stretch of words with smallest period q (words q apart are equal) and a length of at
least max(24, 3 q). Periods are dealt into octaves. For an octave with periods below Q, the document is
marked every D = max(16, Q) words; every run of the octave holds such a mark b together with the q words
after it, as its length is at least 3 q (and 24). Around a mark, q belongs to a run if the words from b on
and from b + q on agree for f words, those before b and before b + q agree for g words, and f + g + q is
long enough: f for all q is one Z-function of the words after the mark, g one of the reversed words before.

A first pass over the texts keeps marks where a hash of max(8, Q / 2) words repeats at a distance of the
octave, after or before the mark, without which no run can be there. Each stretch of marks goes out as a
tile of its own, with 2 D words before and 3 D after, so that a long document is solved by many tasks. Tiles
yield fragments of runs, cut off at their edges; those of one document and period are shuffled together and
stitched where they overlap by at least the period.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.llm import words as W
from incident_engine.llm.batches import flat, free_name, slices
from incident_engine.scratch import scratch_path

#: Shortest run, in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words between the first and the last mark of a tile (eight marks at least), and of the tiles in one Arrow batch.
TILE_WORDS, BATCH_WORDS = 1 << 16, 1 << 20
#: Pairs of mark and period that the first pass compares at a time.
PAIRS = 1 << 20

RUNS = "array<struct<start: long, period: long, length: long>>"
TILE_COLUMNS = [
    T.StructField("octave", T.LongType()),
    T.StructField("low", T.LongType()),
    T.StructField("marks", T.ArrayType(T.LongType())),
    T.StructField("ids", T.BinaryType()),
]


def octave(k: int) -> tuple[int, int, int]:
    """First period, end of the periods and distance of marks of an octave: 1 to 7, 8 to 15, 16 to 31 and so on."""
    end = 8 << k
    return (1 if k == 0 else end // 2), end, max(16, end)


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def likely_marks(hashes: np.ndarray, n: int, size: int, first: int, end: int, step: int) -> np.ndarray:
    """Marks with a repeat of `size` words at a distance of `first` to `end` - 1, after or before the mark.

    `hashes` are those of all runs of `size` words of the n words.
    """
    end = min(end, n // LEAST_PERIODS + 1)
    if end <= first:
        return np.zeros(0, np.int64)
    # numbers that no position shares stand for what would reach beyond the text
    padded = np.concatenate([hashes, np.arange(n + end + size - len(hashes), dtype=np.uint64)])
    apart = np.lib.stride_tricks.sliding_window_view(padded, end - first)
    marks, found = np.arange(0, n, step), []
    block = max(1, PAIRS // (end - first))
    for i in range(0, len(marks), block):
        b = marks[i : i + block]
        hit = (apart[b + first] == padded[b][:, None]).any(axis=1)
        back = np.maximum(b - size, 0)
        hit |= (b >= size) & (apart[back + first] == padded[back][:, None]).any(axis=1)
        found.append(b[hit])
    return np.concatenate(found)


def tiles(ids: np.ndarray) -> Iterator[tuple[int, int, list[int], bytes]]:
    """octave, first word, marks and word numbers of every tile in which a run may be."""
    n, size, k = len(ids), 8, 0
    if n < LEAST_WORDS:
        return
    hashes = W.shingle_hashes(W.mix(ids.astype(np.uint64) + np.uint64(1)), size)
    while octave(k)[0] <= n // LEAST_PERIODS:
        first, end, step = octave(k)
        if size < end // 2:  # hashes of twice as many words from those of two halves
            if len(hashes) <= size:
                return
            hashes = W.mix(hashes[:-size] * np.uint64(0x9DDFEA08EB382D69) + hashes[size:])
            size *= 2
        marks = likely_marks(hashes, n, size, first, end, step)
        block = marks // max(8 * step, TILE_WORDS)
        apart = (np.diff(block) > 0) | (np.diff(marks) > 5 * step)
        for tile in np.split(marks, np.flatnonzero(apart) + 1) if len(marks) else ():
            low, high = max(0, int(tile[0]) - 2 * step), min(n, int(tile[-1]) + 3 * step)
            yield k, low, tile.tolist(), ids[low:high].tobytes()
        k += 1


def z_function(s: list[int]) -> list[int]:
    """For each position, how many items from there on equal those at the start."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        m = min(right - i, z[i - left]) if i < right else 0
        while i + m < n and s[m] == s[i + m]:
            m += 1
        z[i] = m
        if i + m > right:
            left, right = i, i + m
    return z


def is_power(period: int, after: list[int]) -> bool:
    """Whether the first `period` words, of which `after` is the Z-function, repeat a shorter word sequence."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            if after[period // prime] >= period - period // prime:
                return True
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return False


def fragments(k: int, low: int, marks: list[int], ids: list[int]) -> Iterator[tuple[int, int, int]]:
    """period, start and end of what a tile shows of the runs at its marks."""
    first, end, step = octave(k)
    seen = set()
    for mark in marks:
        b = mark - low
        left, right = max(0, b - 2 * step), min(len(ids), b + 3 * step)
        after = z_function(ids[b:right])
        top = min(right, b + end - 1)
        before = z_function([*ids[left:b][::-1], -1, *ids[left:top][::-1]])[b - left + 1 :]
        for q in range(first, min(end, right - b + 1)):
            f = after[q] if b + q < right else 0
            g = before[top - b - q]
            if f + g + q >= max(LEAST_WORDS, LEAST_PERIODS * q) and not is_power(q, after):
                seen.add((q, mark - g, mark + q + f))
    yield from seen


def stitched(found: DataFrame) -> DataFrame:
    """row, runs: the fragments (row, period, start, stop) of each document joined to whole runs.

    Fragments of one period that share at least that many words belong to one run; different runs of a
    period share fewer. A run's fragments overlap in a chain, so one pass in the order of their starts is enough.
    """
    dealt = found.repartition("row", "period")
    spans = dealt.groupBy("row", "period", "start").agg(F.max("stop").alias("stop"))
    group = Window.partitionBy("row", "period").orderBy("start")
    reached = F.max("stop").over(group.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("opens", (reached.isNull() | (F.col("start") > reached - F.col("period"))).cast("long"))
    numbered_runs = marked.withColumn("run", F.sum("opens").over(group.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered_runs.groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    run = F.struct("start", "period", (F.col("stop") - F.col("start")).alias("length"))
    return runs.groupBy("row").agg(F.array_sort(F.collect_list(run)).alias("runs"))


def keep_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run (start, period, length) holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, period, length in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep)]


def collapse_runs(docs: DataFrame, text: str = "text", as_digest: bool = False) -> DataFrame:
    """`docs` with `runs` (start, period and length in words, sorted) and `collapsed`, its kept words.

    A word is `[^\\x20\\x09-\\x0D]+`. Every word that a run holds after its first period is dropped; the others
    are joined by one blank. With `as_digest`, `collapsed` is the lower-case hex SHA-256 of that text and
    `text` is left out, so that the table between the passes holds only texts with tiles. A null or empty
    text has no runs and an empty rest. Rows are judged one by one, repeated rows alike; an empty table
    gives an empty result. Columns called `runs` or `collapsed` make the new names end in underscores.
    """
    spark = docs.sparkSession
    names = free_name(docs, "runs"), free_name(docs, "collapsed")
    own = [c for c in docs.columns if not (as_digest and c == text)]
    at, width = docs.columns.index(text), len(docs.columns)
    # fixed names inside, so that no column of `docs` can clash with those of the passes
    inner = docs.toDF(*(f"c{i}" for i in range(width)))
    fields = [T.StructField(f.name, f.dataType) for f in inner.schema]
    extra = [T.StructField("row", T.LongType()), T.StructField("rest", T.StringType()), *TILE_COLUMNS]
    schema = T.StructType([*fields, *extra])

    def rest_of(words: list[bytes]) -> str:
        joined = b" ".join(words)
        return sha256(joined).hexdigest() if as_digest else joined.decode("utf-8")

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            whole = batch.column(at).cast(pa.large_string()).fill_null("")
            kinds = [*batch.schema.types, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            titles = [*batch.schema.names, "row", "rest", *(f.name for f in TILE_COLUMNS)]

            def table(parts: list, n: int) -> pa.RecordBatch:
                full = [pa.array(p, t) if p is not None else pa.nulls(n, t) for p, t in zip(parts, kinds)]
                return pa.RecordBatch.from_arrays(full, titles)

            def tile_table(rows: list) -> pa.RecordBatch:
                number, *tile = zip(*rows)
                return table([None] * width + [number, None, *tile], len(rows))

            for i, j in slices(flat(whole)[1]):
                held, size, rests = [], 0, []
                for value in whole.slice(i, j - i):
                    words = value.as_buffer().to_pybytes().split()
                    row, had = row + 1, False
                    for tile in tiles(numbered(words)):
                        had = True
                        held.append((row, *tile))
                        size += len(tile[-1]) // 4
                        if size >= BATCH_WORDS:
                            yield tile_table(held)
                            held, size = [], 0
                    rests.append(None if had else rest_of(words))
                if held:
                    yield tile_table(held)
                head = batch.slice(i, j - i)
                columns = list(head.columns)
                if as_digest:  # texts without tiles are done with
                    columns[at] = columns[at].take(pa.array([k if r is None else None for k, r in enumerate(rests)], pa.int64()))
                numbers = pa.array(range(row - len(rests) + 1, row + 1), pa.int64())
                blank = [pa.nulls(len(rests), t) for t in kinds[width + 2 :]]
                yield pa.RecordBatch.from_arrays([*columns, numbers, pa.array(rests, pa.string()), *blank], titles)

    # written once, so that row numbers stand and a lost executor costs no second search
    path = scratch_path(spark, "tiles")
    inner.mapInArrow(first_pass, schema).write.parquet(path)
    staged = spark.read.schema(schema).parquet(path)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, k, low, marks, ids in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(row, *f) for f in fragments(k, low, marks, np.frombuffer(ids, np.int32).tolist())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["row", "period", "start", "stop"])

    tiled = staged.where("ids IS NOT NULL").select("row", "octave", "low", "marks", "ids")
    found = tiled.repartition("row", "octave", "low").mapInArrow(solve, "row long, period long, start long, stop long")

    rows = staged.where("ids IS NULL")
    open_rows = rows.where("rest IS NULL").drop("rest", *(f.name for f in TILE_COLUMNS))
    joined = open_rows.join(stitched(found), "row", "left").select(*inner.columns, "runs")

    def last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rests = []
            for value, runs in zip(batch.column(at).cast(pa.large_binary()), batch.column(width).to_pylist()):
                words = value.as_buffer().to_pybytes().split()
                rests.append(rest_of(keep_words(words, [(r["start"], r["period"], r["length"]) for r in runs or ()])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rests, pa.string())], [*batch.schema.names, "rest"])

    solved = joined.mapInArrow(last_pass, T.StructType([*joined.schema.fields, T.StructField("rest", T.StringType())]))
    closed = rows.where("rest IS NOT NULL").select(*inner.columns, F.lit(None).cast(RUNS).alias("runs"), "rest")
    both = solved.unionByName(closed).withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))
    kept = [F.col(f"c{docs.columns.index(c)}").alias(c) for c in own]
    return both.select(*kept, F.col("runs").alias(names[0]), F.col("rest").alias(names[1]))
