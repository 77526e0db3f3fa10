"""Filter interaction audit by decision diagrams of failure masks.

A document's failure mask says which filters it fails. Spark counts the documents per part and mask, at
most 2 ** n rows a part for n filters, and builds one diagram from each part's rows: a level per filter, a
pass and a fail edge per node, equal subdiagrams shared, counts at the leaves and summed in every node.
Following the pass edges from the root gives the steps of the order in which the levels stand. All orders
are reached by swaps of two adjacent levels, each of which rewrites the nodes of one level in place.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_engine.llm import words as W
from incident_engine.llm.batches import flat, slices
from incident_engine.scratch import cut_lineage

Counts = tuple[int, ...]

#: The text filters and their bits; REPEAT fails texts that a smaller id has.
SHORT, POOR, LOUD, SYMBOL, REPEAT = FILTERS = "ABCDE"
MIN_WORDS = 200
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*|")] = True


class Diagram:
    """An ordered decision diagram over the bits of a mask, with count vectors at its leaves."""

    def __init__(self, n: int, counts: Mapping[int, Counts], width: int):
        self.order = list(range(n))
        self.kids: list[tuple[int, int]] = []
        self.total: list[Counts] = []
        self.tables: list[dict] = [{} for _ in range(n + 1)]
        nodes = [self._leaf(counts.get(self._mask(i, n), (0,) * width)) for i in range(2**n)]
        for depth in reversed(range(n)):
            nodes = [self._node(depth, nodes[i], nodes[i + 1]) for i in range(0, len(nodes), 2)]
        self.root = nodes[0]

    @staticmethod
    def _mask(i: int, n: int) -> int:
        """The mask of leaf i: the first level is the leaf number's highest bit, but the mask's lowest."""
        return sum(1 << k for k in range(n) if i >> (n - 1 - k) & 1)

    def _add(self, table: dict, key: tuple, kids: tuple[int, int], total: Counts) -> int:
        if key not in table:
            table[key] = len(self.kids)
            self.kids.append(kids)
            self.total.append(total)
        return table[key]

    def _leaf(self, counts: Counts) -> int:
        return self._add(self.tables[-1], counts, (-1, -1), counts)

    def _node(self, depth: int, passed: int, failed: int) -> int:
        total = tuple(a + b for a, b in zip(self.total[passed], self.total[failed]))
        return self._add(self.tables[depth], (passed, failed), (passed, failed), total)

    def swap(self, depth: int) -> None:
        """Exchange the levels `depth` and `depth + 1`; nodes above keep pointing to the same nodes."""
        upper, self.tables[depth], self.tables[depth + 1] = self.tables[depth], {}, {}
        for (passed, failed), node in upper.items():
            (pp, pf), (fp, ff) = self.kids[passed], self.kids[failed]
            self.kids[node] = self._node(depth + 1, pp, fp), self._node(depth + 1, pf, ff)
            self.tables[depth][self.kids[node]] = node
        self.order[depth], self.order[depth + 1] = self.order[depth + 1], self.order[depth]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """Filter, counts kept and counts removed of each step along the all-pass path."""
        node = self.root
        for bit in self.order:
            node, failed = self.kids[node]
            yield bit, self.total[node], self.total[failed]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Positions of the adjacent swaps that lead through all orders of n things, each met once."""
    if n < 2:
        return
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + down
        down = not down


def audit_counts(n: int, counts: Mapping[int, Counts], width: int) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique fails, removed counts, removed over all orders)."""
    diagram = Diagram(n, counts, width)
    found = [(tuple(diagram.order), list(diagram.steps()))]
    for depth in adjacent_swaps(n):
        diagram.swap(depth)
        found.append((tuple(diagram.order), list(diagram.steps())))
    fails, alone, summed = [0] * n, [0] * n, [0] * n
    for _, path in found:
        for step, (bit, _, removed) in enumerate(path):
            summed[bit] += removed[0]
            if step == 0:
                fails[bit] = removed[0]
            if step == n - 1:
                alone[bit] = removed[0]
    for order, path in found:
        for step, (bit, kept, removed) in enumerate(path):
            yield order, step + 1, kept[0], removed[0], fails[bit] - removed[0], alone[bit], removed[1:], summed[bit]


def audit(masks: DataFrame, filters: str = FILTERS, outcomes: Sequence[str] = (), n: str = "n") -> DataFrame:
    """The interaction of `filters` (a letter each) in every order, per part.

    `masks` has the columns `part`, `mask` (bit k is set where the filter k fails), `n` (documents) and a
    count per outcome; rows of one part and mask are summed, so it may hold one row per document or
    counts. The result has a row per part, `filter_order` and `step`: documents kept after the step,
    `removed` here, `redundant` (failing its filter, but removed earlier), `unique_fails` (failing its
    filter only), `<outcome>_lost` (outcomes of those removed here) and `shapley` (documents that its
    filter removes, summed over all orders). A part without documents has no rows, so an empty table
    gives an empty result. Only sums per part and mask meet in a task, 2 ** n rows a part.
    """
    sums = masks.groupBy("part", "mask").agg(*(F.sum(c).cast("long").alias(c) for c in (n, *outcomes)))
    size, columns = len(filters), (n, *outcomes)
    names = ["kept", "removed", "redundant", "unique_fails", *(f"{c}_lost" for c in outcomes), "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names)

    def run(group: pa.Table) -> pa.Table:
        counts = {m: c for m, *c in zip(*(group.column(c).to_pylist() for c in ("mask", *columns)))}
        counts = {m: tuple(c) for m, c in counts.items()}
        part = group.column("part")[0].as_py()
        rows = [
            (part, "".join(filters[b] for b in order), step, *head, *lost, shapley)
            for order, step, *head, lost, shapley in audit_counts(size, counts, len(columns))
        ]
        arrays = [pa.array(c) for c in zip(*rows)]
        arrays[2] = arrays[2].cast(pa.int32())
        return pa.table(arrays, names=["part", "filter_order", "step", *names])

    return sums.groupBy("part").applyInArrow(run, schema)


def text_masks(column: pa.Array) -> tuple[list[int], list[bytes]]:
    """The bits of the four filters that look at one text, and the digest of each text."""
    data, offsets = flat(column)
    capitals = W.per_text((data >= 65) & (data <= 90), offsets)
    points = W.per_text((data & 0xC0) != 0x80, offsets)
    symbols = W.per_text(SYMBOLS[data], offsets) > 0
    masks, digests = [], []
    for i in range(len(column)):
        text = data[offsets[i] : offsets[i + 1]].tobytes()
        words = text.split()
        few = len(words) < MIN_WORDS
        poor = 100 * len(set(words)) < 50 * len(words)
        loud = 100 * int(capitals[i]) > 3 * int(points[i])
        masks.append(few | poor << 1 | loud << 2 | int(symbols[i]) << 3)
        digests.append(sha256(text).digest())
    return masks, digests


def failure_masks(docs: DataFrame, labels: DataFrame, part: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """part, mask, n, good, toxic: documents per part, failure mask and label, for :func:`audit`.

    The filters fail a text of under 200 words (A); whose distinct words are under half of its words (B);
    with over 3 capitals A to Z in 100 code points (C); with one of `#$%&*|` (D); that a smaller id has too
    (E). A null text is an empty one and fails A, and E where a smaller id has an empty text. Rows without
    id never fail E, make no other row fail it and have no label. Repeated rows of one id count each and do
    not fail E by each other. Labels of one id are joined by their largest values; a missing label counts
    as neither good nor toxic. Rows are counted per id and text before the two joins, whose keys then meet
    few rows each; no document's text is shuffled.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), part.alias("part"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2).cast(pa.large_string()).fill_null("")
            for i, j in slices(flat(column)[1]):
                masks, digests = text_masks(column.slice(i, j - i))
                head = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [head.column(0), head.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                    ["id", "part", "base", "digest"],
                )

    marked = rows.mapInArrow(run, "id long, part string, base int, digest binary")
    cells = cut_lineage(marked.groupBy("id", "digest", "part", "base").agg(F.count(F.lit(1)).alias("n")))
    named = cells.where("id IS NOT NULL")
    first = named.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    best = labels.groupBy(F.col(doc_id).cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = named.join(first, ["id", "digest"], "left").join(best, "id", "left")
    repeat = F.when(F.col("first").isNull(), 1 << FILTERS.index(REPEAT)).otherwise(0)
    known = known.select("part", (F.col("base") + repeat).alias("mask"), "n", "good", "toxic")
    nameless = cells.where("id IS NULL").select("part", F.col("base").alias("mask"), "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))

    def counted(flag: str) -> Column:
        return F.sum(F.col("n") * F.coalesce(flag, F.lit(0))).alias(flag)

    return known.unionByName(nameless).groupBy("part", "mask").agg(counted("good"), counted("toxic"), F.sum("n").alias("n"))


def statement() -> str:
    """The audit of `documents` and `labels` as SQL."""
    letters = ", ".join(f"('{f}', {1 << k})" for k, f in enumerate(FILTERS))
    joins = "CROSS JOIN f AS f2 CROSS JOIN f AS f3 CROSS JOIN f AS f4 CROSS JOIN f AS f5"
    return f"""
WITH f(name, bit) AS (VALUES {letters}),
orders AS (
  SELECT f1.name || f2.name || f3.name || f4.name || f5.name AS filter_order,
    [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS bits
  FROM f AS f1 {joins} WHERE f1.bit + f2.bit + f3.bit + f4.bit + f5.bit = 31
    AND len(list_distinct([f1.bit, f2.bit, f3.bit, f4.bit, f5.bit])) = 5
),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
),
best AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(words) < {MIN_WORDS})::INTEGER
    + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INTEGER
    + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER
    + 16 * coalesce(texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t), false)::INTEGER AS mask
  FROM texts LEFT JOIN best ON texts.doc_id = best.doc_id
),
masks AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM docs GROUP BY part, mask
),
steps AS (SELECT filter_order, k::INTEGER AS step, bits[k] AS bit, list_sum([0] || bits[1:k - 1])::INTEGER AS earlier
  FROM orders, range(1, 6) AS r(k)),
met AS (
  SELECT part, filter_order, step, bit, n, good, toxic, mask, mask & earlier = 0 AS reached, mask & bit <> 0 AS fails
  FROM masks, steps
),
sums AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (reached AND NOT fails), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (reached AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (NOT reached AND fails), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (reached AND fails), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (reached AND fails), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM sums"""
