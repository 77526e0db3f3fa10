"""Approximate nearest neighbours: a graph built by NN-descent, searched greedily.

Equal vectors are one node. The graph starts from neighbours in a few orders by random hyperplanes and is
then improved in rounds: every node compares the members of its list (its neighbours and those it is a
neighbour of) with each other, so neighbours of neighbours meet through joins, and each member keeps its
best K. Queries walk the graph from their own node and from fixed entry nodes, all at once, one join per step;
a query's search so far is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine.scratch import shuffles_freed, unsized

#: Neighbours per node; rounds at most, and the share of new links under which building ends.
K, ROUNDS, SETTLED = 20, 6, 0.01
#: Orders of the first graph, hyperplanes of each, and nodes compared with each other in an order.
ORDERS, PLANES, RUN = 4, 12, 256
#: Best links that a list proposes to each of its members in one round.
PROPOSED = 6
#: Nodes that a search keeps and opens at a time, its entry nodes, and its steps at most.
BEAM, OPENED, ENTRIES, STEPS = 320, 128, 32, 20


#: Steps of a unit's components. Near copies differ in these, and their cosines, worked out in double
#: precision, in the last digits of a double only where those of the vectors themselves do.
STEP = 2**30


def _rows(column: pa.Array) -> np.ndarray:
    """The units of a column as rows of a matrix, of length 1 but for rounding."""
    data = column.to_pylist()
    if not data:
        return np.zeros((0, 1))
    x = np.frombuffer(b"".join(data), np.int32).reshape(len(data), -1) / STEP
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id, vector (doubles) of the rows that take part.

    Left out: rows without id, and vectors null, empty, zero, with a null or non-finite component, or of
    another length than most.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    real = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where("id IS NOT NULL AND vector IS NOT NULL").where(real & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (length[0].n if length else 0))


def _nodes(rows: DataFrame) -> DataFrame:
    """node (least id of equal vectors), vector (doubles), unit (direction in steps of 1 / STEP, four bytes each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([np.asarray(v) for v in batch.column("vector").to_pylist()])
            x = np.rint(STEP * (x / np.abs(x).max(axis=1, keepdims=True))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in x], pa.binary())], ["node", "vector", "unit"])

    return rows.groupBy("vector").agg(F.min("id").alias("node")).select("node", "vector").mapInArrow(run, "node long, vector array<double>, unit binary")


def _best(links: DataFrame, k: int = K) -> DataFrame:
    """The k best links (u, v, s, fresh) of each u; links met twice count once, and are no longer fresh."""
    once = links.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return once.withColumn("rank", rank).where(f"rank <= {k}").drop("rank")


def _first_graph(nodes: DataFrame, seed: int) -> DataFrame:
    """Links between nodes that lie close in some order by hyperplanes."""
    out = None
    for o in range(ORDERS):

        def key(batches: Iterator[pa.RecordBatch], o: int = o) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _rows(batch.column("unit"))
                planes = np.random.default_rng([seed, o]).standard_normal((x.shape[1], PLANES + 1)).astype(np.float32)
                y = x @ planes
                bits = (y[:, :PLANES] > 0).astype(np.int64)
                gray = np.cumsum(bits, axis=1) % 2  # codes one bit apart lie side by side
                code = gray @ (1 << np.arange(PLANES - 1, -1, -1)) + 1 / (1 + np.exp(-y[:, PLANES].astype(float)))
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("unit"), pa.array(code)], ["node", "unit", "code"])

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, RUN):
                    part = batch.slice(i, RUN)
                    x, ids = _rows(part.column("unit")), part.column("node").to_numpy()
                    sims = x @ x.T
                    np.fill_diagonal(sims, -2)
                    k = min(K, len(ids) - 1)
                    if k < 1:
                        continue
                    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                    rows = np.repeat(np.arange(len(ids)), k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(ids[top.ravel()]), pa.array(sims[rows, top.ravel()])], ["u", "v", "s"])

        coded = nodes.select("node", "unit").mapInArrow(key, "node long, unit binary, code double")
        links = coded.repartitionByRange(F.col("code"), F.col("node")).sortWithinPartitions("code", "node").mapInArrow(near, "u long, v long, s double")
        out = links if out is None else out.unionByName(links)
    return _best(out.withColumn("fresh", F.lit(True)))


def _met(lists: DataFrame) -> DataFrame:
    """Links that the lists (members: m, unit, worst, fresh) propose to their members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                members = batch.column("members").slice(i, 512)
                flat = members.flatten()
                sizes = np.diff(members.offsets.to_numpy())
                if not len(flat):
                    continue
                ids, worst, fresh = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("m", "worst", "fresh"))
                x = _rows(flat.field("unit"))
                width = int(sizes.max())
                place = np.full((len(sizes), width), -1)
                place[np.arange(width) < sizes[:, None]] = np.arange(len(flat))
                real = place >= 0
                twice = (ids[place][:, :, None] == ids[place][:, None, :]) & real[:, :, None] & real[:, None, :]
                new = (twice & fresh[place][:, None, :]).any(axis=2)  # a member linked both ways is there twice
                real &= ~np.tril(twice, -1).any(axis=2)
                y = x[place] * real[:, :, None]
                sims = y @ y.transpose(0, 2, 1)
                use = real[:, :, None] & real[:, None, :] & (new[:, :, None] | new[:, None, :])
                use &= ~np.eye(width, dtype=bool) & (sims > worst[place][:, :, None])
                sims = np.where(use, sims, -2)
                k = min(PROPOSED, width)
                top = np.argpartition(-sims, k - 1, axis=2)[:, :, :k]
                best = np.take_along_axis(sims, top, axis=2)
                g, a, c = np.nonzero(best > -2)
                u, v = ids[place[g, a]], ids[place[g, top[g, a, c]]]
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(best[g, a, c])], ["u", "v", "s"])

    return lists.mapInArrow(run, "u long, v long, s double")


def build(nodes: DataFrame, seed: int = 1) -> DataFrame:
    """The neighbour graph (u, v, s, fresh) of `nodes`, at most K links from each node."""
    graph = _first_graph(nodes, seed).checkpoint()
    for _ in range(ROUNDS):
        rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("s"), "u"))
        back = graph.withColumn("n", rank).where(f"n <= {K}").select(F.col("v").alias("u"), F.col("u").alias("m"), "fresh")
        members = graph.select("u", F.col("v").alias("m"), "fresh").unionByName(back)
        worst = graph.groupBy(F.col("u").alias("m")).agg(F.when(F.count(F.lit(1)) >= K, F.min("s")).otherwise(-2.0).cast("double").alias("worst"))
        told = nodes.select(F.col("node").alias("m"), "unit").join(worst, "m", "left").na.fill({"worst": -2.0})
        lists = members.join(told, "m").groupBy("u").agg(F.collect_list(F.struct("m", "unit", "worst", "fresh")).alias("members"))
        proposed = _met(lists.select("members")).withColumn("fresh", F.lit(True))
        graph = _best(graph.withColumn("fresh", F.lit(False)).unionByName(proposed)).checkpoint()
        total, new = graph.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("fresh").cast("int")), F.lit(0))).first()
        if new <= SETTLED * total:
            break
    return unsized(graph)


def _near_one(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring the largest component near 1: exact, and no square leaves the range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _scores(asked: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines of one vector with the rows of a matrix, in double precision."""
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    mine, vectors = np.tile(_near_one(asked[None]), (len(vectors), 1)), _near_one(vectors)
    return dot(mine, vectors) / (np.sqrt(dot(mine, mine)) * np.sqrt(dot(vectors, vectors)))


#: A search: its vector, the best nodes with their scores and, unless opened, links, all nodes asked for so far, those to score next.
STATE = "q long, asked array<double>, node array<long>, s array<double>, opened array<boolean>, links array<array<long>>, seen array<long>, next array<long>"


def _step(met: pa.Table, state: pa.Table) -> pa.Table:
    """The search after the nodes `met` (node, vector, links) are scored and the best not yet opened are opened."""
    own = state.slice(0, 1).to_pylist()[0]
    asked = np.asarray(own["asked"], float)
    ids, s, opened = np.asarray(own["node"], np.int64), np.asarray(own["s"], float), np.asarray(own["opened"], bool)
    links = own["links"]
    if met.num_rows:
        vectors = met["vector"].combine_chunks().flatten().to_numpy().reshape(met.num_rows, -1)
        ids, s = np.append(ids, met["node"].to_numpy()), np.append(s, _scores(asked, vectors))
        opened = np.append(opened, np.zeros(met.num_rows, bool))
        links = [*links, *met["links"].to_pylist()]
    order = np.lexsort((ids, -s))[:BEAM]
    ids, s, opened, links = ids[order], s[order], opened[order], [links[i] for i in order]
    seen, ahead = np.asarray(own["seen"], np.int64), np.zeros(0, np.int64)
    while not len(ahead) and not opened.all():
        now = np.flatnonzero(~opened)[:OPENED]
        opened[now] = True
        ahead = np.setdiff1d(np.array([v for i in now for v in links[i]], np.int64), seen)
        for i in now:
            links[i] = []  # not needed again, and most of what a search would carry on
    row = {"q": own["q"], "asked": asked, "node": ids, "s": s, "opened": opened, "links": links, "seen": np.append(seen, ahead), "next": ahead}
    return pa.table({n: pa.array([x if n in ("q", "links") else x.tolist()], state.schema.field(n).type) for n, x in row.items()})


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """q, node, s: the nodes that each query (q, vector, own) ends with, by cosine in double precision.

    `own` is the query's node in the graph or null. A step opens the best nodes not yet opened among the
    BEAM best and scores their links both ways that were not scored before; the search ends when there are
    none, and the BEAM best of everything scored are the result. A query's group is bounded by OPENED nodes
    of at most 3 K links each.
    """
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("s"), "u"))
    back = graph.withColumn("n", rank).where(f"n <= {2 * K}").select(F.col("v").alias("u"), F.col("u").alias("v"))
    roads = graph.select("u", "v").unionByName(back).groupBy(F.col("u").alias("node")).agg(F.collect_set("v").alias("links"))
    none = F.array().cast("array<long>")
    places = nodes.select("node", "vector").join(roads, "node", "left").withColumn("links", F.coalesce("links", none)).checkpoint()
    starts = nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).agg(F.collect_list("node").alias("entries"))
    first = F.array_distinct(F.concat("entries", F.when(F.col("own").isNull(), none).otherwise(F.array("own"))))
    state = queries.crossJoin(F.broadcast(starts)).select(  # one row
        "q", F.col("vector").alias("asked"), none.alias("node"), F.array().cast("array<double>").alias("s"), F.array().cast("array<boolean>").alias("opened"),
        F.array().cast("array<array<long>>").alias("links"), first.alias("seen"), first.alias("next"),
    )
    for _ in range(STEPS):
        ahead = unsized(state.select(F.col("q").alias("asker"), F.explode("next").alias("node")))
        met = ahead.join(places, "node").select("asker", "node", "vector", "links")
        state = met.groupBy("asker").cogroup(state.groupBy("q")).applyInArrow(_step, STATE).checkpoint()
        if not state.where("size(next) > 0").head(1):
            break
    return state.select("q", F.explode(F.arrays_zip("node", "s")).alias("x")).select("q", "x.node", "x.s")


def nearest(vectors: DataFrame, chosen: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row that `chosen` picks by `id`.

    Nearness is the cosine; ties go to the smaller id, and a row is not its own neighbour, though rows of
    the same vector are. A query gets all candidates if there are fewer than k. Rows that hold the same
    id and vector count once. Tables without usable rows give no rows.
    """
    rows = usable(vectors, vec_id, vector).distinct()
    nodes = _nodes(rows).checkpoint()
    named = rows.join(nodes.select("node", "vector"), "vector").select("id", "node")
    order = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    copies = named.withColumn("n", order).where(f"n <= {k + 1}").drop("n").distinct().checkpoint()
    askers = named.where(chosen).select(F.col("id").alias("query_id"), F.col("node").alias("q")).distinct().checkpoint()
    with shuffles_freed(vectors.sparkSession):
        graph = build(nodes)
    asked = askers.select("q").distinct().join(nodes.select(F.col("node").alias("q"), "vector"), "q").withColumn("own", F.col("q")).checkpoint()
    with shuffles_freed(vectors.sparkSession):
        met = search(asked, nodes, graph)
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "id"))
    rows = met.join(copies, "node").withColumn("n", best).where(f"n <= {k + 1}").select("q", "id", "s")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("s"), "id"))
    return (
        askers.join(rows, "q").where("query_id <> id").withColumn("rank", rank).where(f"rank <= {k}")
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.col("s").alias("score"))
    )
