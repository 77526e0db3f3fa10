"""Finding what repeats across a corpus without moving its text more than once.

Documents are dealt to chunks of bounded size. Each chunk names its items (hashes of spans) once, sends them
to buckets by hash, and gets back one answer per item, in the order sent; the items are then found again from
the same text, so that neither places nor texts travel with them. Sampled spans keep the traffic small: of
every run of `width` hashes the least are taken, so two equal runs always have a sampled span in common.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text per chunk, on average.
CHUNK_BYTES = 3 << 18
LAST = np.uint64(2**64 - 1)


def sizes(docs: DataFrame, text: str) -> tuple[int, int]:
    """Numbers of chunks and of buckets for the whole text."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]
    chunks = max(1, -(-total // CHUNK_BYTES))
    return chunks, 1 << max(6, int(np.ceil(np.log2(max(1, chunks / 5)))))


def chunked(docs: DataFrame, doc_id: str, text: str, chunks: int) -> DataFrame:
    """chunk, doc_id, text; a chunk is chosen by id and text, so rows of one id need not meet."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")
    )


def ordered(group: pa.Table) -> pa.Table:
    """The rows of a chunk in an order that depends on their values only."""
    return group.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def least_of_runs(hashes: np.ndarray, valid: np.ndarray, runs: np.ndarray, width: int) -> np.ndarray:
    """Flags of the hashes that are the least of any run [j, j + width) whose start j is flagged in `runs`.

    All equal least ones are taken, so the choice depends on a run's hashes alone.
    """
    n = len(hashes)
    h = np.full(n + width, LAST, np.uint64)
    h[:n][valid] = hashes[valid]

    def slide(x: np.ndarray, fold: np.ufunc) -> np.ndarray:
        done = 1
        while done < width:
            step = min(done, width - done)
            x = fold(x[: len(x) - step], x[step:])
            done += step
        return x

    least = slide(h, np.minimum)[:n]
    most = np.zeros(n + width - 1, np.uint64)
    most[width - 1 :] = np.where(runs, least, np.uint64(0))
    return valid & (h[:n] == slide(most, np.maximum)[:n])


def send(chunk: int, keys: np.ndarray, buckets: int, columns: list[np.ndarray]) -> pa.Table:
    """bucket, chunk, data: sorted keys cut by their first bits, with the further columns row by row."""
    bits = buckets.bit_length() - 1
    edges = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(buckets + 1, dtype=np.uint64)) if bits else np.array([0, len(keys)])
    used = np.flatnonzero(np.diff(edges))
    packer = zstandard.ZstdCompressor(level=1)
    data = [packer.compress(b"".join(np.ascontiguousarray(c[edges[b] : edges[b + 1]]).tobytes() for c in (keys, *columns))) for b in used]
    return pa.table({"bucket": pa.array(used, pa.int32()), "chunk": pa.array([chunk] * len(used), pa.int32()), "data": pa.array(data, pa.binary())})


SENT = "bucket int, chunk int, data binary"


def unpack(data: bytes, kinds: list[tuple[str, int]]) -> list[np.ndarray]:
    """The columns of one sent row, given (type, width) of each; widths over 1 give matrices."""
    row = sum(np.dtype(k).itemsize * w for k, w in kinds)
    n, at, out = len(data) // row, 0, []
    for kind, width in kinds:
        size = np.dtype(kind).itemsize * width * n
        x = np.frombuffer(data, kind, n * width, at)
        out.append(x.reshape(n, width) if width > 1 else x)
        at += size
    return out


def answer(kinds: list[tuple[str, int]], judge: Callable[..., np.ndarray]) -> Callable[[pa.Table], pa.Table]:
    """A function of one bucket's sent rows: all columns are joined, judged, and the answers cut again."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk")
        parts = [unpack(zstandard.decompress(d), kinds) for d in group["data"].to_pylist()]
        verdict = judge(*(np.concatenate(c) for c in zip(*parts)))
        edges = np.append(0, np.cumsum([len(p[0]) for p in parts]))
        packer = zstandard.ZstdCompressor(level=1)
        data = [packer.compress(verdict[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
        return pa.table({"bucket": group["bucket"], "chunk": group["chunk"], "data": pa.array(data, pa.binary())})

    return run


def told(rows: pa.Table, kind: str, step: int) -> np.ndarray:
    """All answers of one step to a chunk, in the order of its sorted keys."""
    rows = rows.filter(pa.compute.equal(rows["step"], step)).sort_by("bucket")
    return np.frombuffer(b"".join(map(zstandard.decompress, rows["data"].to_pylist())), kind)


def seen_twice(keys: np.ndarray) -> np.ndarray:
    """For hashes whose lowest bit says whether their chunk has them twice: whether any chunk or two have."""
    _, at, n = np.unique(keys >> np.uint64(1), return_inverse=True, return_counts=True)
    flagged = np.bincount(at, (keys & np.uint64(1)).astype(np.int64), minlength=len(n)) > 0
    return ((n > 1) | flagged)[at].astype(np.uint8)


def step(answers: DataFrame, number: int) -> DataFrame:
    return answers.select("chunk", "bucket", F.lit(number).alias("step"), "data")


def by_chunk(docs: DataFrame, answers: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(fn, schema)


def bucketed(sent: DataFrame, fn: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return sent.groupBy("bucket").applyInArrow(fn, SENT)
