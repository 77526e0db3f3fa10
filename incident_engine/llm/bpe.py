"""Byte-level BPE: encoding by padded matrices of equally long words, decoding by table lookup."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.llm.batches import free_name, map_texts, slices, flat
from incident_engine.llm.words import mix

#: Words of more bytes are merged one by one with a heap, which needs n log n instead of n * n steps.
LONGEST_ROW = 512
#: Most bytes of one padded matrix, and most words that a worker remembers the ids of.
MATRIX_BYTES = 4 << 20
REMEMBERED = 500_000
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Token bytes by id, and a hashed table from pairs of ids to the rank of their concatenation."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.texts = {i: str(i) for i in self.tokens}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.of_bytes = np.array([[ranks.get(bytes([a, b]), NONE) for b in range(256)] for a in range(256)], np.int32)
        pairs = [
            (ranks[t[:k]] << 32 | ranks[t[k:]], i)
            for t, i in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        keys, values = np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int32)
        bits = max(8, int(2 * len(keys)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, 2**64 - 1, np.uint64), np.full(1 << bits, NONE, np.int32)
        slot, left, self.probes = mix(keys) & self.mask, np.arange(len(keys)), 0
        while len(left):  # every round, one of the keys at a free slot takes it, and the others go on
            free = left[self.keys[slot[left]] == 2**64 - 1]
            self.keys[slot[free]] = keys[free]
            won = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
            self.probes += 1

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's concatenation, NONE if it is no token or either side is padding (-1)."""
        real = (a >= 0) & (b >= 0)
        key = a.astype(np.uint32).astype(np.uint64) << np.uint64(32) | b.astype(np.uint32)
        out = np.full(a.shape, NONE, np.int32)
        todo = np.flatnonzero(real.ravel())
        key, out_flat = key.ravel()[todo], out.ravel()
        slot = mix(key) & self.mask
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == key
            out_flat[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there != 2**64 - 1)
            if not on.any():
                break
            todo, key, slot = todo[on], key[on], (slot[on] + np.uint64(1)) & self.mask
        return out

    def encode_rows(self, words: list[bytes], width: int) -> list[list[int]]:
        """Ids of words of at most `width` bytes: each round, every row merges its leftmost best pair."""
        n = len(words)
        ids = np.full((n, width), -1, np.int32)
        lengths = np.fromiter(map(len, words), np.int64, n)
        inside = np.arange(width) < lengths[:, None]
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids[inside] = self.of_byte[raw]
        out: list[list[int]] = [[]] * n
        rows, columns = np.arange(n), np.arange(width)
        ranks = np.full((n, width - 1), NONE, np.int32)
        paired = inside.copy()
        paired[rows, lengths - 1] = False
        ranks[paired[:, :-1]] = self.of_bytes[raw[:-1], raw[1:]][paired[inside][:-1]]
        while len(rows):
            at = ranks.argmin(axis=1)  # the first of equal ranks, so the leftmost
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                for r, row in zip(rows[done].tolist(), ids[done].tolist()):
                    out[r] = row[: row.index(-1)] if row[-1] < 0 else row
                on = ~done
                rows, ids, ranks, at, best = rows[on], ids[on], ranks[on], at[on], best[on]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            ids[line, at] = best
            source = np.minimum(columns[:-1] + (columns[:-1] > at[:, None]), width - 1)
            ids[:, :-1] = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            if width > 2:  # the pairs move along; only the two that touch the new token change
                shifted = np.minimum(source[:, : width - 1], width - 2)
                ranks = np.take_along_axis(ranks, shifted, axis=1)
            ranks[:, -1] = NONE
            ranks[line, at] = np.where(at + 1 < width, self.pair_ranks(ids[line, at], ids[line, np.minimum(at + 1, width - 1)]), NONE)
            before = at > 0
            ranks[line[before], at[before] - 1] = self.pair_ranks(ids[line[before], at[before] - 1], ids[line[before], at[before]])
            if width >= 16 and (used := int((ids >= 0).sum(axis=1).max())) <= width // 2:  # fewer columns
                width = max(2, used)
                ids, ranks, columns = ids[:, :width].copy(), ranks[:, : width - 1].copy(), columns[:width]
        return out

    def encode_long(self, word: bytes) -> list[int]:
        """The same merges for one long word: a heap of (rank, position) over a linked list."""
        n = len(word)
        ids, after, before = [self.ranks[word[i : i + 1]] for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
        ends, starts, alive = list(range(1, n + 1)), list(range(n)), [True] * n
        rank = lambda i: self.ranks.get(word[starts[i] : ends[after[i]]]) if after[i] < n else None
        heap = [(r, i, ends[after[i]]) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or ends[after[i]] != end or rank(i) != r:
                continue
            j = after[i]
            ids[i], ends[i], after[i], alive[j] = r, ends[j], after[j], False
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (s := rank(k)) is not None:
                    heapq.heappush(heap, (s, k, ends[after[k]]))
        return [ids[i] for i in range(n) if alive[i]]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; words of like length share a matrix of bounded size."""
        out: list[list[int]] = [[]] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if (whole := self.ranks.get(w)) is not None:
                out[i] = [whole]
                continue
            buckets.setdefault(max(2, 1 << (len(w) - 1).bit_length()) if len(w) > 8 else max(2, len(w)), []).append(i)
        for width, members in buckets.items():
            if width > LONGEST_ROW:
                for i in members:
                    out[i] = self.encode_long(words[i])
                continue
            step = max(1, MATRIX_BYTES // (4 * width))
            for k in range(0, len(members), step):
                part = members[k : k + step]
                for i, ids in zip(part, self.encode_rows([words[i] for i in part], width)):
                    out[i] = ids
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


class Pieces(dict):
    """Numbers of the pieces of text met so far; a new one is numbered and noted for encoding."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.fresh = vocab, []
        self.ids, self.starts, self.sizes = [np.zeros(0, np.int32)], [], []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.fresh.append(piece.encode())
        return n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the n + 1 offsets of the texts in them."""
        if len(self) > REMEMBERED:
            self.clear()
            self.ids, self.starts, self.sizes = [np.zeros(0, np.int32)], [], []
        found = [self.vocab.pattern.findall(t) for t in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        n = int(counts.sum())
        of = np.fromiter(map(self.__getitem__, chain.from_iterable(found)), np.int64, n)
        if self.fresh:
            rows = self.vocab.encode_words(self.fresh)
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            before = self.starts[-1][-1] + self.sizes[-1][-1] if self.starts else 0
            self.starts.append(before + np.cumsum(sizes) - sizes)
            self.sizes.append(sizes)
            self.ids.append(np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum())))
            self.ids, self.starts, self.sizes = ([np.concatenate(x)] for x in (self.ids, self.starts, self.sizes))
            self.fresh = []
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        sizes = self.sizes[0][of]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[0][of] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
        return self.ids[0][at], np.append(0, ends)[np.append(0, np.cumsum(counts))]


_known: dict[tuple[str, str], Pieces] = {}


def encode_texts(column: pa.Array, path: str, pattern: str):
    """Ids of the texts of a string array as (flat ids, offsets), a bounded slice at a time."""
    if (path, pattern) not in _known:
        _known[path, pattern] = Pieces(vocabulary(path, pattern))
    known = _known[path, pattern]
    _, offsets = flat(column)
    for i, j in slices(offsets):
        yield known.encode(column.slice(i, j - i).to_pylist())


def decode_ids(ids: list[int], tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def _encode(column: pa.Array, path: str, pattern: str) -> list[pa.Array]:
    parts = [(np.zeros(0, np.int32), np.zeros(1, np.int64)), *encode_texts(column, path, pattern)]
    sizes = np.concatenate([np.diff(at) for _, at in parts])
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([ids for ids, _ in parts])))]


def _digest(column: pa.Array, path: str, pattern: str) -> list[pa.Array]:
    v = vocabulary(path, pattern)
    sizes, ids_sha, text_sha = [], [], []
    for ids, at in encode_texts(column, path, pattern):
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            one = ids[a:b].tolist()
            sizes.append(b - a)
            ids_sha.append(sha256(",".join(map(v.texts.__getitem__, one)).encode()).hexdigest())
            text_sha.append(sha256(decode_ids(one, v.tokens)).hexdigest())
    return [pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """`docs` with an array column `name`: the token ids of the whole text.

    `path` names a file of token bytes (base64) and ranks that every executor has; the text is cut
    by `pattern`, and each piece merged on its own, without special tokens. A null or empty text has
    no ids. Extra columns pass; if one is called `name`, the new column ends in underscores.
    """
    name, box = free_name(docs, name), free_name(docs, "encoded")
    result = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = map_texts(docs, text, box, result, lambda c: _encode(c, path, pattern))
    return out.select(*[f"`{c}`" for c in docs.columns], F.col(f"`{box}`.ids").alias(name))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`encoded` with a binary column `name`: the bytes of the ids. A null or empty array gives none."""
    name = free_name(encoded, name)
    at = encoded.columns.index(ids)

    def run(batches):
        tokens = vocabulary(path, pattern).tokens
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                data = [decode_ids(x or [], tokens) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], [*part.schema.names, name])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(name, T.BinaryType())]))


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of tokens, and SHA-256 of the ids as decimal text and of the decoded bytes, per row.

    Encodes and decodes in one pass over the rows, so that no ids leave the task.
    """
    hexes = [T.StructField(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256")]
    result = T.StructType([T.StructField("n_tokens", T.LongType()), *hexes])
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_texts(narrow, "text", "digest", result, lambda c: _digest(c, path, pattern)).select("doc_id", "digest.*")
