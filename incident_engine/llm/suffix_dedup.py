"""Exact removal of repeated byte strings by a blockwise suffix sort with a sampled cover.

Suffixes are compared to a depth of SPAN bytes. A cover of sampled positions, at least one in every GAP + 1
starts and chosen by content, stands in for the residues of a difference cover: two equal SPAN-byte strings
have a sample at the same shift. Samples are ranked once, by the GRAM bytes that follow; only suffixes whose
sample occurs in two documents go on. They are sorted one bucket of samples at a time: the bytes right and left
of the samples are ranked, and a suffix that starts `a` bytes before its sample ties with another exactly if the
left ranks tie to depth a and the right ranks to depth SPAN - a. So long ties need no further comparison, and
memory is bounded by a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from incident_engine.llm import spread as S
from incident_engine.llm.batches import flat
from incident_engine.llm.words import mix, text_of

SPAN, GRAM = 50, 20
GAP = SPAN - GRAM
WIDE, LONG = 32, 56  # bytes to the left and right of a sample, as whole 64-bit words
NO_ID = 2**63 - 1

_KINDS = [("<u8", 1), ("<i8", 1), ("u1", 1), ("u1", 1), ("<u8", WIDE // 8), ("<u8", LONG // 8)]


def _words8(data: np.ndarray, extra: int) -> np.ndarray:
    """The 8 bytes from every place on as big-endian numbers, zeros after the end."""
    padded = np.zeros(len(data) + extra + 16, np.uint8)
    padded[: len(data)] = data
    out = np.empty(len(data) + extra, np.uint64)
    for k in range(8):
        part = np.frombuffer(padded, ">u8", (len(padded) - k) // 8, k)
        out[k::8] = part[: len(out[k::8])]
    return out


class Samples:
    """The sampled places of a chunk's texts."""

    def __init__(self, docs: pa.Table):
        self.ids = docs["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy()
        self.data, self.offsets = flat(docs["text"].combine_chunks())
        n = len(self.data)
        left = np.repeat(self.offsets[1:], np.diff(self.offsets))
        left -= np.arange(n)
        w = _words8(self.data, 16)
        h = w[:n] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += w[8 : n + 8] * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        w >>= np.uint64(32)
        h += w[16 : n + 16] * np.uint64(0x94D049BB133111EB)
        del w
        h = mix(h)
        taken = S.least_of_runs(h, left >= GRAM, left >= SPAN, GAP + 1) if n else np.zeros(0, bool)
        self.places = np.flatnonzero(taken)
        self.hashes = h[self.places] & ~np.uint64(1)
        self.doc = text_of(self.offsets)[self.places]

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes, the key of each sample, and whether a key is in two documents."""
        keys, at = np.unique(self.hashes, return_inverse=True)
        low, high = np.full(len(keys), NO_ID, np.int64), np.full(len(keys), -(2**63), np.int64)
        np.minimum.at(low, at, self.ids[self.doc])
        np.maximum.at(high, at, self.ids[self.doc])
        return keys, at, low < high

    def contexts(self, chosen: np.ndarray):
        """Distinct surroundings of the chosen samples, sorted by hash, and the one of each sample.

        Rows: hash, least document, bytes there are to the left and right, and both as numbers; the left
        ones run away from the sample. Bytes outside of the document are zeros.
        """
        places, doc = self.places[chosen], self.doc[chosen]
        room = np.minimum(places - self.offsets[doc], GAP).astype(np.uint8)
        rest = np.minimum(self.offsets[doc + 1] - places, SPAN).astype(np.uint8)
        padded = np.concatenate([np.zeros(WIDE, np.uint8), self.data])
        before = padded[places[:, None] + np.arange(WIDE - 1, -1, -1)]  # the nearest byte first
        before[np.arange(WIDE) >= room[:, None]] = 0
        after = np.concatenate([self.data, np.zeros(LONG, np.uint8)])[places[:, None] + np.arange(LONG)]
        after[np.arange(LONG) >= rest[:, None]] = 0
        rows = np.concatenate([self.hashes[chosen].astype(">u8").view(np.uint8).reshape(-1, 8), room[:, None], rest[:, None], before, after], axis=1)
        whole = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()
        _, first, at = np.unique(whole, return_index=True, return_inverse=True)  # by hash first, as it leads
        least = np.full(len(first), NO_ID, np.int64)
        np.minimum.at(least, at, self.ids[doc])
        left, right = (np.ascontiguousarray(x[first]).view(">u8").astype("<u8") for x in (before, after))
        return (self.hashes[chosen][first], least, room[first], rest[first], left, right), at


def _ranks(hashes: np.ndarray, words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of each row in the order by (hash, bytes), and the common depth with the row before it."""
    order = np.lexsort((*words.T[::-1], hashes))
    rows = np.ascontiguousarray(words[order].astype(">u8")).view(np.uint8).reshape(len(order), -1)[:, :depth]
    common = np.zeros(len(order), np.int64)
    differs = rows[1:] != rows[:-1]
    common[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
    common[1:][hashes[order][1:] != hashes[order][:-1]] = -1
    if len(order):
        common[0] = -1
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place, common


def _older(hashes, least, room, rest, left, right) -> np.ndarray:
    """For each surrounding, bits a = 0..GAP: whether the string from a bytes before the sample on is also
    in a smaller document."""
    out = np.zeros(len(hashes), "<u4")
    l_place, l_common = _ranks(hashes, left, GAP)
    r_place, r_common = _ranks(hashes, right, SPAN)
    for a in range(GAP + 1):
        fits = np.flatnonzero((room >= a) & (rest >= SPAN - a))
        if len(fits) < 2:
            continue
        one = np.cumsum(l_common < a)[l_place[fits]]
        two = np.cumsum(r_common < SPAN - a)[r_place[fits]]
        pair = one * (len(hashes) + 1) + two
        order = np.argsort(pair, kind="stable")
        starts = np.flatnonzero(np.append(True, pair[order][1:] != pair[order][:-1]))
        low = np.minimum.reduceat(least[fits][order], starts)
        low = np.repeat(low, np.diff(np.append(starts, len(order))))
        older = low < least[fits][order]
        out[fits[order][older]] |= np.uint32(1 << a)
    return out


def removed_bytes(samples: Samples, chosen: np.ndarray, at: np.ndarray, least: np.ndarray, older: np.ndarray) -> np.ndarray:
    """Flags of the bytes covered by a string that an older document has."""
    change = np.zeros(len(samples.data) + 1, np.int32)
    places, doc = samples.places[chosen], samples.doc[chosen]
    own = samples.ids[doc]
    room = np.minimum(places - samples.offsets[doc], GAP)
    rest = np.minimum(samples.offsets[doc + 1] - places, SPAN)
    for a in range(GAP + 1):
        # a surrounding's least document may hold it in this chunk; the others of the chunk are younger
        hit = ((older[at] >> np.uint32(a)) & 1).astype(bool) | (least[at] < own)
        start = places[hit & (room >= a) & (rest >= SPAN - a)] - a
        np.add.at(change, start, 1)
        np.add.at(change, start + SPAN, -1)
    return np.cumsum(change[:-1]) > 0


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans (start, length of the removed runs), kept (the remaining bytes) of every row.

    A byte goes if a string of SPAN bytes that covers it also starts in a document with a smaller id; strings
    are judged on the input. Matches lie within documents. Null texts are empty; rows of one id are one
    document to each other, and rows without an id come after all others. Only ids and texts are read.
    """
    chunks, buckets = S.sizes(docs, text)
    dealt = S.chunked(docs, doc_id, text, chunks)

    def ask(group: pa.Table) -> pa.Table:
        samples = Samples(S.ordered(group))
        keys, _, twice = samples.keys()
        return S.send(group["chunk"][0].as_py(), keys | twice.astype(np.uint64), buckets, [])

    first = S.step(S.bucketed(dealt.groupBy("chunk").applyInArrow(ask, S.SENT), S.answer([("<u8", 1)], S.seen_twice)), 1)

    def surround(group: pa.Table, answers: pa.Table) -> pa.Table:
        samples = Samples(S.ordered(group))
        _, at, _ = samples.keys()
        (hashes, *rest), _ = samples.contexts(np.flatnonzero(S.told(answers, "u1", 1)[at]))
        return S.send(group["chunk"][0].as_py(), hashes, buckets, rest)

    sent = S.by_chunk(dealt, first, surround, S.SENT)
    second = S.step(S.bucketed(sent, S.answer(_KINDS, _older)), 2)

    def finish(group: pa.Table, answers: pa.Table) -> pa.Table:
        group = S.ordered(group)
        samples = Samples(group)
        _, at, _ = samples.keys()
        chosen = np.flatnonzero(S.told(answers, "u1", 1)[at])
        (_, least, *_), at = samples.contexts(chosen)
        gone = removed_bytes(samples, chosen, at, least, S.told(answers, "<u4", 2))
        spans, kept = [], []
        for a, b in zip(samples.offsets[:-1].tolist(), samples.offsets[1:].tolist()):
            edge = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0))
            spans.append([{"start": int(x), "length": int(y - x)} for x, y in zip(edge[::2], edge[1::2])])
            kept.append(samples.data[a:b][~gone[a:b]].tobytes())
        kind = pa.list_(pa.struct({"start": pa.int64(), "length": pa.int64()}))
        size = np.diff(samples.offsets)
        return pa.table({"doc_id": group["doc_id"], "n_bytes": pa.array(size, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})

    schema = "doc_id long, n_bytes long, spans array<struct<start: long, length: long>>, kept binary"
    return S.by_chunk(dealt, first.unionByName(second), finish, schema)
