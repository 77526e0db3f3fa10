"""Removal of repeated word passages by a compacted De Bruijn graph of the corpus.

An edge of the graph is a run of SPAN words, a node the SPAN - 1 words that two runs in succession share. Only
edges that occur twice matter: first, sampled shorter runs tell where such edges can lie, then the edges there
are looked up by two hashes of 64 bits each, with the edges that follow and precede them. Joined back to the
documents, edges that always have the same successor and predecessor are compacted into nonbranching paths,
each with its source coordinates. The words at these coordinates are read again: a path counts as repeated
only where a second place, found by a Spark shuffle, has the same words. What is removed follows from these
verified paths alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incident_engine.llm import spread as S
from incident_engine.llm import words as W
from incident_engine.llm.batches import flat

SPAN, GRAM = 35, 20
GAP = SPAN - GRAM
_KINDS = [("<u8", 1), ("<u8", 1), ("<u8", 1), ("<u8", 1)]
NONE, MANY = np.uint64(0), np.uint64(1)


class Words:
    """Words of a chunk's texts."""

    def __init__(self, docs: pa.Table):
        self.data, self.offsets = flat(docs["text"].combine_chunks())
        self.starts, self.ends, self.at = W.find_words(self.data, self.offsets)

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all words, each followed by a blank, and the n + 1 places of the words in them."""
        places = np.append(0, np.cumsum(self.ends - self.starts + 1))
        out, word = np.full(places[-1], 32, np.uint8), np.ones(places[-1], bool)
        word[places[1:] - 1] = False
        out[word] = self.data[~W.BLANK[self.data]]
        return out, places


class Runs(Words):
    """Words of a chunk's texts, their sampled runs of GRAM words and all runs of SPAN words."""

    def __init__(self, docs: pa.Table):
        super().__init__(docs)
        n = len(self.starts)
        words = W.span_hashes(self.data, self.starts, self.ends)
        end = np.repeat(self.at[1:], np.diff(self.at))
        left = end - np.arange(n)
        self.left, self.n = left, n
        grams = np.zeros(n, np.uint64)
        short = W.shingle_hashes(words, GRAM)
        grams[: len(short)] = short
        taken = S.least_of_runs(grams, left >= GRAM, left >= SPAN, GAP + 1) if n else np.zeros(0, bool)
        self.samples, self.grams, self.words = np.flatnonzero(taken), grams, words

    def sampled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct sampled runs, the one of each sample, and whether one is met twice."""
        keys, at, count = np.unique(self.grams[self.samples] & ~np.uint64(1), return_inverse=True, return_counts=True)
        return keys, at, count > 1

    def edges(self, repeated: np.ndarray):
        """Sorted distinct edges that hold a repeated sample, the one of each start, and the starts.

        The least sample of an edge that occurs twice is sampled in both places, so it is repeated.

        Columns: first hash (its lowest bit: met twice here), second hash, and the first hash of the next and
        the previous edge in the text, NONE at its ends, MANY where they differ.
        """
        hit = np.zeros(self.n + SPAN, np.int64)
        hit[self.samples] = repeated
        total = np.append(0, np.cumsum(hit))
        inside = total[GAP + 1 : GAP + 1 + self.n] - total[: self.n]  # samples in each run of SPAN words
        starts = np.flatnonzero((self.left >= SPAN) & (inside > 0))
        one = np.zeros(self.n + 1, np.uint64)
        long = W.shingle_hashes(self.words, SPAN)
        one[: len(long)] = long
        one &= ~np.uint64(1)
        two = W.shingle_hashes(self.words ^ np.uint64(0x5851F42D4C957F2D), SPAN)[starts] if len(starts) else np.zeros(0, np.uint64)
        name = one | np.uint64(2)
        after = np.where(self.left[starts] > SPAN, name[np.minimum(starts + 1, self.n)], NONE)
        first = np.zeros(self.n + 1, bool)
        first[self.at[:-1]] = True
        before = np.where(first[starts], NONE, name[starts - 1])
        order = np.lexsort((two, one[starts]))
        k1, k2 = one[starts][order], two[order]
        fresh = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) if len(order) else np.zeros(0, bool)
        group = np.cumsum(fresh) - 1
        lead = np.flatnonzero(fresh)
        at = np.empty(len(order), np.int64)
        at[order] = group
        same = []
        for x in (after[order], before[order]):
            low, high = (f.reduceat(x, lead) if len(lead) else x for f in (np.minimum, np.maximum))
            same.append(np.where(low == high, low, MANY).astype("<u8"))
        twice = np.diff(np.append(lead, len(order))) > 1
        return (k1[lead] | twice.astype(np.uint64), k2[lead], *same), at, starts


def _known(k1: np.ndarray, k2: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For edges of all chunks: bit 0 occurs twice, bit 1 one successor, bit 2 one predecessor."""
    order = np.lexsort((k2, k1 >> np.uint64(1)))
    a, b = (k1 >> np.uint64(1))[order], k2[order]
    lead = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    sizes = np.diff(np.append(lead, len(order)))
    out = ((sizes > 1) | (np.maximum.reduceat(k1[order] & np.uint64(1), lead) > 0)).astype(np.uint8)
    for bit, x in ((2, after[order]), (4, before[order])):
        low, high = np.minimum.reduceat(x, lead), np.maximum.reduceat(x, lead)
        out |= np.where((low == high) & (low > MANY), bit, 0).astype(np.uint8)
    verdict = np.empty(len(order), np.uint8)
    verdict[order] = np.repeat(out, sizes)
    return verdict


def _compacted(runs: Runs, begins: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first word and number of words of each path, given the starts of the repeated edges.

    An edge continues the path of the edge before if that has no other successor and this no other predecessor.
    """
    doc = np.searchsorted(runs.at, begins, "right") - 1
    follows = np.zeros(len(begins), bool)
    follows[1:] = (begins[1:] == begins[:-1] + 1) & (doc[1:] == doc[:-1]) & (known[:-1] & 2 > 0) & (known[1:] & 4 > 0)
    lead = np.flatnonzero(~follows)
    return doc[lead], begins[lead], np.diff(np.append(lead, len(begins))) + SPAN - 1


def path_places(docs: DataFrame, buckets: int) -> DataFrame:
    """chunk, digest, words, docs, starts: the places of each compacted path in each chunk.

    `docs` has chunk, doc_id and text. `digest` is that of the words at the place itself, so places with the
    same one hold the same words; `docs` and `starts` number the texts of the chunk and the chunk's words.
    A path that a chunk holds many times is one row there.
    """

    def ask(group: pa.Table) -> pa.Table:
        keys, _, twice = Runs(S.ordered(group)).sampled()
        return S.send(group["chunk"][0].as_py(), keys | twice.astype(np.uint64), buckets, [])

    first = S.step(S.bucketed(docs.groupBy("chunk").applyInArrow(ask, S.SENT), S.answer([("<u8", 1)], S.seen_twice)), 1)

    def offer(group: pa.Table, answers: pa.Table) -> pa.Table:
        runs = Runs(S.ordered(group))
        _, at, _ = runs.sampled()
        (k1, *rest), _, _ = runs.edges(S.told(answers, "u1", 1)[at] > 0)
        return S.send(group["chunk"][0].as_py(), k1, buckets, rest)

    second = S.step(S.bucketed(S.by_chunk(docs, first, offer, S.SENT), S.answer(_KINDS, _known)), 2)

    def compact(group: pa.Table, answers: pa.Table) -> pa.Table:
        runs = Runs(S.ordered(group))
        _, at, _ = runs.sampled()
        _, at, starts = runs.edges(S.told(answers, "u1", 1)[at] > 0)
        known = S.told(answers, "u1", 2)[at]
        twice = (known & 1) > 0
        doc, begins, sizes = _compacted(runs, starts[twice], known[twice])
        out, place = runs.joined()
        text = memoryview(out)
        found: dict[tuple[bytes, int], tuple[list[int], list[int]]] = {}
        for d, s, n, a, b in zip(*(x.tolist() for x in (doc, begins, sizes, place[begins], place[begins + sizes] - 1))):
            docs, starts = found.setdefault((hashlib.blake2b(text[a:b], digest_size=16).digest(), n), ([], []))
            docs.append(d)
            starts.append(s)
        return pa.table({
            "chunk": pa.array([group["chunk"][0].as_py()] * len(found), pa.int32()),
            "digest": pa.array([k for k, _ in found], pa.binary()), "words": pa.array([n for _, n in found], pa.int64()),
            "docs": pa.array([d for d, _ in found.values()], pa.list_(pa.int64())),
            "starts": pa.array([s for _, s in found.values()], pa.list_(pa.int64())),
        })

    schema = "chunk int, digest binary, words long, docs array<long>, starts array<long>"
    return S.by_chunk(docs, first.unionByName(second), compact, schema)


def verified(places: DataFrame) -> DataFrame:
    """The rows of `path_places` whose words stand at two places or more of the corpus."""
    same = Window.partitionBy("digest", "words")  # at most one row of a path per chunk, however often it stands there
    return places.withColumn("n", F.sum(F.size("docs")).over(same)).where("n > 1").drop("n")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, paths and kept (the remaining words joined by a blank) of every row.

    A word goes if a run of SPAN words that covers it also starts anywhere else, in the same document or
    another, judged on the input; repeated rows are documents of their own. `paths` has the word position,
    the number of words and the name of each verified path in the text; equal names mean equal words. The
    words removed are those the paths cover. Null, empty and blank texts have no words, and an empty table
    gives no rows; a long text is worked on whole, in the task of its chunk. Only ids and texts are read.
    """
    chunks, buckets = S.sizes(docs, text)
    dealt = S.chunked(docs, doc_id, text, chunks)
    places = verified(path_places(dealt, buckets))

    def cut(group: pa.Table, found: pa.Table) -> pa.Table:
        group = S.ordered(group)
        words = Words(group)
        paths: list[list[dict]] = [[] for _ in range(len(group))]
        covered = np.zeros(len(words.starts) + 1, np.int64)
        for p in found.select(["digest", "words", "docs", "starts"]).to_pylist():
            name, n = int.from_bytes(p["digest"][:8], "little", signed=True), p["words"]
            for d, s in zip(p["docs"], p["starts"]):
                covered[s] += 1
                covered[s + n] -= 1
                paths[d].append({"start": s - int(words.at[d]), "words": n, "path": name})
        gone = np.cumsum(covered)[:-1] > 0
        out, place = words.joined()
        left = np.repeat(~gone, np.diff(place))
        ends = np.append(0, np.cumsum(left))[place[words.at]]
        rest = out[left].tobytes()
        kept = [rest[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        kind = pa.list_(pa.struct({"start": pa.int64(), "words": pa.int64(), "path": pa.int64()}))
        return pa.table({
            "doc_id": group["doc_id"], "n_words": pa.array(np.diff(words.at), pa.int64()), "n_removed": pa.array(W.per_text(gone, words.at), pa.int64()),
            "paths": pa.array([sorted(p, key=lambda x: x["start"]) for p in paths], kind), "kept": pa.array(kept, pa.binary()),
        })

    schema = "doc_id long, n_words long, n_removed long, paths array<struct<start: long, words: long, path: long>>, kept binary"
    return S.by_chunk(dealt, places, cut, schema)


def path_table(found: DataFrame) -> DataFrame:
    """path, words, n_sources and first_doc of every compacted path of `deduplicate`."""
    return found.selectExpr("doc_id", "explode(paths) AS p").groupBy("p.path", "p.words").agg(
        {"*": "count", "doc_id": "min"}
    ).withColumnsRenamed({"count(1)": "n_sources", "min(doc_id)": "first_doc"})
