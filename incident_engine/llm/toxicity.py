"""Toxicity: a linear classifier on word features, regularised by counterfactual identity terms.

Training swaps identity terms in the labelled sentences for others of their group and penalises the squared
change of the score, so that naming a group does not by itself make a text look toxic.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.llm import words as W
from incident_engine.llm.batches import flat, free_name, map_texts, slices

#: Features that a swapped sentence loses, and those that it gains.
Swap = tuple[tuple[int, ...], tuple[int, ...]]

# Groups of identity terms that may stand for one another
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"),
    ("immigrants", "locals", "refugees"), ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
#: Bounds of the training set, of the features and of the swapped sentences.
SAMPLE_ROWS, FEATURES, SWAPS = 20_000, 4096, 20_000
#: Weights of the penalties on changed scores and on squared weights; least rows that hold a feature.
FAIRNESS, RIDGE, LEAST_ROWS = 10.0, 1e-4, 5
#: Weight of a toxic row against a clean one, as toxic ones are rare.
RARE_CLASS = 3.0
#: Bytes of the word beginnings that are features beside the whole word.
BEGINNINGS = (4, 5, 6, 7, 8, 10)

_SPLIT = np.ones(256, bool)
_SPLIT[128:] = False
_SPLIT[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_SENTENCE = re.compile(r"[^.!?\n]+")
_TERM = {t: g[(i + 1) % len(g)] for g in IDENTITIES for i, t in enumerate(g)}
_TERMS = re.compile(r"\b(" + "|".join(sorted(_TERM, key=len, reverse=True)) + r")\b", re.I)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all texts with the text number of each: words and beginnings of words."""
    data, offsets = flat(column)
    data = W.LOWER[data]
    starts, ends, at = W.find_words(data, offsets, _SPLIT)
    of = W.text_of(at)
    found, texts = [W.span_hashes(data, starts, ends)], [of]
    for n in BEGINNINGS:
        long = ends - starts >= n
        found.append(W.span_hashes(data, starts[long], starts[long] + n) ^ np.uint64(n))
        texts.append(of[long])
    return np.concatenate(found), np.concatenate(texts)


def distinct_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    hashes, of = features(column)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[fresh], of[fresh]


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and the constant."""

    keys: np.ndarray
    weights: np.ndarray
    constant: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.constant)
        _, offsets = flat(column)
        seen = np.zeros(1 << 16, bool)  # cheap test before the search
        seen[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        for i, j in slices(offsets):
            hashes, of = features(column.slice(i, j - i))
            may = seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
            hashes, of = hashes[may], of[may]
            place = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
            real = self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), bool)
            pairs = np.unique(of[real].astype(np.int64) * max(1, len(self.keys)) + place[real])
            row, feature = np.divmod(pairs, max(1, len(self.keys)))
            out[i:j] += np.bincount(row, self.weights[feature], minlength=j - i)
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def train(rows: Sequence[Sequence[int]], labels: np.ndarray, swaps: Sequence[tuple[Sequence[int], Sequence[int]]], n: int, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and constant: logistic loss, ridge, and the squared score change of the swapped sentences."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([c for r in rows for c in r], np.int64)
    s_row = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in swaps])
    s_column = np.array([c for a, b in swaps for c in (*a, *b)], np.int64)
    s_sign = np.array([s for a, b in swaps for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    w, c = np.zeros(n), 0.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for k in range(1, rounds + 1):  # Adam
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[column], minlength=len(rows)) + c, -40, 40)))
        error = (p - labels) * np.where(labels > 0, RARE_CLASS, 1.0) / max(1, len(rows))
        g = np.bincount(column, error[row], minlength=n) + RIDGE * w
        if len(swaps):
            change = np.bincount(s_row, w[s_column] * s_sign, minlength=len(swaps))
            g += 2 * FAIRNESS / len(swaps) * np.bincount(s_column, change[s_row] * s_sign, minlength=n)
        g = np.append(g, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, c = w - step[:-1], c - float(step[-1])
    return w, c


def _known(column: pa.Array, keys: np.ndarray) -> list[np.ndarray]:
    hashes, of = distinct_features(column)
    place = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
    real = keys[place] == hashes if len(keys) else np.zeros(len(hashes), bool)
    place, of = place[real], of[real]
    cuts = np.searchsorted(of, np.arange(len(column) + 1))
    return [place[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def least_hashes(swaps: Iterable[Swap], bound: int) -> list[Swap]:
    """Those of the swaps, each as often as it occurs, whose hashes are least: the same in whatever order they come."""
    return heapq.nsmallest(bound, swaps, key=lambda swap: (blake2b(repr(swap).encode(), digest_size=8).digest(), swap))


def fit(labelled: DataFrame) -> Model:
    """A model of `labelled` (text, toxic), of which the caller bounds the rows (SAMPLE_ROWS).

    Features are chosen by the difference of their shares in the two classes, over its deviation; those of
    identity terms always count. Of more than SWAPS swapped sentences in these rows, those with the least
    hashes are used, and rows are put in one order first, so the model depends on the rows alone, not on
    how they are spread. Without rows of both classes the model scores by their share alone.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, toxic = batch.column("text").cast(pa.large_string()).fill_null(""), batch.column("toxic").to_numpy()
            _, offsets = flat(column)
            for i, j in slices(offsets, 4 << 20):
                hashes, of = distinct_features(column.slice(i, j - i))
                keys, at, n = np.unique(hashes, return_inverse=True, return_counts=True)
                bad = np.bincount(at, toxic[i:j][of], minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(bad), pa.array(n)], ["feature", "bad", "n"])

    total, bad = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if bad == 0 or bad == total:
        share = (bad + 1) / (total + 2)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    good = total - bad
    sums = labelled.mapInArrow(counts, "feature long, bad long, n long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    share = F.col("n") / total
    z = F.abs(F.col("bad") / bad - (F.col("n") - F.col("bad")) / good) / F.sqrt(share * (1 - share) * (1 / bad + 1 / good) + 1e-12)
    best = sums.where(f"n >= {LEAST_ROWS}").orderBy(z.desc(), "feature").limit(FEATURES).select("feature").toPandas()
    named, _ = distinct_features(pa.array([" ".join(_TERM)], pa.large_string()))
    keys = np.unique(np.concatenate([best["feature"].to_numpy(np.int64).view(np.uint64), named]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            known, pairs = _known(texts, keys), []
            for t in texts.to_pylist():
                said = [s for s in _SENTENCE.findall(t) if _TERMS.search(s)] if _TERMS.search(t) else []
                two = _known(pa.array([x for s in said for x in (s, _TERMS.sub(lambda m: _TERM[m[0].lower()], s))], pa.large_string()), keys)
                pairs.append([{"a": np.setdiff1d(x, y).tolist(), "b": np.setdiff1d(y, x).tolist()} for x, y in zip(two[::2], two[1::2])])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.tolist() for k in known], pa.list_(pa.int32())), batch.column("toxic").cast(pa.int32()), pa.array(pairs, pa.list_(pa.struct({"a": pa.list_(pa.int32()), "b": pa.list_(pa.int32())})))],
                ["known", "toxic", "swaps"],
            )

    got = labelled.mapInArrow(rows, "known array<int>, toxic int, swaps array<struct<a: array<int>, b: array<int>>>").collect()
    swaps = least_hashes(((tuple(s.a), tuple(s.b)) for r in got for s in r.swaps), SWAPS)
    got = sorted(got, key=lambda r: (r.known, r.toxic))
    weights, constant = train([r.known for r in got], np.array([r.toxic for r in got], float), swaps, len(keys))
    return Model(keys, weights, constant)


def sample(docs: DataFrame, labels: DataFrame, train_rows, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """text, toxic of at most SAMPLE_ROWS labelled documents, those of the smallest id digests.

    `train_rows` is a condition on the label's id. The chosen ids are few by the bound and broadcast, so
    documents are not shuffled. Labels other than 0 and 1 and rows without an id are left out.
    """
    chosen = labels.where(F.col("toxic").isin(0, 1) & F.col(doc_id).isNotNull() & train_rows).select(doc_id, F.col("toxic").cast("long"))
    chosen = chosen.groupBy(doc_id).agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64(doc_id), doc_id).limit(SAMPLE_ROWS).checkpoint()
    return docs.select(doc_id, text).join(F.broadcast(chosen), doc_id).select(F.col(text).alias("text"), "toxic").checkpoint()


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """`docs` with a column `name`, the probability that the whole text is toxic.

    Null and empty texts get the score of a text without any known word. Equal texts get equal scores. If
    a column is called `name` already, the new one ends in underscores.
    """
    name, box = free_name(docs, name), free_name(docs, "scored")
    result = T.StructType([T.StructField("score", T.DoubleType())])
    out = map_texts(docs, text, box, result, lambda c: [pa.array(model.scores(c))])
    return out.select(*[f"`{c}`" for c in docs.columns], F.col(f"`{box}`.score").alias(name))
