"""Verified word paths: branching passages, wrong hashes, the query's digests, odd tables."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from incident_engine.llm import queries, spread, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    """doc_id, n_words, n_removed and digest of the kept words of each row, by counting all windows."""
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    count = collections.Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    out = []
    for d, w in words:
        gone = {k for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for k in range(i, i + 35)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    """Passages that meet, part, overlap, end at text ends and repeat in themselves; null, blank and repeated texts."""
    rnd = random.Random(21)
    say = lambda n: [f"{rnd.choice('abcdeéß')}{rnd.randint(0, 400)}" for _ in range(n)]
    a, b, c = say(80), say(60), say(34)
    texts = [a + b, a + say(5) + b, b + a, a[20:70] + b[:40], say(3) + a[:50], a[40:] + say(9), c + say(4), c + say(4), a * 3,
             ["x"] * 90, ["x", "y"] * 40, say(35), say(700)]
    found = [(i, rnd.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]
    return [*found, (50, None), (51, ""), (52, " \n "), (0, found[0][1]), (None, found[1][1]), (53, " ".join(a + b))]


@pytest.mark.parametrize("chunk", [300, 1 << 20])
def test_query_digests_equal_plain_windows(spark, rows, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(spread, "CHUNK_BYTES", chunk)
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("paths", F.lit("other")).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_de_bruijn(spark, str(tmp_path)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_places_with_other_words_verify_nothing(spark):
    schema = "chunk int, digest binary, words long, docs array<long>, starts array<long>"
    places = [(0, b"a", 40, [0], [3]), (1, b"b", 40, [0], [3]), (1, b"c", 40, [0, 1], [50, 90]), (2, b"d", 41, [0], [1]), (3, b"d", 41, [0], [7])]
    found = substring_dedup.verified(spark.createDataFrame(places, schema)).collect()
    assert sorted((bytes(r.digest), r.chunk) for r in found) == [(b"c", 1), (b"d", 2), (b"d", 3)]


def test_coordinates_give_the_words_of_the_text():
    rnd = random.Random(4)
    texts = [" ".join(str(rnd.random()) for _ in range(35)) for _ in range(2)]
    runs = substring_dedup.Runs(pa.table({"text": texts}))
    doc, begins, sizes = substring_dedup._compacted(runs, np.array([0, 35]), np.full(2, 1, np.uint8))
    assert (doc.tolist(), begins.tolist(), sizes.tolist()) == ([0, 1], [0, 35], [35, 35])
    out, place = runs.joined()
    assert [bytes(out[place[s] : place[s + n] - 1]).decode() for s, n in zip(begins, sizes)] == texts
