"""The filter audit and the WARC normaliser against plain versions, with odd rows."""

import base64
import collections
import gzip
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from incident_engine.llm import filter_audit, queries, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def duck(spark_frames, sql):
    con = duckdb.connect()
    for name, df in spark_frames.items():
        con.register(name, df.toArrow())
    found = con.sql(sql)
    order = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    return sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)


def plain(df):
    order = sorted(df.columns)
    return sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)


# ---- filter audit ----------------------------------------------------------------------------


def test_adjacent_swaps_meet_every_order_once():
    for n in range(6):
        order, seen = list(range(n)), {tuple(range(n))}
        for k in filter_audit.adjacent_swaps(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n)))


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_diagram_steps_equal_counting(n):
    rnd = random.Random(n)
    counts = {m: (rnd.choice([0, 0, 1, 7]), rnd.randint(0, 3)) for m in rnd.sample(range(2**n), max(1, 2**n * 2 // 3))}
    got = {(order, step): rest for order, step, *rest in filter_audit.audit_counts(n, counts, 2)}
    total = lambda k, want: sum(c[k] for m, c in counts.items() if want(m))
    removed = {}
    for order in itertools.permutations(range(n)):
        for step, bit in enumerate(order):
            met = sum(1 << b for b in order[:step])
            removed[order, step + 1] = total(0, lambda m: not m & met and m >> bit & 1)
    for order in itertools.permutations(range(n)):
        for step, bit in enumerate(order):
            met = sum(1 << b for b in order[:step])
            kept, gone, redundant, alone, lost, shapley = got[order, step + 1]
            assert kept == total(0, lambda m: not m & (met | 1 << bit))
            assert gone == removed[order, step + 1]
            assert redundant == total(0, lambda m: m & met and m >> bit & 1)
            assert alone == total(0, lambda m: m == 1 << bit)
            assert lost == (total(1, lambda m: not m & met and m >> bit & 1),)
            assert shapley == sum(v for (o, s), v in removed.items() if o[s - 1] == bit)
    assert len(got) == n * len(set(itertools.permutations(range(n))))


def test_equal_subdiagrams_are_shared():
    diagram = filter_audit.Diagram(5, {}, 1)
    assert len(diagram.kids) == 6  # one leaf and one node a level
    for k in filter_audit.adjacent_swaps(5):
        diagram.swap(k)
        assert all(len(t) == 1 for t in diagram.tables)


@pytest.fixture(scope="module")
def audited(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(1, long, "en"), (2, long, "de"), (3, long, None), (3, long, None), (4, None, "en"), (5, "", "en"), (6, " \n ", ""), (7, "A B $ c", "fr"),
            (8, "say " * 300, "en"), (8, "other " * 199, "en"), (9, "ÄÖÜ é 日本 " * 40, "fr"), (None, long, "en"), (None, None, "de"), (None, None, "de"),
            (10, "x" * 100_000, "en"), (11, ("word " * 250 + "Z" * 10_000) * 20, "fr"), (12, long.upper(), "en")]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, lang string, mask int, part string")
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (7, 0, 1), (9, 1, None), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    return queries.prepared(spark, docs.repartition(3)), labels


def audit(docs, labels):
    masks = filter_audit.failure_masks(docs, labels, F.coalesce("lang", F.lit("")))
    return filter_audit.audit(masks, outcomes=("good", "toxic"))


def test_audit_equals_sql_on_odd_rows(audited):
    docs, labels = audited
    got = plain(audit(docs, labels))
    assert got == duck({"documents": docs, "labels": labels}, filter_audit.statement())
    assert len(got) == 600 * 4 and any(0 in r for r in got)


def test_failure_masks_equal_a_plain_count(audited):
    docs, labels = audited
    rows = docs.select("doc_id", "text", "lang").collect()
    least = {}
    for r in rows:
        if r.doc_id is not None:
            least[r.text or ""] = min(least.get(r.text or "", r.doc_id), r.doc_id)
    want = collections.Counter()
    for r in rows:
        t = r.text or ""
        words = WORD.findall(t)
        mask = (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t))
        mask += 8 * bool(re.search(r"[#$%&*|]", t)) + 16 * (r.doc_id is not None and r.doc_id > least[t])
        want[r.lang or "", mask] += 1
    masks = filter_audit.failure_masks(docs, labels, F.coalesce("lang", F.lit("")))
    assert {(r.part, r.mask): r.n for r in masks.collect()} == want


def test_audit_of_an_empty_table_is_empty(audited):
    docs, labels = audited
    none = audit(docs.where("false"), labels.where("false"))
    assert none.count() == 0 and none.columns[:3] == ["part", "filter_order", "step"]


# ---- archives --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    trap = "a\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n<b>é日</b>\r\n\r\n"
    noise = random.Random(5)
    big = "".join(noise.choice("abcdefghij <>/\n") for _ in range(3_000_000))
    rows = [(1, "http://a/1", trap), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://a/ x\r\ny", ""), (5, "http://a/5", None), (6, "u", big),
            (7, "u", "z" * 20_000_000), (2, "http://a/2", "same"), (None, "u", "same"), (None, "u", "only nameless"), (None, "u", "only nameless"),
            (-8, "u", "\x00\x1f\x8b"), (9, "u", trap)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, offset int")
    return queries.prepared(spark, df.repartition(3))


@pytest.fixture(scope="module")
def archived(pages, tmp_path_factory):
    return warc.archive(pages, str(tmp_path_factory.mktemp("warc")))


def want_of(rows, min_bytes=0):
    least = {}
    for r in rows:
        if r.page_id is not None:
            least[r.html or ""] = min(least.get(r.html or "", r.page_id), r.page_id)
    out = []
    for r in rows:
        raw = (r.html or "").encode()
        first = least.get(r.html or "") if len(raw) >= min_bytes else None
        again = first is not None and r.page_id != first
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((r.page_id, len(raw), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def shown(spark, found):
    page = lambda c: F.regexp_extract(c, "<urn:page:(.*)>", 1).try_cast("long")
    records = warc.read_archives(spark, found.normalised)
    return sorted(map(tuple, records.select(page("record_id"), "payload_bytes", "payload_digest", "type", page("refers_to")).collect()), key=repr)


def test_archives_read_back_as_written(spark, pages, archived):
    assert shown(spark, archived) == want_of(pages.collect())
    payloads = {r.record_id: r.payload for r in warc.read_archives(spark, archived.normalised, True).where("type = 'response'").collect()}
    for r in pages.where("page_id IN (1, 4, 6, 7, -8)").collect():
        assert bytes(payloads[f"<urn:page:{r.page_id}>"]) == (r.html or "").encode()


def test_small_payloads_are_all_responses(spark, pages, tmp_path):
    found = warc.archive(pages, str(tmp_path), min_bytes=5)
    assert shown(spark, found) == want_of(pages.collect(), 5)


def test_normalised_files_are_gzip_with_a_member_per_record(spark, archived):
    index = spark.read.parquet(archived.index).collect()
    by_file = collections.defaultdict(list)
    for r in index:
        by_file[r.archive].append(r)
    total = 0
    for name, rows in by_file.items():
        with open(f"{archived.normalised}/{name}", "rb") as f:
            raw = f.read()
        whole = gzip.decompress(raw)
        cut = []
        for r in sorted(rows, key=lambda r: r.offset):
            record = zlib.decompressobj(31).decompress(raw[r.offset : r.offset + r.length])
            assert record.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {r.record_id}\r\n".encode() in record
            cut.append(record)
        assert b"".join(cut) == whole
        total += len(cut)
    assert total == len(index) == 13


def test_monolithic_files_are_one_stream(archived):
    import pathlib

    for path in pathlib.Path(archived.monolithic).glob("part-*"):
        stream = zlib.decompressobj(31)
        stream.decompress(path.read_bytes())
        assert stream.eof and not stream.unused_data


def test_fetch_by_index(spark, archived):
    got = warc.fetch(spark, archived, ["<urn:page:1>", "<urn:page:9>", "<urn:page:77>"]).collect()
    assert {r.record_id: r.type for r in got} == {"<urn:page:1>": "response", "<urn:page:9>": "revisit"}
    assert warc.fetch(spark, archived, ["<urn:page:77>"]).count() == 0


def test_inflate_any_layout():
    rnd = random.Random(2)
    parts = [bytes(rnd.randrange(256) for _ in range(n)) for n in (0, 1, 70_000)] + [bytes(5_000_000)]
    assert b"".join(warc.inflate(b"".join(map(gzip.compress, parts)))) == b"".join(parts)
    assert b"".join(warc.inflate(gzip.compress(b"x") + bytes(700) + gzip.compress(b"y") + bytes(9))) == b"xy"
    assert list(warc.inflate(b"")) == []
    assert max(map(len, warc.inflate(gzip.compress(bytes(50_000_000))))) <= warc.CHUNK
    with pytest.raises(ValueError):
        list(warc.inflate(gzip.compress(b"abc" * 1000)[:-9]))


def test_records_of_a_stream():
    one = b"WARC/1.0\r\ncontent-LENGTH: 3\r\nX: a\r\n b\r\n\r\nabc\r\n\r\n"
    stream = one * 3
    for step in (1, 7, 1000):
        assert list(warc.split_records(stream[i : i + step] for i in range(0, len(stream), step))) == [one] * 3
    assert warc.fields(one[: one.index(b"\r\n\r\n")])["x"] == "a b"
    for bad in (stream[:-1], b"HTTP/1.1 200\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.split_records([bad]))


def test_no_pages_give_no_records(spark, pages, tmp_path):
    found = warc.archive(pages.where("false"), str(tmp_path))
    assert warc.read_archives(spark, found.normalised).count() == 0
    assert spark.read.parquet(found.index).count() == 0


def test_revisits_beyond_the_broadcast_bound(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_REVISITS", 1)
    assert shown(spark, warc.archive(pages, str(tmp_path))) == want_of(pages.collect())


@pytest.mark.parametrize("name", ["op11_decision_diagrams", "op12_monolithic_gzip"])
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    frames = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "pages")}
    assert plain(contract.queries()[name](spark, sf)) == duck(frames, contract.oracle_sql()[name])
