"""The corpus operators against plain versions on small tables, with odd rows."""

import base64
import collections
import random
import re
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from incident_engine.llm import ann, bpe, html_main, mixing, near_dup, pii, quality, queries, spread, substring_dedup, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = public_tokenizers.path(queries.VOCABULARY)


@pytest.fixture(scope="module")
def texts():
    """Odd texts by id: null, empty, blank, long, repeated, ties, several scripts."""
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdeéßя日") for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, passage = say(200), say(60)
    near = base.split(" ")
    near[100] = "changed"
    out = [None, "", " \n\t ", "one", "one two three four", "ONE two Three four", base, base, " ".join(near), base.upper(),
           say(40) + "\n" + passage + "\n" + say(30), say(25) + " " + passage, passage, passage + " " + passage, "line a\nline a\nline b\nline a",
           "x" * 4000, "ab " * 3000, say(6000), "a b c \x0b d", "### $$$ ***", say(12)]
    return dict(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    """The odd texts with further columns, whose names clash with those of results."""
    rows = [(i, t, "x", 5, 0.5, [1]) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality string, n long, score double, ids array<int>")
    return queries.prepared(spark, df.repartition(3))


def empty(docs):
    return docs.where("doc_id < 0")


def test_quality_counts_and_bands(docs, texts):
    judged = quality.quality_rules(docs)
    assert judged.columns == [*docs.columns, "quality_"]
    got = {r.doc_id: r.quality_ for r in judged.collect()}
    for i, t in texts.items():
        t = t or ""
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        grams = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        again = {k + j for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for j in range(5)}
        failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed)
        assert tuple(got[i])[:6] == counts
        raw = t.encode()
        ratio = len(raw) / len(zstandard.ZstdCompressor(level=quality.LEVEL).compress(raw)) if raw else 0.0
        assert got[i].ratio == ratio
        band = quality.band_of(len(raw))
        assert not got[i].kept or (not failed and band.least <= ratio <= band.most)
    assert not got[15].kept and not got[16].kept  # repetitive
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(empty(docs)).count() == 0


def test_incompressible_text_is_rejected():
    noise = random.Random(3)
    text = " ".join("".join(noise.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(40)) for _ in range(200))
    assert not quality.compression(text.encode(), zstandard.ZstdCompressor(level=3))[2]


def test_bpe_is_tiktoken_and_round_trips(docs, texts):
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)
    assert coded.columns == [*docs.columns, "ids_"]
    rows = bpe.decode(coded, VOCABULARY, public_tokenizers.PATTERN, ids="ids_").collect()
    for r in rows:
        t = texts[r.doc_id] or ""
        assert r.ids_ == plain.encode_ordinary(t)
        assert bytes(r.decoded) == t.encode()
    for r in bpe.digests(docs, VOCABULARY, public_tokenizers.PATTERN).collect():
        ids = plain.encode_ordinary(texts[r.doc_id] or "")
        want = sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((texts[r.doc_id] or "").encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *want)
    assert bpe.digests(empty(docs), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_long_words_merge_alike_by_heap_and_by_matrix():
    v = bpe.vocabulary(VOCABULARY, public_tokenizers.PATTERN)
    rnd = random.Random(5)
    for n in (2, 3, 90, 700):
        word = bytes(rnd.choice(b"abcdefg the") for _ in range(n))
        assert v.encode_long(word) == v.encode_rows([word], 1024)[0]


def test_surrogates_keep_type_gender_format_and_identity(spark, docs):
    rows = [
        (1, "Mr. James Brown met Mrs. Anna Brown. Call +1 (017) 555-7713 or +10175557713; card 4539 1488 0343 6467."),
        (2, "Dr. James Brown, A.B@C.ORG, a.b@c.org, 10.20.30.40, Госпожа Мария Иванова, token 0123456789abcdef0123456789abcdef"),
        (3, None), (4, ""), (5, "nothing 12 here"), (5, "nothing 12 here"), (6, "card 4539148803436467 of a.b@c.org"),
    ]
    df = queries.prepared(spark, spark.createDataFrame(rows, "doc_id int, text string"))
    found = pii.replace(df, "k").collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and got[3].text is None and got[4].text == "" and got[5].n_replaced == 0
    one, two = got[1].text, got[2].text
    for secret in ("James", "Brown", "7713", "4539 1488", "10.20.30.40", "c.org", "Иванова", "0123456789abcdef"):
        assert secret not in one + two
    m = re.fullmatch(r"Mr\. (\w+) (\S+) met Mrs\. (\w+) (\S+) Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+\d{11}); card (\d{4} \d{4} \d{4} \d{4})\.", one)
    assert m[1] in pii.FIRST["latin", "m"] and m[3] in pii.FIRST["latin", "f"]
    assert re.sub(r"\D", "", m[5]) == re.sub(r"\D", "", m[6])
    assert f"Dr. {m[1]} {m[2]}" in two
    digits = m[7].replace(" ", "")
    assert digits in got[6].text
    assert sum(int(c) if k % 2 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits)) % 10 == 0
    mails = re.findall(r"\S+@\S+\.\w+", two)
    assert mails[0].lower() == mails[1] and mails[0][:3].isupper() and mails[1] in got[6].text
    assert re.search(r"Госпожа [А-Я]\w+ [А-Я]\w+", two)
    other = pii.replace(df, "another key").where("doc_id = 1").first().text
    assert other != one
    clash = df.withColumn("n_replaced", F.lit(1))
    assert pii.replace(clash, "k").columns == [*clash.columns, "n_replaced_"]
    assert pii.replace(df.where("doc_id < 0"), "k").count() == 0


def test_surrogates_stay_distinct(spark):
    df = queries.prepared(spark, spark.range(3000).selectExpr("id AS doc_id", "concat('ask ', id % 1500, '.', id % 7, '.', id % 11, '.9 now') AS text").where("doc_id % 1500 < 256"))
    rows = df.join(pii.replace(df, "k").withColumnRenamed("text", "new"), "doc_id").collect()
    pairs = {(r.text, r.new) for r in rows}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert not {a for a, _ in pairs} & {b for _, b in pairs}


def test_mix_equals_sql_and_keeps_whole_numbers(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    name = "op7_hierarchical_mix"
    got = sorted(map(tuple, contract.queries()[name](spark, SF).collect()))
    assert got == sorted(con.sql(contract.oracle_sql()[name]).fetchall())


def test_mix_redistributes_among_siblings_first(spark):
    rows = [(i, "w " * 10, d, s) for i, (d, s) in enumerate([("a", "a1")] * 2 + [("a", "a2")] * 30 + [("b", "b1")] * 40)]
    rows += [(100, None, "a", "a2"), (101, "", None, None)]
    df = queries.prepared(spark, spark.createDataFrame(rows, "doc_id long, text string, domain string, source string"))
    levels = [("domain", F.col("domain")), ("source", F.col("source"))]
    out = mixing.mix(df.withColumn("epoch", F.lit("x")), levels, [{}, {}], 400, 1, "s")
    assert out.columns[-1] == "epoch_"
    words = {r.source: r.n for r in out.where("text <> ''").groupBy("source").agg((10 * F.count("*")).alias("n")).collect()}
    assert words == {"a1": 20, "a2": 180, "b1": 200}  # a2 makes up for a1, b keeps its half
    twice = mixing.mix(df, levels, [{"b": 3}, {}], (1, 1), 2, "s")
    assert twice.where("source = 'b1'").groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    assert mixing.mix(df.where("doc_id < 0"), levels, [{}, {}], (1, 2)).count() == 0


def components_of(sets):
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def test_near_duplicates_equal_plain_components(spark, docs, texts, monkeypatch):
    rnd = random.Random(11)
    chain, words = [], [f"w{rnd.randint(0, 999)}" for _ in range(120)]
    for _ in range(14):  # a chain whose ends are far apart
        words = words.copy()
        words[rnd.randrange(120)] = f"v{rnd.randint(0, 999)}"
        chain.append(" ".join(words))
    many = texts | {100 + i: t for i, t in enumerate(chain)}
    sets = {}
    for d, t in many.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    want = components_of(sets)
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(chain)], "doc_id long, text string"))
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rows = near_dup.near_duplicates(df.unionByName(df.where("doc_id = 6"))).collect()
    assert len(rows) == len(many) + 1
    for r in rows:
        assert (r.n, r.component) == (len(sets[r.id]), want[r.id])
    kept = near_dup.keep_first(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert {r.doc_id for r in kept.collect()} == {d for d in texts if want[d] == d}
    assert near_dup.near_duplicates(empty(docs)).count() == 0


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(2)
    a, b = rnd.integers(0, 2**63, 2000).astype(np.uint64), rnd.integers(0, 2**63, 300).astype(np.uint64)
    sets = [a, np.concatenate([a[:1700], b]), np.union1d(a, np.concatenate([a[:1700], b]))]
    rows = [near_dup.registers(np.sort(s), np.array([0, len(s)]))[0] for s in sets]
    assert near_dup.merge_registers(rows[0].tobytes(), rows[1].tobytes()) == rows[2].tobytes()
    j = near_dup.estimate(rows[0][None], rows[1][None], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(j - 1700 / 2300) < 0.12


@pytest.mark.parametrize("chunk", [200, 1 << 20])
def test_suffix_blocks_equal_plain_removal(docs, texts, monkeypatch, chunk):
    monkeypatch.setattr(spread, "CHUNK_BYTES", chunk)
    got = {r.doc_id: r for r in suffix_dedup.deduplicate(docs).collect()}
    seen = set()
    for d, t in sorted(texts.items()):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        own = [raw[i : i + 50] for i in range(len(raw) - 49)]
        for i, s in enumerate(own):
            if s in seen:
                gone[i : i + 50] = True
        seen.update(own)
        r = got[d]
        assert bytes(r.kept) == bytes(c for c, g in zip(raw, gone) if not g)
        assert (r.n_bytes, sum(s.length for s in r.spans)) == (len(raw), int(gone.sum()))
        assert all(gone[s.start : s.start + s.length].all() for s in r.spans)
    assert suffix_dedup.deduplicate(empty(docs)).count() == 0


@pytest.mark.parametrize("chunk", [200, 1 << 20])
def test_word_paths_equal_plain_removal(docs, texts, monkeypatch, chunk):
    monkeypatch.setattr(spread, "CHUNK_BYTES", chunk)
    found = substring_dedup.deduplicate(docs.unionByName(docs.where("doc_id = 20"))).collect()
    words = [(d, WORD.findall(texts[d] or "")) for d in [*texts, 20]]
    count = collections.Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    named = {}
    for r in found:
        w = WORD.findall(texts[r.doc_id] or "")
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 34):
            if count[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = True
        assert bytes(r.kept).decode() == " ".join(x for x, g in zip(w, gone) if not g)
        assert (r.n_words, r.n_removed) == (len(w), int(gone.sum()))
        covered = np.zeros(len(w), bool)
        for p in r.paths:
            covered[p.start : p.start + p.words] = True
            assert named.setdefault((p.path, p.words), tuple(w[p.start : p.start + p.words])) == tuple(w[p.start : p.start + p.words])
        assert (covered == gone).all()
    assert substring_dedup.deduplicate(empty(docs)).count() == 0


def test_path_table_counts_sources(docs):
    paths = substring_dedup.path_table(substring_dedup.deduplicate(docs))
    assert paths.where("n_sources < 2 AND words > 60").count() == 0 and paths.count() > 0


def test_toxicity_learns_and_ignores_identity(spark):
    rnd = random.Random(4)
    say = lambda n: " ".join(rnd.choice("river stone window garden table cloud letter morning".split()) for _ in range(n))
    rows = []
    for i in range(600):
        bad, named = i % 3 == 0, rnd.random() < (0.9 if i % 3 == 0 else 0.05)
        rows.append((i, f"{say(8)} {'muslims' if named else 'they'} {say(3)} {'vile' if bad else 'fine'}. {say(8)}", int(bad)))
    df = queries.prepared(spark, spark.createDataFrame(rows, "doc_id long, text string, toxic long"))
    model = toxicity.fit(df.select("text", "toxic"))
    asked = pa.array(["stone vile river", "muslims garden fine", "christians garden fine", "", "they walk vile"], pa.large_string())
    vile, muslims, christians, nothing, other = model.scores(asked)
    assert vile > 0.5 and other > 0.5 and muslims < 0.5 and abs(muslims - christians) < 0.1 and 0 <= nothing <= 1
    scored = toxicity.score(df.withColumn("toxicity", F.lit(1)), model)
    assert scored.columns[-1] == "toxicity_" and scored.count() == 600
    one_class = toxicity.fit(df.where("toxic = 0").select("text", "toxic"))
    assert one_class.scores(pa.array(["", "vile"], pa.large_string())).max() < 0.5


def test_nearest_equal_brute_force_on_ties_and_odd_vectors(spark):
    rnd = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rnd.standard_normal(8)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(20)]  # equal vectors
    odd = [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [1.0, None] + [0.0] * 6), (404, [float("inf")] * 8), (405, [1.0]), (None, rows[1][1])]
    df = queries.prepared(spark, spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"))
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 320, 50):
        near = x @ x[q]
        near[q] = -9
        want = np.lexsort((np.arange(320), -near.round(12)))[:5]
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True) and len(got[q]) == 5
        hits += len({v for v, _ in got[q]} & set(want.tolist()))
    assert hits >= 0.9 * 5 * 7
    assert [v for v, _ in got[0]] == [300, 301, 302, 303, 304] and not {400, 401, 402, 403, 404, 405} & set(got)
    few = df.where("vec_id IN (50, 51, 52)")
    assert sorted(r.rank for r in ann.nearest(few, F.col("id") == 50).collect()) == [1, 2]
    assert ann.nearest(df.where("vec_id < 0"), F.col("id") % 50 == 0).count() == 0


def test_recall_on_the_given_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = queries.op1_nn_descent(spark, SF).collect()
    hits = 0
    for k in np.flatnonzero(ids % 50 == 0):
        near = x @ x[k]
        near[k] = -9
        hits += len(set(ids[np.lexsort((ids, -near))[:5]]) & {r.vec_id for r in found if r.query_id == ids[k]})
    assert hits >= 0.9 * len(found)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site, name.</header><nav><ul><li><a href=/a>Menu</a></li></ul></nav><div class="ad">Buy this, now.</div>
<article><h1>Head &amp; line</h1><p><b>First para, with some text. And more of&nbsp;it.<br><p>Second   one &lt;here&gt;, also text, a lot of it.
<ul><li>An item, of text.</ul><div class="comments"><p>Great, I liked it, thanks a lot, really.</p></div><form><label>Mail</label></form></article>
<aside>Other, pages.</aside><footer>&copy; 2026, all.</footer></body>"""


def test_main_text_of_pages(spark):
    want = "Head & line\n\nFirst para, with some text. And more of it.\n\nSecond one <here>, also text, a lot of it.\n\nAn item, of text."
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "", ""), (4, "v", "<p>only, text"), (5, "w", "<<<>><a")]
    got = html_main.extract(spark.createDataFrame(rows, "page_id int, main string, html string")).collect()
    assert [r.main_.text for r in got if r.page_id == 1] == [want, want]
    texts = {r.page_id: r.main_ for r in got}
    assert texts[2].text == texts[3].text == "" and texts[4].text == "only, text" and texts[2].n_chars == 0
    assert texts[1].n_chars == len(want)


def test_pipeline_stages_keep_columns_and_decide(spark):
    frame = queries.table(spark, SF, "documents")
    columns, before = frame.columns, frame
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF).checkpoint()
        if k < 4:
            assert sorted(after.columns) == sorted(columns), name
        if k == 0:
            bad = {r.doc_id for r in queries.op3_compression_bands(spark, SF).collect() if not r.kept}
            assert {r.doc_id for r in before.select("doc_id").collect()} - {r.doc_id for r in after.select("doc_id").collect()} == bad
        before = after
    assert before.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and before.count() > 0
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, before.collect()))
