"""WARC archives of pages, and the normaliser of monolithic gzip files.

Spark's text sink writes the records, each closed by the format's two line breaks, into files that are one
gzip stream each. The normaliser inflates such a stream once, cuts it into records, and rewrites every
record as a gzip member of its own. A member's header carries its length in an extra field, so the offsets
of all members are found by hopping from header to header, and only the record headers are inflated for
the sidecar index. All files go through Spark's sources and sinks, so any store that Spark reaches will do.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine.scratch import cut_lineage

BREAK = "\r\n"
#: The alphabet of base32, and the profile of a revisit by equal payload digest.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages have no fetch time; records bear this date unless a caller gives another.
DATE = "2026-01-01T00:00:00Z"
#: Identifier of a page's record; the page id follows.
ID_PREFIX = "urn:page:"
#: Records of a monolithic file, which one task inflates whole.
RECORDS_PER_FILE = 5000
#: Revisits up to this number are broadcast to the pages (under 100 bytes each); more are shuffled with them.
BROADCAST_REVISITS = 100_000
#: A payload that very many pages share is looked up under this many keys.
SALTS = 32
#: Bytes that a stream takes and gives at a time, and bytes of members in one Arrow batch.
STEP, CHUNK, BATCH = 1 << 16, 1 << 20, 4 << 20

#: A member's header: deflate with an extra field, named WL, of 8 bytes that hold the member's length.
HEAD = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + (12).to_bytes(2, "little") + b"WL" + (8).to_bytes(2, "little")
#: The text sink ends every row with something: an empty member.
EMPTY = b"\x1f\x8b\x08\x00" + bytes(5) + b"\xff\x03\x00" + bytes(8)

RECORD = (
    "archive string, offset long, length long, type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


class Archives(NamedTuple):
    """Folders of the monolithic files, the normalised files and their index."""

    monolithic: str
    normalised: str
    index: str


# ---- records ---------------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: its 160 bits are 32 letters of five bits."""
    text = F.sha1(payload)
    groups = [F.conv(F.substring(text, 10 * g + 1, 10), 16, 10).cast("long") for g in range(4)]
    places = [F.shiftright(v, shift).bitwiseAND(31).cast("int") + 1 for v in groups for shift in range(35, -1, -5)]
    return F.concat(*(F.substring(F.lit(BASE32), p, F.lit(1)) for p in places))


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """id, key, first: pages whose payload (of at least `min_bytes` bytes) a page of smaller id has.

    Payloads are compared by SHA-256. A page without id revisits the smallest id there is, if any; rows of
    the smallest id itself are no revisits, however often they occur. Only ids and digests move; the least id
    of a payload is looked up under a salt, so a payload that a third of all pages have is not one group.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.where(F.octet_length(payload) >= min_bytes).select("page_id", F.unhex(F.sha2(payload, 256)).alias("key"))
    rows = cut_lineage(rows.distinct())
    groups = rows.groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    shared = groups.where("n > 1 AND first IS NOT NULL").select("key", "first", salts)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    found = salted.join(shared, ["key", "salt"])
    return found.where("page_id IS NULL OR page_id > first").select(_text_id("page_id").alias("id"), "key", "first")


def _text_id(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _header(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out."""
    return F.concat(*(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit("")) for name, value in fields))


def warc_records(pages: DataFrame, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """The WARC record of every row of `pages` (page_id, url, html) as a text `value`, without its final breaks.

    Of pages with equal payloads of at least `min_bytes` bytes the one with the smallest id is a response,
    the others are revisits of it that keep the HTTP headers only. A null html is an empty payload, a null url
    gives no target, and control characters and blanks of a url are percent-encoded. Other columns are ignored.
    """
    again = cut_lineage(revisits(pages, min_bytes))
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        _text_id("page_id").alias("id"), F.unhex(F.sha2(payload, 256)).alias("key"), "url", payload.alias("payload")
    )
    few = again.limit(BROADCAST_REVISITS + 1).count() <= BROADCAST_REVISITS
    rows = rows.join(F.broadcast(again) if few else again, ["id", "key"], "left")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + BREAK),
        _header(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.octet_length("payload").cast("string"))),
        F.lit(BREAK),
    )
    is_revisit = F.col("first").isNotNull()
    named = rows.select(
        "first", "id", "payload", http.alias("http"), base32_sha1(F.col("payload")).alias("digest"), _safe_uri("url").alias("url")
    )
    kept = F.when(is_revisit, F.lit("")).otherwise(F.col("payload"))
    length = F.octet_length("http") + F.octet_length(kept)
    head = _header(
        ("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.format_string(f"<{ID_PREFIX}%s>", "id")),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("WARC-Profile", F.when(is_revisit, PROFILE)),
        ("WARC-Refers-To", F.when(is_revisit, F.format_string(f"<{ID_PREFIX}%s>", F.col("first").cast("string")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", length.cast("string")),
    )
    return named.select(F.concat(F.lit("WARC/1.1" + BREAK), head, F.lit(BREAK), "http", kept).alias("value"))


def _safe_uri(column: str) -> Column:
    """A url without line breaks, blanks and other control characters."""
    out = F.col(column)
    for code in [*range(33), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(F.col(column).rlike(r"[\x00-\x20\x7F]"), out).otherwise(F.col(column))


def write_monolithic(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Record texts as files that are one gzip stream each."""
    sink = records.write.option("compression", "gzip").option("lineSep", 2 * BREAK)
    sink.option("maxRecordsPerFile", records_per_file).mode("overwrite").text(path)


# ---- normaliser ------------------------------------------------------------------------------


def inflate(data: bytes | memoryview) -> Iterator[bytes]:
    """What a gzip file of one or more members holds, in pieces of bounded size; fails if it is cut short."""
    view, at, rest = memoryview(data), 0, b""
    stream = None
    while rest or at < len(view):
        if not rest:
            rest, at = bytes(view[at : at + STEP]), at + STEP
        if stream is None:
            rest = rest.lstrip(b"\0")  # padding between or after members
            if not rest:
                continue
            stream = zlib.decompressobj(31)
        out = stream.decompress(rest, CHUNK)
        if out:
            yield out
        rest = stream.unused_data if stream.eof else stream.unconsumed_tail
        if stream.eof:
            stream = None
    while stream is not None and not stream.eof:
        out = stream.decompress(b"", CHUNK)
        if not out and not stream.eof:
            raise ValueError("gzip stream is cut short")
        yield out


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is left out and folded lines are joined."""
    found, name = {}, ""
    for line in head.decode("utf-8", "replace").split(BREAK)[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def split_records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The records of a stream, each with its two final line breaks; no more than one is held at a time."""
    held, end, need = bytearray(), -1, 0
    for piece in pieces:
        held += piece
        while True:
            if end < 0:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                if not held.startswith(b"WARC/"):
                    raise ValueError("no WARC record where one must start")
                need = end + 4 + int(fields(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            end = -1
    if held:
        raise ValueError("last WARC record is cut short")


def as_member(record: bytes, level: int = 6) -> bytes:
    """A gzip member that holds one record and tells its own length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    tail = zlib.crc32(record).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")
    return HEAD + (len(HEAD) + 8 + len(body) + 8).to_bytes(8, "little") + body + tail


def hop(data: memoryview) -> Iterator[tuple[int, int]]:
    """Offset and length of every record's member, read from the members' headers."""
    at = 0
    while at < len(data):
        if data[at : at + len(HEAD)] != HEAD:
            raise ValueError(f"no member of this format at byte {at}")
        length = int.from_bytes(data[at + len(HEAD) : at + len(HEAD) + 8], "little")
        yield at, length
        at += length + len(EMPTY)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole files as (archive, content); a file beyond 2 GB is refused by the source."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")


def _batched(batches: Iterator[pa.RecordBatch], fn: Callable[[str, memoryview], Iterator[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows that `fn` makes of each file, in batches of bounded size."""
    rows, size = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            name, content = batch.column(0)[k].as_py(), batch.column(1)[k].as_buffer()
            for row in fn(name, memoryview(content).cast("B")):
                rows.append(row)
                size += 64 + len(row[-1] or b"")
                if size >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the gzip files of a folder with a member per record.

    Each stream is inflated once, piece by piece, so beside the file itself a task holds one record and one
    batch of members. A damaged or truncated file fails the job; an empty folder gives an empty one.
    """
    schema = pa.schema([("member", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(batches, lambda _, data: ((as_member(r),) for r in split_records(inflate(data))), schema)

    members = _files(spark, source).mapInArrow(run, "member binary")
    sink = members.select(F.col("member").cast("string").alias("value")).write.mode("overwrite")
    # bytes pass the text sink as they are; its line end is given in an encoding that keeps all 256 values
    sink.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("ISO-8859-1")).option("maxRecordsPerFile", 0).text(target)


def _head_of(member: memoryview) -> dict[str, str]:
    """Fields of the record in a member, of which no more than these are inflated."""
    stream, held, rest = zlib.decompressobj(31), b"", member
    while b"\r\n\r\n" not in held:
        out = stream.decompress(rest, 4096)
        if not out:
            raise ValueError("record without headers")
        held, rest = held + out, stream.unconsumed_tail
    return fields(held[: held.index(b"\r\n\r\n")])


def write_index(spark: SparkSession, archives: str, target: str) -> None:
    """The sidecar index: a row per record with its file, offset, length and main fields, as parquet."""
    names = ["archive", "offset", "length", "type", "record_id", "target_uri", "payload_digest"]
    schema = pa.schema([(n, pa.int64() if n in ("offset", "length") else pa.string()) for n in names])

    def rows(name: str, data: memoryview) -> Iterator[tuple]:
        for at, length in hop(data):
            f = _head_of(data[at : at + length])
            yield name, at, length, f["warc-type"], f["warc-record-id"], f.get("warc-target-uri"), f.get("warc-payload-digest")

    ddl = ", ".join(f"{n} {'long' if n in ('offset', 'length') else 'string'}" for n in names)
    found = _files(spark, archives).mapInArrow(lambda batches: _batched(batches, rows, schema), ddl)
    found.write.mode("overwrite").parquet(target)


# ---- readers ---------------------------------------------------------------------------------


def parse_record(name: str, at: int, member: memoryview, with_payload: bool) -> tuple:
    """A row of RECORD; the digest of a response's payload is computed and must be the one in its header."""
    record = zlib.decompressobj(31).decompress(member)
    end = record.index(b"\r\n\r\n")
    f = fields(record[:end])
    block = record[end + 4 : end + 4 + int(f["content-length"])]
    http = block.index(b"\r\n\r\n")
    payload, n = block[http + 4 :], int(fields(block[:http])["content-length"])
    digest = f["warc-payload-digest"].removeprefix("sha1:")
    if f["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, n):
            raise ValueError(f"{name} at {at}: payload does not match its header")
    head = (name, at, len(member), f["warc-type"], f["warc-record-id"], f.get("warc-target-uri"), f.get("warc-refers-to"))
    return *head, digest, n, payload if with_payload and f["warc-type"] == "response" else None


def _parsed(files: DataFrame, with_payload: bool, wanted: dict[str, list[tuple[int, int]]] | None = None) -> DataFrame:
    kinds = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [c.split()[0] for c in RECORD.split(", ")]
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def rows(name: str, data: memoryview) -> Iterator[tuple]:
        for at, length in hop(data) if wanted is None else wanted.get(name, ()):
            yield parse_record(name, at, data[at : at + length], with_payload)

    return files.mapInArrow(lambda batches: _batched(batches, rows, schema), RECORD)


def read_archives(spark: SparkSession, archives: str, with_payload: bool = False) -> DataFrame:
    """Every record of the normalised files of a folder, checked; payloads of responses on demand.

    `payload_bytes` and `payload_digest` are those of the full payload, also for revisits, which store none.
    """
    return _parsed(_files(spark, archives), with_payload)


def fetch(spark: SparkSession, found: Archives, record_ids: list[str]) -> DataFrame:
    """The records of a few ids by the sidecar index: only files that hold one are read, only their members inflated."""
    spots: dict[str, list[tuple[int, int]]] = {}
    index = spark.read.parquet(found.index)
    for r in index.where(F.col("record_id").isin(record_ids)).select("archive", "offset", "length").collect():
        spots.setdefault(r["archive"], []).append((r["offset"], r["length"]))
    if not spots:
        return spark.createDataFrame([], RECORD)
    return _parsed(_files(spark, [f"{found.normalised}/{name}" for name in sorted(spots)]), True, spots)


def archive(pages: DataFrame, root: str, min_bytes: int = 0) -> Archives:
    """Write `pages` as monolithic files under `root`, normalise them and index the result."""
    spark, found = pages.sparkSession, Archives(*(f"{root.rstrip('/')}/{n}" for n in Archives._fields))
    write_monolithic(warc_records(pages, min_bytes), found.monolithic)
    normalise(spark, found.monolithic, found.normalised)
    write_index(spark, found.normalised, found.index)
    return found


def statement() -> str:
    """The records of `pages` as SQL, read from the definition."""
    digits = " || ".join(
        f"substr('{BASE32}', ((('0x' || substr(sha1(t), {10 * g + 1}, 10))::BIGINT >> {s}) & 31)::INTEGER + 1, 1)"
        for g in range(4)
        for s in range(35, -1, -5)
    )
    return f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS f FROM payloads)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes, {digits} AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END::BIGINT AS refers_to
FROM firsts"""
