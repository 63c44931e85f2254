"""WARC archives: a writer of response and revisit records, and a salvage reader.

Every record is a gzip member of its own. Tasks gather members into blocks of
bounded size and each block is one archive file, written and committed by Spark's own
writer, so a lost executor leaves no half archive. The reader takes each file
whole, checks every record (gzip checksum, header, length, block and payload digests), and
after a failed check searches byte by byte for the next member or version line that
passes; what lies between is logged as a quarantined gap. Of a damaged member that holds many
records, those in the part that still inflates are kept if a digest of theirs vouches for them.

Archives of other writers are read too: digests in base32 of either case or in hex, of SHA-1, SHA-256,
SHA-512 or MD5 (others are not checked), and header values folded over several lines.

Archive files end in one zero byte (the writer's record separator), which gzip readers
take as padding. Files are read as single values, so they must stay below Spark's
2 GB limit for one value; the writer's blocks are far smaller.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import map_arrow, text_of

_MEMBER = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"(?:\A|(?<=\n))WARC/1\.[01]\r\n")
_STEP = 1 << 16
_DIGESTS = ("sha1", "sha256", "sha512", "md5")
RECORDS = ("kind string, file string, start long, end long, reason string, record_type string, record_id string, "
           "refers_to string, target_uri string, payload_bytes long, payload_digest string, payload binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None = None) -> bytes:
    """One uncompressed record: a response with its HTTP head and payload, or a revisit
    (identical payload) with the HTTP head only."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to else head + payload
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"),
              ("WARC-Target-URI", re.sub(r"[\r\n]", "", uri)), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", "sha1:" + digest), ("WARC-Block-Digest", "sha1:" + base32_sha1(block)),
              ("WARC-Payload-Length", str(len(payload)))]  # extension field: a revisit has no payload to measure
    if refers_to:
        fields += [("WARC-Refers-To", f"<{refers_to}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields.append(("Content-Length", str(len(block))))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 4) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0, block_bytes: int = 8 << 20, urn: str = "urn:page:") -> None:
    """Write one record per row. Of rows with equal payloads of at least ``min_bytes``
    bytes that of the smallest id is a response and the others revisit it; rows
    repeated under that id are responses all, and so are rows of null id."""
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(uri_col).cast("string"), F.lit("")).alias("_uri"),
                        text_of(payload_col).cast("binary").alias("_payload"))
    rows = rows.withColumn("_sha", F.sha2("_payload", 256)).withColumn("_n", F.octet_length("_payload"))
    # only the payloads that occur more than once are looked up; copies are split by AQE
    first = (rows.filter(F.col("_n") >= min_bytes).groupBy(F.col("_sha").alias("_of"))
             .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).filter("_copies > 1").drop("_copies"))
    first = materialize(first, "repeated-payloads")  # written, so that AQE can split a hot payload's partition
    rows = rows.join(first, F.col("_sha") == F.col("_of"), "left")

    def blocks(batches):
        block = bytearray()
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for r in batch.slice(lo, 64).to_pylist():
                    key = "null" if r["_id"] is None else r["_id"]
                    refers = r["_first"] if r["_first"] is not None and r["_id"] is not None and r["_first"] != r["_id"] else None
                    block += gzip_member(record_bytes(f"{urn}{key}", r["_uri"], r["_payload"], base32_sha1(r["_payload"]),
                                                      None if refers is None else f"{urn}{refers}"))
                    if len(block) >= block_bytes:
                        yield pa.RecordBatch.from_pydict({"block": pa.array([bytes(block)], pa.binary())})
                        block.clear()
        if block:
            yield pa.RecordBatch.from_pydict({"block": pa.array([bytes(block)], pa.binary())})

    archives = map_arrow(rows.select("_id", "_uri", "_payload", "_first"), blocks, "block binary")
    # bytes pass through the text writer as they are; one block, one file
    (archives.select(F.col("block").cast("string").alias("value")).write.mode("errorifexists")
     .option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path))


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """(content, end) of the gzip member at ``at``; raises on any damage."""
    inflate, out, pos = zlib.decompressobj(31), [], at
    while not inflate.eof:
        piece = data[pos: pos + _STEP]
        if not len(piece):
            raise ValueError("truncated member")
        out.append(inflate.decompress(piece))
        pos += len(piece)
    return b"".join(out), pos - len(inflate.unused_data)


def _prefix(data: memoryview, at: int) -> bytes:
    """What still inflates of the damaged member at ``at``."""
    inflate, out, pos, step = zlib.decompressobj(31), [], at, _STEP
    while pos < len(data) and not inflate.eof:
        before = inflate.copy()
        try:
            out.append(inflate.decompress(data[pos: pos + step]))
            pos += step
        except zlib.error:
            if step == 1:
                break
            inflate, step = before, step >> 4  # up to the very byte that fails
    return b"".join(out)


def digest_of(field: str | None) -> tuple[str, bytes] | None:
    """(algorithm, digest) of a header value such as ``sha1:...`` in base32 or hex; None without one, or of
    an algorithm not known here. A value that is neither raises ``ValueError``."""
    algorithm, _, text = (field or "").partition(":")
    algorithm, text = algorithm.strip().lower().replace("-", ""), text.strip()
    if algorithm not in _DIGESTS:
        return None
    size = hashlib.new(algorithm).digest_size
    if len(text) == 2 * size:
        return algorithm, bytes.fromhex(text)
    text = text.rstrip("=").upper()
    found = base64.b32decode(text + "=" * (-len(text) % 8))
    if len(found) != size:
        raise ValueError("digest of a wrong length")
    return algorithm, found


def _vouched(field: str | None, data: bytes, name: str) -> bool:
    """Whether a digest speaks for these bytes; one that differs raises ``ValueError``."""
    want = digest_of(field)
    if want is not None and hashlib.new(want[0], data).digest() != want[1]:
        raise ValueError(f"{name} digest")
    return want is not None


def _record(data: bytes, at: int) -> tuple[dict, int]:
    """(fields, end) of the record at ``at``; raises ValueError on a failed check."""
    if not _VERSION.match(data, at):
        raise ValueError("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise ValueError("unended header")
    fields, name = {}, None
    for line in data[at:stop].split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and name is not None:  # a folded value goes on
            key = name.strip().lower().decode("utf-8", "replace")
            fields[key] = f"{fields[key]} {line.strip().decode('utf-8', 'replace')}".strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        raise ValueError("header without type or length")
    begin, end = stop + 4, stop + 4 + int(fields["content-length"])
    if data[end: end + 4] != b"\r\n\r\n":
        raise ValueError("length does not meet the record's end")
    block = data[begin:end]
    checked = _vouched(fields.get("warc-block-digest"), block, "block")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] != "revisit":  # a revisit's is that of another record's payload
        checked |= _vouched(fields.get("warc-payload-digest"), payload, "payload")
    return fields | {"payload": payload, "checked": checked}, end + 4


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(start, end, fields, None) of every valid record of an archive, compressed by record
    or whole or not at all, and (start, end, None, reason) of every gap between them.
    Places inside a compressed member are the member's; records from the sound part of a damaged member
    end where its gap ends."""
    view, at, bad, reason = memoryview(data), 0, -1, ""
    rescued: list[tuple[int, dict]] = []
    member = line = -1  # the next places to try, kept while they lie ahead

    def here(pos: int):
        if data.startswith(_MEMBER, pos):
            content, end = _member(view, pos)
            if not _VERSION.match(content):
                raise ValueError("member without a record")
            return end, list(_inner(content))
        fields, end = _record(data, pos)
        return end, [(fields, None)]

    while at < len(data):
        if data[at] == 0 and bad < 0 and not data[at:].strip(b"\x00"):
            break  # padding at the end of the file
        try:
            end, found = here(at)
        except (ValueError, zlib.error) as e:
            if bad < 0:
                bad, reason = at, str(e) or type(e).__name__
            if data.startswith(_MEMBER, at):  # damaged bytes may inflate to anything, so only records with a digest
                rescued += [(at, f) for f, _ in _inner(_prefix(view, at)) if f and f["checked"]]
            if member <= at:
                member = data.find(_MEMBER, at + 1) % (len(data) + 1)
            if line <= at:
                found = _VERSION.search(data, at + 1)
                line = found.start() if found else len(data)
            at = min(member, line)
            continue
        if bad >= 0:
            yield from ((start, at, f, None) for start, f in rescued)
            yield bad, at, None, reason
            bad, rescued = -1, []
        for fields, why in found:
            yield at, end, fields, why
        at = end
    if bad >= 0:
        yield from ((start, len(data), f, None) for start, f in rescued)
        yield bad, len(data), None, reason


def _inner(content: bytes) -> Iterator[tuple[dict | None, str | None]]:
    """Records of one member's content, and the reason of each gap among them."""
    at, bad = 0, None
    while at < len(content):
        try:
            fields, end = _record(content, at)
        except ValueError as e:
            bad = bad or str(e)
            line = _VERSION.search(content, at + 1)
            at = line.start() if line else len(content)
            continue
        if bad:
            yield None, bad
            bad = None
        yield fields, None
        at = end
    if bad:
        yield None, bad


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record (``kind`` 'record') and per quarantined gap (``kind`` 'gap', with
    ``file``, ``start``, ``end`` and ``reason``). A revisit has the length and digest that its
    header tells (the digest if it is SHA-1) and no payload. Empty files and folders give no rows."""
    def told_digest(f: dict) -> str | None:
        try:
            told = digest_of(f.get("warc-payload-digest"))
        except ValueError:
            return None
        return base64.b32encode(told[1]).decode() if told and told[0] == "sha1" else None

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[dict] = []
                held = 0
                for start, end, f, why in salvage(content.as_py()):
                    row = {"kind": "record" if f else "gap", "file": file, "start": start, "end": end, "reason": why}
                    if f:
                        payload, revisit = f["payload"], f["warc-type"] == "revisit"
                        told = f.get("warc-payload-length", "")
                        row |= {"record_type": f["warc-type"], "record_id": f.get("warc-record-id", "").strip("<>"),
                                "refers_to": f["warc-refers-to"].strip("<>") if "warc-refers-to" in f else None,
                                "target_uri": f.get("warc-target-uri"),
                                "payload_bytes": int(told) if revisit and told.isdigit() else None if revisit else len(payload),
                                "payload_digest": told_digest(f) if revisit else base32_sha1(payload),
                                "payload": payload if payloads and not revisit else None}
                        held += len(row["payload"] or b"")
                    rows.append(row)
                    if held > 1 << 24 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return map_arrow(files.filter("length > 0").select("path", "content"), run, RECORDS)


_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in RECORDS.split(", "))])


def archive_round_trip(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write a record per page, read the archives back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. A null payload is empty."""
    write_archives(pages, path, min_bytes=min_bytes)
    spark = pages.sparkSession
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return (read_archives(spark, path, payloads=False).filter("kind = 'record'")
            .select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    page("refers_to").alias("refers_to")))
