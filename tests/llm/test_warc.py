import base64
import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from churnlens.llm.warc import archive_round_trip, base32_sha1, gzip_member, read_archives, record_bytes, salvage, write_archives

PAGES = "page_id long, url string, html string"


def members(n=6):
    return [gzip_member(record_bytes(f"urn:page:{i}", f"http://h/{i}", body := f"<p>page {i} é</p>".encode() * 40, base32_sha1(body)))
            for i in range(n)]


def found(data):
    out = list(salvage(data))
    return [f["warc-record-id"] for _, _, f, _ in out if f], [(a, b) for a, b, f, _ in out if f is None]


def ids(*numbers):
    return [f"<urn:page:{i}>" for i in numbers]


def test_round_trip(spark, tmp_path):
    rows = [(5, "u", "same"), (3, "u", "same"), (9, "u", "same"), (1, "u", None), (2, "u", ""), (7, "a\r\nb", "unlike é"), (None, "u", "x")]
    out = archive_round_trip(spark.createDataFrame(rows, PAGES), f"file://{tmp_path}/a").collect()
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out}
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert got == {5: (4, digest("same"), "revisit", 3), 3: (4, digest("same"), "response", None), 9: (4, digest("same"), "revisit", 3),
                   1: (0, digest(""), "response", None), 2: (0, digest(""), "revisit", 1),
                   7: (9, digest("unlike é"), "response", None), None: (1, digest("x"), "response", None)}
    full = read_archives(spark, f"file://{tmp_path}/a").filter("record_id = 'urn:page:7'").collect()[0]
    assert bytes(full["payload"]).decode() == "unlike é" and full["target_uri"] == "ab"


def test_smaller_payloads_are_all_responses_and_archives_are_gzip(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough")]
    out = archive_round_trip(spark.createDataFrame(rows, PAGES), f"file://{tmp_path}/a", min_bytes=5).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in out) == [
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]
    parts = [p for p in (tmp_path / "a").iterdir() if p.name.startswith("part-")]
    assert sum(gzip.open(p).read().count(b"WARC/1.1\r\n") for p in parts) == 4


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], PAGES)
    assert archive_round_trip(empty, f"file://{tmp_path}/a").collect() == []


def test_blocks_are_bounded(spark, tmp_path):
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                    F.concat(F.sha2(F.col("id").cast("string"), 512), F.col("id")).alias("html")).coalesce(1)
    write_archives(pages, f"file://{tmp_path}/a", block_bytes=10_000)
    parts = [p.stat().st_size for p in (tmp_path / "a").iterdir() if p.name.startswith("part-")]
    assert len(parts) > 5 and max(parts) < 12_000
    assert read_archives(spark, f"file://{tmp_path}/a").filter("kind = 'record'").count() == 200


@pytest.mark.parametrize("damage", ["flip", "cut", "garbage", "head"])
def test_salvage_of_compressed_archives(damage):
    parts = members()
    whole = b"".join(parts)
    at = len(parts[0]) + len(parts[1])
    if damage == "flip":
        data = bytearray(whole)
        data[at + 60] ^= 0xFF
        assert found(bytes(data)) == (ids(0, 1, 3, 4, 5), [(at, at + len(parts[2]))])
    elif damage == "cut":
        data = whole[: at + 50] + whole[at + len(parts[2]):]
        assert found(data) == (ids(0, 1, 3, 4, 5), [(at, at + 50)])
        assert found(whole[:-20]) == (ids(0, 1, 2, 3, 4), [(len(whole) - len(parts[5]), len(whole) - 20)])
    elif damage == "garbage":
        junk = b"\x1f\x8b\x08 not a member, WARC/1.0 neither"
        assert found(whole[:at] + junk + whole[at:] + b"\x00\x00") == (ids(*range(6)), [(at, at + len(junk))])
    else:
        assert found(b"??" + whole) == (ids(*range(6)), [(0, 2)])


def test_salvage_of_plain_archives_and_wrong_digests():
    records = [zlib.decompress(m, 31) for m in members()]
    assert found(b"".join(records)) == (ids(*range(6)), [])
    spoilt = records[2].replace(b"page 2", b"page X")
    at = len(records[0]) + len(records[1])
    assert found(b"".join([*records[:2], spoilt, *records[3:]])) == (ids(0, 1, 3, 4, 5), [(at, at + len(spoilt))])
    # one member around many records: the bad one is skipped inside it
    got, gaps = found(gzip_member(b"".join([*records[:2], spoilt, *records[3:]])))
    assert got == ids(0, 1, 3, 4, 5) and len(gaps) == 1
    bad = gzip_member(spoilt)
    assert found(bad + gzip_member(records[3]))[0] == ids(3)
    assert found(b"") == ([], []) and found(b"\x00" * 9) == ([], []) and found(b"junk") == ([], [(0, 4)])


def foreign(i, digest, extra=""):
    body = f"<p>page {i}</p>".encode() * 30
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n{extra}"
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    return (head + f"WARC-Payload-Digest: {digest(body)}\r\nContent-Type: application/http\r\n"
            f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


DIGESTS = [lambda b: "sha1:" + base32_sha1(b).lower(), lambda b: "SHA-1:" + hashlib.sha1(b).hexdigest(),
           lambda b: "sha1:" + hashlib.sha1(b).hexdigest().upper(), lambda b: "sha256:" + hashlib.sha256(b).hexdigest(),
           lambda b: "sha-256:" + base64.b32encode(hashlib.sha256(b).digest()).decode().rstrip("="),
           lambda b: "md5:" + hashlib.md5(b).hexdigest(), lambda b: "blake3:unknown"]


@pytest.mark.parametrize("digest", DIGESTS)
def test_digests_of_other_writers(digest):
    good = foreign(1, digest)
    assert found(good + gzip_member(foreign(2, digest))) == (ids(1, 2), [])
    spoilt = good.replace(b"page 1", b"page X")
    known = not digest(b"").startswith("blake3")
    assert found(spoilt) == ((([], [(0, len(spoilt))])) if known else (ids(1), []))


def test_undecodable_digest_is_a_failed_check():
    for text in ("sha1:", "sha1:!!!!", "sha1:" + "0" * 39, "sha1:" + "z" * 40):
        bad = foreign(1, lambda b: text)  # noqa: B023
        assert found(bad + foreign(2, DIGESTS[0])) == (ids(2), [(0, len(bad))])


def test_folded_header_values():
    record = foreign(1, DIGESTS[0], "WARC-Target-URI: http://h/\r\n  one\r\n\ttwo\r\n")
    (_, _, fields, _), = salvage(record)
    assert fields["warc-target-uri"] == "http://h/ one two" and fields["payload"].startswith(b"<p>page 1")
    lost = record.replace(b"WARC-Type", b" folded\r\nWARC-Type", 1)  # nothing to go on with
    assert found(lost) == ([], [(0, len(lost))])


def test_sound_part_of_a_damaged_member():
    # random letters: the compressed place tells the place in the content
    import random
    rng = random.Random(5)
    records = [record_bytes(f"urn:page:{i}", "u", body := bytes(rng.choices(b"abcdefgh", k=4000)), base32_sha1(body)) for i in range(50)]
    member = gzip_member(b"".join(records))
    after = members(7)[6]
    for at in (len(member) - 6, len(member) - 1500, len(member) // 2):  # the checksum, near the end, half-way
        data = bytearray(member + after)
        data[at] ^= 0xFF
        got, gaps = found(bytes(data))
        sound = got[:-1]
        assert got[-1:] == ids(6) and gaps == [(0, len(member))]
        assert sound == ids(*range(len(sound))) or at == len(member) // 2
        assert len(sound) >= (50 if at == len(member) - 6 else 47 if at > len(member) // 2 else 23)
    assert len(found(member[:-1500])[0]) >= 47
    # without a digest nothing vouches for what a damaged member inflates to
    plain = gzip_member(b"".join(foreign(i, lambda b: "none:") for i in range(20)))
    assert found(plain) == (ids(*range(20)), [])
    assert found(plain[:-4]) == ([], [(0, len(plain) - 4)])


def test_revisit_digest_is_read_in_any_form(spark, tmp_path):
    import pathlib
    body = b"x" * 10
    block = b"HTTP/1.1 200 OK\r\n\r\n"
    record = (f"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: "
              f"sha1:{hashlib.sha1(body).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"
    pathlib.Path(tmp_path, "f.warc").write_bytes(record)
    row, = read_archives(spark, f"file://{tmp_path}").collect()
    assert row["payload_digest"] == base32_sha1(body) and row["payload"] is None and row["payload_bytes"] is None
