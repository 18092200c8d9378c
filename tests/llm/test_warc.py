"""WARC archives: round trips against hashlib, and the files against a reader of their own."""

import base64
import glob
import gzip
import hashlib
import random

import pytest

from skyledger.llm import warc
from skyledger.llm.store import shared_path

SCHEMA = "page_id long, url string, html string, record long, chunk int, head string, line string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, 5, 6, "x", "y") for i, u, h in rows], SCHEMA).repartition(3)


def brute(rows, least=0):
    """The contract by dictionaries: sorted result rows."""
    first, out = {}, []
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (h or "").encode()
        new = data not in first or len(data) < least
        first.setdefault(data, i)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if new else "revisit",
                    None if new else first[data]))
    return sorted(out, key=repr)


def odd_pages(seed=1):
    rng = random.Random(seed)
    pieces = ["\r", "\n", "\r\n", "\r\r\n", "a", "é", "日本", "😀", "\x00", "0\r\n\r\n", "WARC/1.1\r\n", "\r\n\r\n"]
    rows = [(i, f"http://a/{i}", "".join(rng.choices(pieces, k=rng.randrange(0, 60)))) for i in range(80)]
    rows += [(200, None, None), (201, "x", ""), (202, "u\r\nWARC-Type: revisit\nä", "one"), (203, "", "one"), (150, "", "one"),
             (None, "n", "one"), (None, "n", "alone"), (None, "n", "alone"), (204, "t", "twice"), (204, "t", "twice"), (204, "t", "twice")]
    return rows + [(300, "big", "ü\r\n" * 50_000), (301, "big", "ü\r\n" * 50_000), (302, "plain", "x" * 300_000)]


@pytest.mark.parametrize("chunk", [1, 7, 64, warc.CHUNK])
def test_round_trip(spark, chunk):
    rows = [r for r in odd_pages(chunk) if chunk > 7 or not r[2] or len(r[2]) < 10_000]
    got = warc.archive_pages(table(spark, rows), chunk=chunk)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_small_payloads_are_all_responses(spark):
    rows = odd_pages()
    got = warc.archive_pages(table(spark, rows), least_bytes=4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 4)


def records(folder):
    """Records of gzip WARC files by the format's own rules: heads, then Content-Length bytes, then two empty lines."""
    for name in glob.glob(folder.removeprefix("file:") + "/*.gz"):
        with gzip.open(name) as f:
            while start := f.readline():
                assert start == b"WARC/1.1\r\n"
                fields = {}
                while (line := f.readline()) != b"\r\n":
                    key, value = line.decode().rstrip("\r\n").split(": ", 1)
                    fields[key] = value
                block = f.read(int(fields["Content-Length"]))
                assert f.read(4) == b"\r\n\r\n"
                yield fields, block


def unchunked(body):
    out = b""
    while True:
        size, _, body = body.partition(b"\r\n")
        n = int(size, 16)
        out, body = out + body[:n], body[n:]
        assert body[:2] == b"\r\n"
        body = body[2:]
        if n == 0:
            assert not body
            return out


def test_files_are_warc(spark):
    rows = [r for r in odd_pages(5) if r[0] is not None]
    path = shared_path(spark, "t-warc")
    chunks = warc.chunk_table(table(spark, rows), 100)
    warc.write_archives(chunks, warc.originals(chunks), path)
    payloads, revisits = {}, []
    for fields, block in records(path):
        head, _, body = block.partition(b"\r\n\r\n")
        assert head.startswith(b"HTTP/1.1 200 OK")
        if fields["WARC-Type"] == "response":
            data = unchunked(body)
            assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
            payloads[fields["WARC-Record-ID"]] = (fields["WARC-Payload-Digest"], data)
        else:
            assert not body
            revisits.append(fields)
    assert len(payloads) + len(revisits) == len(rows)
    assert sorted(d for _, d in payloads.values()) == sorted({(h or "").encode() for _, _, h in rows})
    for fields in revisits:
        assert payloads[fields["WARC-Refers-To"]][0] == fields["WARC-Payload-Digest"]


def test_chunk_rows_carry_running_digests(spark):
    got = warc.chunk_table(table(spark, [(1, "u", "abcdefg"), (2, "u", None)]), 3).orderBy("page_id", "chunk").collect()
    assert [(r.page_id, r.chunk, r["last"], bytes(r.data), r.n_bytes) for r in got] == [
        (1, 0, False, b"abc", 3), (1, 1, False, b"def", 6), (1, 2, True, b"g", 7), (2, 0, True, b"", 0)]
    assert [bytes(r.sha1) for r in got] == [hashlib.sha1(x).digest() for x in (b"abc", b"abcdef", b"abcdefg", b"")]


@pytest.mark.parametrize("old, new", [(b"abc", b"abd"), (b"Content-Length: ", b"Content-Length: 1"), (b"\r\n3\r\n", b"\r\n2\r\n")])
def test_damage_is_noticed(spark, tmp_path, old, new):
    chunks = warc.chunk_table(table(spark, [(1, "u", "abcdefg")]), 3)
    path = shared_path(spark, "t-damage")
    warc.write_archives(chunks, warc.originals(chunks), path)
    for name in glob.glob(path.removeprefix("file:") + "/*.gz"):
        data = gzip.open(name).read()
        if data:
            (tmp_path / "a.gz").write_bytes(gzip.compress(data.replace(old, new, 1)))
    with pytest.raises(Exception, match="WARC record"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_binary_payloads_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", bytearray(b"\xff\xfe\n\r\n")), (2, "u", None)], "page_id long, url string, html binary")
    got = {r.page_id: r.payload_digest for r in warc.archive_pages(df).collect()}
    assert got[1] == base64.b32encode(hashlib.sha1(b"\xff\xfe\n\r\n").digest()).decode()
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0
