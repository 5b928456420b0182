import gzip
import hashlib
import tempfile
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PythonException

from gleanspark.llm import files, warc
from gleanspark.llm.queries import op10_warc
from tests.llm import odd

SCHEMA = "page_id bigint, url string, html string, payload_digest string, original string"


def odd_pages(spark):
    big, other = "<p>é" * 400, "x" * 1000
    rows = [
        (1, "u1", big), (2, "u2", big), (3, None, big), (3, "u3", big), (None, "n", big),
        (4, "a b\r\nEvil: 1", other), (5, "", other[:-1]), (6, "s", other[:-1]),
        (7, "z", None), (8, "z", ""), (9, "q", "WARC/1.1\r\n\r\n\r\n"), (9, "q", "WARC/1.1\r\n\r\n\r\n"),
        (None, None, None), (10, "h", "\x00\x85 " * 100_000),
    ]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def brute(rows):
    last = {}
    for page, html in rows:
        own = (html or "").encode()
        if page is not None and len(own) >= 1000:
            last[own] = max(last.get(own, page), page)
    out = Counter()
    for page, html in rows:
        own = (html or "").encode()
        original = last.get(own)
        refers = original if original != page else None
        kind = "response" if refers is None else "revisit"
        out[page, len(own), hashlib.sha1(own).hexdigest(), kind, refers] += 1
    return out


def check(spark, path):
    rows = [(r[0], r[2]) for r in odd.rows_of(spark, path, "pages")]
    found = op10_warc(spark, path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == brute(rows)


def test_equals_brute_force(spark, sf_dir):
    check(spark, sf_dir)


def test_odd_rows(spark):
    check(spark, odd.folder(spark, pages=odd_pages(spark)))


def test_empty_table(spark):
    assert op10_warc(spark, odd.folder(spark)).count() == 0


def test_archives_and_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    pages, path = odd_pages(spark), tempfile.mkdtemp(prefix="run-")
    index = warc.write_archives(pages.coalesce(1), path)
    rows = index.collect()
    assert len({r["file"] for r in rows}) > 1
    for r in rows:
        data = Path(path, "archives", r["file"]).read_bytes()
        head = gzip.decompress(data[r["offset"] : r["offset"] + r["length"]])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())
        assert b"\r\nEvil" not in head.split(b"\r\n\r\n")[0]
    some = index.where("page_id in ('2', '8', '10')")
    found = {r["page_id"]: r for r in warc.read_records(some, path).collect()}
    assert found.keys() == {"2", "8", "10"}
    assert found["10"]["payload"].decode() == "\x00\x85 " * 100_000
    assert found["2"]["payload"] is None and found["2"]["refers_to"] == "3"
    assert found["8"]["payload"] == b"" and found["8"]["url"] == "z"


def test_records_are_valid_http(spark):
    path = tempfile.mkdtemp(prefix="run-")
    index = warc.write_archives(odd_pages(spark), path).collect()
    seen = set()
    for r in index:
        data = Path(path, "archives", r["file"]).read_bytes()
        plain = gzip.decompress(data[r["offset"] : r["offset"] + r["length"]])
        head, _, block = plain.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert fields[b"Content-Type"] == b"application/http; msgtype=response"
        assert int(fields[b"Content-Length"]) + 4 == len(block)
        http, _, payload = block[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        assert b"Content-Length: %d" % r["payload_bytes"] in http
        if r["record_type"] == "response":
            assert hashlib.sha1(payload).hexdigest() == r["payload_digest"]
            assert len(payload) == r["payload_bytes"]
        else:
            assert payload == b"" and fields[b"WARC-Refers-To-Target-URI"] == b"u3"
        seen.add(fields[b"WARC-Record-ID"])
    # Repeated rows and rows without an id have record ids of their own.
    assert len(seen) == len(index) == odd_pages(spark).count()


def test_ids_of_any_text_come_back(spark):
    path, ids = tempfile.mkdtemp(prefix="run-"), ["", "a b", "x\r\nEvil: 1", "é%41", None]
    rows = [(i, "u", "page " * 300) for i in ids]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    found = warc.read_records(warc.write_archives(pages, path), path).collect()
    last = max(x for x in ids if x is not None)
    assert {r["page_id"] for r in found} == set(ids)
    assert {r["refers_to"] for r in found if r["page_id"] != last} == {last}
    assert [r["refers_to"] for r in found if r["page_id"] == last] == [None]


def test_damage_is_found(spark):
    path = tempfile.mkdtemp(prefix="run-")
    pages = spark.createDataFrame([(1, "u", "some page")], "page_id bigint, url string, html string")
    index = warc.write_archives(pages, path)
    file = Path(path, "archives", index.first()["file"])
    plain = gzip.decompress(file.read_bytes()).replace(b"some page", b"same page")
    file.write_bytes(gzip.compress(plain, 6, mtime=0))
    longer = index.selectExpr("file", "offset", f"{file.stat().st_size}L as length")
    with pytest.raises(PythonException, match="does not fit"):
        warc.read_records(longer, path).collect()


def test_reads_are_joined():
    ranges = [(0, 10), (10, 10), (25, 5), (100, 50), (150, 900), (2000, 1)]
    assert files.coalesced(ranges, 5, 100) == [
        (0, 30, 0, 3), (100, 50, 3, 4), (150, 900, 4, 5), (2000, 1, 5, 6),
    ]
    assert files.coalesced([], 5, 100) == []
