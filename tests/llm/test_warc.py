import gzip
import hashlib

import pytest

from meterloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, type string, file string"
LARGE = "<p>é WARC/1.1\r\n\r\nhttp://x 0.0.0.0 2000 text/html 5\n" + "x" * 2000
PAGES = [
    (1, "http://a.example/", LARGE), (2, "http://b.example/ with space", LARGE), (9, None, LARGE), (3, "http://c", "small"),
    (4, "http://d", "small"), (5, "http://e", None), (6, "http://f", ""), (7, "http://g", "\n\n\r\n\r\n"), (8, "http://h", "z" * 1000),
    (10, "http://i", "z" * 1000), (11, "http://j", "é" * 500), (12, "http://k", "é" * 500), (13, "http://l", "v" * 300_000),
    (None, "http://m", "n" * 1500), (14, "http://n", "twice" * 300), (14, "http://n", "twice" * 300),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "d", "t", "f") for p in PAGES], SCHEMA)


def test_digest_equals_brute_force(pages):
    rows = warc.op8(pages).collect()
    assert len(rows) == len(PAGES)
    payloads = {i: (h or "").encode() for i, _, h in PAGES}
    newest = {}
    for i, p in payloads.items():
        if len(p) >= 1000 and i is not None:
            newest[p] = max(i, newest.get(p, i))
    for r in rows:
        p = payloads[r.page_id]
        assert r.payload_bytes == len(p) and r.payload_digest == hashlib.sha1(p).hexdigest()
        first = newest.get(p, r.page_id)
        if r.page_id != 14:
            assert (r.record_type, r.refers_to) == (("revisit", first) if first != r.page_id else ("response", None))
    twice = sorted((r.record_type, r.refers_to) for r in rows if r.page_id == 14)
    assert twice == [("response", None), ("revisit", 14)]


def test_both_versions_and_many_files(spark, pages, tmp_path):
    warc.write_arc(pages.coalesce(1), str(tmp_path / "arc"), per_file=3)
    records = warc.read_arc(spark, str(tmp_path / "arc")).collect()
    assert {r.version for r in records} == {1, 2} and len({r.record_id for r in records}) == len(PAGES)
    assert sorted((r.page_id or 0, bytes(r.payload)) for r in records) == sorted((i or 0, (h or "").encode()) for i, _, h in PAGES)
    assert {r.url for r in records if r.page_id == 2} == {"http://b.example/%20with%20space".replace("/%20", "/%20")}
    frame = warc.to_warc(warc.read_arc(spark, str(tmp_path / "arc")))
    warc.write_warc(frame, str(tmp_path / "warc"), per_file=4)
    back = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert len(back) == len(PAGES)
    for r in back:
        assert (r.payload is None) == (r.type == "revisit") and r.date.startswith("2000-01-01T00:00:")
    for file in (tmp_path / "warc").glob("part-*"):
        first, _ = next(warc.parse_warc(file.read_bytes()))
        assert first["WARC-Type"] == "warcinfo"


def test_parsers_go_by_declared_lengths():
    arc = (
        b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain 75\n1 0 InternetArchive\n"
        b"URL IP-address Archive-date Content-type Archive-length"
    )
    body = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\nhttp://x 1.2.3.4 19970101 text/html 3\n"
    data = arc + b"\n" + b"http://a/ 1.2.3.4 19970102030405 text/html %d\n" % len(body) + body + b"\n"
    (offset, version, fields, block), = warc.parse_arc(gzip.compress(data))
    assert (version, fields["URL"], block) == (1, "http://a/", body)
    record = warc._converted("old.arc", offset, version, fields, block)
    assert record[5] == "1997-01-02T03:04:05Z" and record[7].endswith(b"\r\n\r\n") and record[8].startswith(b"http://x")
    assert warc._converted("old.arc", 0, 1, fields, b"dns block")[7:9] == (b"", b"dns block")
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-20]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data.replace(b"1.2.3.4 1997010203", b"1.2.3.4 - 1997010203")))


def test_damage_is_found():
    row = dict(record_id="urn:uuid:1", type="response", date="d", url="u", ip="i", http=b"HTTP/1.1 200 OK\r\n\r\n", payload=b"abc",
               digest=hashlib.sha1(b"abc").hexdigest(), refers_to=None)
    data = warc._warc_record(row) + b"\r\n\r\n"
    assert len(list(warc.parse_warc(data))) == 1
    with pytest.raises(ValueError):
        list(warc.parse_warc(data.replace(b"abc", b"abd")))


def test_empty_table(pages):
    assert warc.op8(pages.limit(0)).count() == 0
