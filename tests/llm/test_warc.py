from __future__ import annotations

import gzip
import hashlib

import pyarrow.fs
import pytest

from strandline.llm import warc
from tests.llm.helpers import bag, same

SCHEMA = "page_id bigint, url string, html string, file string"


def pages() -> list[tuple]:
    big, other = "<p>" + "ä" * 200, "x\r\n\r\nWARC/1.1\r\n" * 30
    data = [
        (5, "http://www.example.com/a?b=1#c", big), (3, "https://Example.com:443/a", big),
        (9, "http://example.org", big), (1, "http://example.org", "short"), (2, None, "short"),
        (4, "not a url\n\tat all", other), (6, "http://ü.example/ä", other), (7, "http://h:99/", None),
        (8, "http://[bad", ""), (None, "http://example.org", big), (11, "http://example.org", "z" * 100),
        (11, "http://example.org", "z" * 100), (12, "http://x", "z" * 100), (None, None, "q" * 500),
    ]
    data += [(100 + i, "http://busy.example/", f"page {i}" * 20) for i in range(1500)]
    return [(*r, "clash") for r in data]


def expected(data: list[tuple]) -> list[tuple]:
    payloads = [(r[0], (r[2] or "").encode()) for r in data]
    first: dict[bytes, int] = {}
    for page, p in payloads:
        if len(p) >= 100 and page is not None:
            first[p] = min(page, first.get(p, page))
    out = []
    for page, p in payloads:
        refers = first.get(p) if first.get(p) != page else None
        kind = "response" if refers is None else "revisit"
        out.append((page, kind, len(p), hashlib.sha256(p).hexdigest(), refers))
    return out


COLUMNS = ("page_id", "record_type", "payload_bytes", "payload_digest", "refers_to")


@pytest.fixture(scope="module")
def archive(spark):
    return warc.archived(spark.createDataFrame(pages(), SCHEMA).repartition(3))


def test_all_pages_come_back(spark, archive):
    urls = spark.createDataFrame(pages(), SCHEMA)
    found = warc.read_back(archive, warc.captures(archive, urls))
    same(bag(found, *COLUMNS), expected(pages()))
    payloads = {r["page_id"]: bytes(r["payload"]) for r in found.filter("record_type = 'response' AND page_id < 100").collect()}
    assert payloads[4] == ("x\r\n\r\nWARC/1.1\r\n" * 30).encode()
    assert payloads[7] == b""


def test_look_ups(spark, archive):
    def pages_at(*urls):
        asked = spark.createDataFrame([(u,) for u in urls], "url string")
        return sorted(r["page"] for r in warc.captures(archive, asked).collect())

    assert pages_at("http://user@EXAMPLE.org/#x") == sorted(["9", "1", "", "11", "11"])
    assert pages_at("http://nowhere.example/", "zzz", "") == []
    assert len(pages_at("http://busy.example/", "http://busy.example/")) == 1500
    assert pages_at(None) == ["", "2"]


def test_keys():
    assert warc.url_key("http://www.Example.com:80/a b?c=d#e") == "com,example,www)/a%20b?c=d"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/"
    assert warc.url_key(None) == "-"
    assert "\t" not in warc.url_key("a\tb") and "\n" not in warc.url_key("http://h/a\nb")


def test_files_are_plain_warc(spark, archive):
    system, path = pyarrow.fs.FileSystem.from_uri(archive.folder)
    names = [f.path for f in system.get_file_info(pyarrow.fs.FileSelector(path)) if f.path.endswith(".warc.gz")]
    text = b"".join(gzip.decompress(system.open_input_file(n).read()) for n in names)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert text.endswith(b"\r\n\r\n")


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    archive = warc.archived(none)
    assert warc.read_back(archive, warc.captures(archive, none)).count() == 0
    some = spark.createDataFrame(pages()[:2], SCHEMA)
    assert warc.captures(archive, some).count() == 0
