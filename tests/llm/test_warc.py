import glob
import hashlib
import zlib

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.common import table
from tidemark.session import new_folder

PAGES = "page_id bigint, url string, html string, payload_digest string, refers_to string, size int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES)


def sha1(text):
    return hashlib.sha1((text or "").encode()).hexdigest()


LONG = "é" * 600
ODD = [
    (1, "http://a/\r\nX: y", "<p>x</p>"), (2, "http://a", "<p>x</p>"), (3, None, None), (4, "http://b", ""), (5, "u", LONG), (9, "u", LONG), (7, None, LONG),
    (6, "u", "z" * 999), (8, "u", "z" * 999), (10, "u", "z" * 1000), (11, "u", "z" * 1000), (11, "u", "z" * 1000), (None, "u", LONG), (12, "u", "\r\n\r\nWARC/1.1\r\n" * 3),
    (13, "u", "long " * 1_000_000),
]


def test_odd_rows(spark):
    got = warc.archive_pages(pages(spark, ODD))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    largest = {sha1(LONG): 9, sha1("z" * 1000): 11}
    expected = []
    for i, _, text in ODD:
        first = largest.get(sha1(text), i)
        expected.append((i, len((text or "").encode()), sha1(text), "response" if first == i else "revisit", None if first == i else first))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark, [])).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip_of_whole_payloads(spark, sf_dir, compress):
    given = table(spark, sf_dir, "pages")
    archives = warc.write_archives(warc.plan_records(given), new_folder(spark, "warc"), compress, limit=100_000)
    assert archives.count() > 3 and archives.agg(F.sum("records")).first()[0] == given.count()
    read = warc.read_archives(archives, payloads=True)
    assert read.filter("kind = 'gap'").count() == 0
    stored = {r.record_id: r.payload.decode() for r in read.filter("record_type = 'response'").collect()}
    back = {r.record_id: stored[r.refers_to] if r.refers_to else stored[r.record_id] for r in read.collect()}
    assert back == {warc.record_id(r.page_id): r.html for r in given.collect()}


def archive(tmp_path, compress):
    """Five records, the bytes of each, and the file's name."""
    parts = []
    for i in range(5):
        text = f"<p>page {i}</p>" * (50 + i)
        record = warc.make_record(i, f"http://h/{i}", text, sha1(text), len(text), "response", None)
        if compress:
            pack = zlib.compressobj(6, zlib.DEFLATED, 31)
            record = pack.compress(record) + pack.flush()
        parts.append(record)
    return parts, tmp_path / ("x.warc" + ".gz" * compress)


def salvage(path):
    store, name = fs.FileSystem.from_uri(str(path))
    with store.open_input_file(name) as file:
        return list(warc._Salvage(file, file.size()))


DAMAGE = {
    "a byte in the middle": lambda p: [p[0], p[1][: len(p[1]) // 2] + bytes([p[1][len(p[1]) // 2] ^ 255]) + p[1][len(p[1]) // 2 + 1 :], *p[2:]],
    "the start of a record": lambda p: [p[0], b"\0\0" + p[1][2:], *p[2:]],
    "a record without its end": lambda p: [p[0], p[1][:-30], *p[2:]],
    "bytes between records": lambda p: [p[0], b"\x1f\x8b\x08 WARC/1. junk" * 3, *p[2:]],
    "much between records": lambda p: [p[0], b"x" * (3 * warc.CHUNK) + b"\x1f\x8b", *p[2:]],
}


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("name", DAMAGE)
def test_later_records_are_recovered(tmp_path, compress, name):
    parts, path = archive(tmp_path, compress)
    broken = DAMAGE[name](parts)
    path.write_bytes(b"".join(broken))
    found = salvage(path)
    assert [r["target_uri"] for _, _, r, _ in found if r] == [f"http://h/{i}" for i in (0, 2, 3, 4)]
    gaps = [(a, b) for a, b, r, _ in found if not r]
    assert gaps == [(len(parts[0]), len(parts[0]) + len(broken[1]))]
    assert all(reason for *_, r, reason in found if not r)
    assert [a for a, *_ in found] == [0, *(b for _, b, *_ in found)][:-1]  # every byte is a record's or a gap's


@pytest.mark.parametrize("compress", [True, False])
def test_ends_that_are_cut_off(tmp_path, compress):
    parts, path = archive(tmp_path, compress)
    path.write_bytes(b"".join(parts)[:-10])
    found = salvage(path)
    assert [bool(r) for _, _, r, _ in found] == [True] * 4 + [False]
    path.write_bytes(b"junk" + b"".join(parts))
    assert [bool(r) for _, _, r, _ in salvage(path)] == [False] + [True] * 5
    path.write_bytes(b"")
    assert salvage(path) == []
    path.write_bytes(b"nothing of the kind")
    assert [(a, b, bool(r)) for a, b, r, _ in salvage(path)] == [(0, 19, False)]


def test_gaps_are_rows(spark, tmp_path):
    parts, path = archive(tmp_path, True)
    path.write_bytes(parts[0] + b"????" + parts[1])
    rows = warc.read_archives(spark.createDataFrame([(str(path),)], "archive string")).orderBy("begin").collect()
    assert [(r.kind, r.begin, r.finish) for r in rows] == [
        ("record", 0, len(parts[0])), ("gap", len(parts[0]), len(parts[0]) + 4), ("record", len(parts[0]) + 4, len(parts[0] + parts[1]) + 4),
    ]
    assert rows[1].reason and rows[1].archive == str(path)


def test_only_listed_archives_are_read(spark, sf_dir):
    folder = new_folder(spark, "warc")
    plan = warc.plan_records(table(spark, sf_dir, "pages").limit(20))
    first = warc.write_archives(plan, folder)
    warc.write_archives(plan, folder)  # as a second attempt would leave it
    assert len(glob.glob(folder.removeprefix("file:") + "/*.warc.gz")) > first.count()
    assert warc.read_archives(first).count() == 20


LONG_URLS = ["http://h/" + "p" * 100_000, "http://h/" + " " * 40_000, "http://h/" + "\r\nWARC/1.1" * 10_000]


def test_long_urls_are_no_gaps(spark):
    got = warc.archive_pages(pages(spark, [(i, url, "x") for i, url in enumerate(LONG_URLS)]))
    assert sorted(r.page_id for r in got.collect()) == [0, 1, 2]


@pytest.mark.parametrize("compress", [True, False])
def test_long_headers_beside_damage(tmp_path, compress):
    parts, path = archive(tmp_path, compress)
    long = [warc.make_record(7, url, "x", sha1("x"), 1, "response", None) for url in LONG_URLS]
    path.write_bytes(b"".join(zlib.compress(x, wbits=31) if compress else x for x in long) + parts[0][:40] + parts[1])
    found = salvage(path)
    assert [r["target_uri"] for _, _, r, _ in found if r] == [*map(warc._uri, LONG_URLS), "http://h/1"]
    assert [b - a for a, b, r, _ in found if not r] == [40]


def test_a_page_that_cannot_be_read_back_is_an_error(spark, tmp_path):
    parts, path = archive(tmp_path, True)
    listed = spark.createDataFrame([(str(path),)], "archive string")
    path.write_bytes(b"".join(parts))
    assert warc.pages_of(warc.read_archives(listed)).count() == 5
    path.write_bytes(b"".join(DAMAGE["a byte in the middle"](parts)))
    with pytest.raises(Exception, match="unreadable bytes"):
        warc.pages_of(warc.read_archives(listed)).collect()
