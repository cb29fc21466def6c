import base64
import gzip
import hashlib
import io

import duckdb
import pytest

from panelspark.llm import archives
from panelspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
PAGES = [
    (5, "http://a b/é\n", "<p>é\r\n\r\nx</p>"), (3, None, "<p>é\r\n\r\nx</p>"), (9, "u", None), (7, "u", ""), (8, "u", "WARC/1.1\r\n\r\n"),
    (8, "u", "WARC/1.1\r\n\r\n"), (None, "n", "null key"), (None, "n", "null key"), (None, "n", "<p>é\r\n\r\nx</p>"), (1, "long", "y" * 200000), (2, "nul", "\x00\x01"),
]


def brute(pages):
    first, out, seen = {}, [], set()
    for k, _, p in pages:
        first.setdefault(p or "", []).append((k is None, k or 0))
    for k, _, p in pages:
        data = (p or "").encode()
        none, least = min(first[p or ""])
        own = (none, least) == (k is None, k or 0) and (p or "") not in seen
        if own:
            seen.add(p or "")
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((k, len(data), sha, "response" if own else "revisit", None if own or none else least))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf_dir):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as key", "'x' as payload").repartition(3)
    out = QUERIES["op8_arc_to_warc"](spark, sf_dir(pages=pages))
    assert sorted(map(tuple, out.collect()), key=str) == brute(PAGES)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    out = QUERIES["op8_arc_to_warc"](spark, SF).select(names)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(con.sql(ORACLES["op8_arc_to_warc"]).select(", ".join(names)).fetchall(), key=str)


def test_files_are_archives(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    archives.write_arc(pages, f"{tmp_path}/arc")
    archives.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    (arc,) = (tmp_path / "arc").glob("*.gz")
    data = gzip.decompress(arc.read_bytes())
    assert data.startswith(b"filedesc://part-00000.arc 0.0.0.0 20240101000000 text/plain ")
    records = list(archives.arc_records(io.BytesIO(data)))
    assert len(records) == len(PAGES) and records[0][1] == "http://a%20b/é%0A" and records[1][1] == "-"
    warc = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("*.gz"))
    read = list(archives.warc_records(io.BytesIO(warc)))
    ids = [h["warc-record-id"] for h, _ in read]
    assert len(set(ids)) == len(PAGES)
    for h, block in read:
        assert h["warc-block-digest"] == "sha1:" + archives.digest(block) and h["warc-date"] == "2024-01-01T00:00:00Z"
        if h["warc-type"] == "revisit":
            assert h["warc-refers-to"] in ids and block.endswith(b"\r\n\r\n")
        else:
            assert h["warc-payload-digest"] == "sha1:" + archives.digest(archives.split_http(block)[1])
    kept = archives.read_warc(spark, f"{tmp_path}/warc").filter("record_type = 'response'")
    assert {bytes(r.payload).decode() for r in kept.collect()} == {p or "" for _, _, p in PAGES}


@pytest.mark.parametrize("version", [1, 2])
def test_header_lines_of_both_versions(version):
    text = archives.version_block(version, "x.arc") + b"\n" + archives.arc_record(version, 4, "http://a/ü", "ä".encode(), "x.arc") + b"\n"
    ((offset, uri, ip, date, block),) = archives.arc_records(io.BytesIO(text))
    assert (uri, ip, date) == ("http://a/ü", "0.0.0.0", "2024-01-01T00:00:00Z")
    assert archives.split_http(block)[1].decode() == "ä" and archives.header_of(block, b"x-page-id") == "4"
    with pytest.raises(ValueError, match="ends early"):
        list(archives.arc_records(io.BytesIO(text[:-4])))
    with pytest.raises(ValueError, match="header line"):
        list(archives.arc_records(io.BytesIO(b"http://a 1.1.1.1 text/html\n")))


def test_blanks_in_a_url_and_short_dates():
    body = b"raw bytes"
    line = b"http://a/b c 1.2.3.4 199609 text/plain %d\n" % len(body)
    ((_, uri, _, date, block),) = archives.arc_records(io.BytesIO(line + body + b"\n"))
    assert (uri, date, archives.split_http(block)) == ("http://a/b c", "1996-09-01T00:00:00Z", (b"", body))


def test_payloads_that_are_no_text(spark, tmp_path):
    """Legacy encodings, images and what looks like the end of a record come back byte for byte."""
    payloads = ["caf\u00e9".encode("latin-1"), bytes(range(256)) * 50, b"\xff\xfe", b"\r\n\r\nWARC/1.1\r\n\r\n", b"\x89PNG\r\n\x1a\n", b"", None]
    pages = [(i, f"http://a/{i}", p) for i, p in enumerate([*payloads, payloads[0], payloads[1]])]
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    archives.write_arc(spark.createDataFrame(pages, "page_id long, url string, html binary").repartition(2), arc)
    archives.convert(spark, arc, warc)
    got = {r.key: r for r in archives.read_warc(spark, warc).collect()}
    assert {k: bytes(r.payload) for k, r in got.items() if r.record_type == "response"} == {i: p for i, p in enumerate(payloads[:6])}
    assert {k: (r.refers_to, r.payload_bytes) for k, r in got.items() if r.record_type == "revisit"} == {6: (5, 0), 7: (0, 4), 8: (1, 12800)}
    for i, p in enumerate(payloads):
        assert got[i].payload_digest == archives.digest(p or b"")


def test_least_bytes_keeps_small_copies_as_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    archives.write_arc(pages, f"{tmp_path}/arc")
    archives.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", least_bytes=3)
    out = archives.read_warc(spark, f"{tmp_path}/warc").select("key", "record_type", "refers_to").collect()
    assert sorted(map(tuple, out)) == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_empty_table(spark, sf_dir):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert QUERIES["op8_arc_to_warc"](spark, sf_dir(pages=pages)).count() == 0
