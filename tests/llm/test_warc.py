import gzip
import hashlib

import pytest

import verify
from newsboard.llm import warc as W

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string, body string, sha1 string, chunk string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def by_id(df):
    return {r["page_id"]: r for r in df.filter("last").collect()}


def test_query_matches_sql(spark):
    assert verify.compare(spark, verify.connect(SF), "op1_warc", SF).startswith("ok")


def test_chunks_carry_running_digests(spark):
    text = "é1234567" * 40_000
    got = W.read_warc(W.write_warc(pages(spark, [(1, "http://a/ b", text)])), chunk_bytes=1000).orderBy("chunk").collect()
    raw = text.encode()
    assert b"".join(r["data"] for r in got) == raw and [r["chunk"] for r in got] == list(range(len(got)))
    for r in got:
        assert len(r["data"]) <= 1000 and r["bytes_so_far"] == min(len(raw), 1000 * (r["chunk"] + 1))
        assert r["sha1_so_far"] == hashlib.sha1(raw[: r["bytes_so_far"]]).hexdigest()
        assert r["last"] == (r["chunk"] == len(got) - 1) and r["url"] == "http://a/%20b"


def test_copies_revisit_the_largest_id(spark):
    big, small = "x" * 1000, "x" * 999
    rows = [(i, "u", big) for i in (5, 3, 9)] + [(i, "u", small) for i in (1, 2)] + [(None, "u", big), (7, None, None)]
    got = by_id(W.read_warc(W.write_warc(pages(spark, rows))))
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {
        5: ("revisit", 9), 3: ("revisit", 9), None: ("revisit", 9), 9: ("response", None),
        1: ("response", None), 2: ("response", None), 7: ("response", None),
    }
    assert got[5]["payload_bytes"] == 1000 and got[5]["payload_sha1"] == hashlib.sha1(big.encode()).hexdigest()
    assert got[7]["payload_bytes"] == 0 and got[7]["payload_sha1"] == hashlib.sha1(b"").hexdigest()


def test_repeated_rows_null_ids_and_no_rows(spark):
    big = "y" * 2000
    got = W.read_warc(W.write_warc(pages(spark, [(4, "u", big), (4, "u", big), (2, "u", big)]))).filter("last").collect()
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [(2, "revisit"), (4, "response"), (4, "response")]
    got = W.read_warc(W.write_warc(pages(spark, [(None, "u", big), (None, "v", big)]))).filter("last").collect()
    assert [r["record_type"] for r in got] == ["response", "response"]
    assert W.read_warc(W.write_warc(pages(spark, []))).count() == 0


def test_archives_are_gzip_members_of_warc_records(spark):
    index = W.write_warc(pages(spark, [(i, f"http://h/{i}", f"text {i}") for i in range(20)])).collect()
    raw = b"".join(gzip.decompress(open(r["path"].removeprefix("file:"), "rb").read()) for r in index)
    assert raw.count(b"WARC/1.1\r\n") == 20 and raw.count(b"WARC-Type: response\r\n") == 20


def test_segments_and_files_are_split(spark, monkeypatch):
    monkeypatch.setattr(W, "SEGMENT_BYTES", 500)
    monkeypatch.setattr(W, "FILE_BYTES", 2000)
    rows = [(i, f"http://h/{i}", hashlib.sha512(str(i).encode()).hexdigest() * 9) for i in range(30)]
    index = W.write_warc(pages(spark, rows).coalesce(1))
    got = W.read_warc(index)
    assert by_id(got).keys() == set(range(30)) and got.filter("last").count() == 30


def test_a_damaged_payload_is_an_error():
    record = W._Record(100)
    head = W._head({"id": 1, "url": "u", "payload_bytes": 3, "sha1": hashlib.sha1(b"abc").hexdigest(), "refers_to": None}, "d")
    with pytest.raises(ValueError, match="digest"):
        list(record.feed(head + b"abd\r\n\r\n"))
    cut = W._Record(100)
    list(cut.feed(head + b"ab"))
    with pytest.raises(ValueError, match="cut off"):
        list(cut.close())
