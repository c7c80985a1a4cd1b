import gzip
import hashlib

import pytest

from cohortkit.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, digest int"
BIG = "<p>" + "same body é\r\n\r\nWARC/1.1\r\n" * 20


@pytest.fixture(scope="module")
def rows():
    return [(5, "http://a.com/x?y#z", BIG), (3, "http://b.com", BIG), (9, None, BIG), (1, "", "short"), (2, "no url", "short"),
            (4, "http://c.com/a b\r\nX: 1", None), (6, "http://d.com/é", ""), (7, "u", "x" * 99), (8, "u", "x" * 99),
            (10, "u", "y" * 100), (11, "u", "y" * 100), (None, "u", "z" * 200), (12, "u", "\r\n\r\n" * 60), (13, "u", "漢" * 70_000),
            (14, "u", "q" * 300), (14, "u", "q" * 300), (15, "u", "q" * 300)]


def expected(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = first.get(b) if len(b) >= 100 and first.get(b) != i else None
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    assert sorted((tuple(r) for r in warc.op4(df).collect()), key=str) == expected(rows)
    assert warc.op4(df.limit(0)).count() == 0


def test_archives_and_nested_captures(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    warc.write(df, str(tmp_path / "w"))
    recs = [r for f in (tmp_path / "w").glob("*.gz") for r in warc.parse(f.read_bytes())]
    assert len(recs) == 3 * len(rows)
    ids = {f["warc-record-id"] for f, _ in recs}
    assert len(ids) == len(recs)
    assert all(f["warc-concurrent-to"] in ids for f, _ in recs if f["warc-type"] in ("request", "metadata"))
    assert any(f.get("warc-target-uri") == "http://c.com/a%20b%0D%0AX:%201" for f, _ in recs)
    cap = warc.captures(warc.read(spark, str(tmp_path / "w"))).collect()
    assert len(cap) == len(rows) and all(c.request and c.metadata for c in cap)
    full = {c.metadata.fields.get("page-id"): bytes(c.response.payload) for c in cap if c.response.record_type == "response"}
    assert full["13"] == ("漢" * 70_000).encode() and full["3"] == BIG.encode()


def test_members_and_damage():
    rec = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(gzip.compress(rec) + gzip.compress(rec * 2))] == [b"abc"] * 3
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(b"HTTP/1.1 200\r\n\r\n")))
