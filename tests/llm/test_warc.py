import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest

from courtside.llm import warc as W

LONG = "x" * 999
ROWS = [
    (1, "http://a/1", "page"), (2, "http://a/2", "page"), (3, "http://b/ c\n", LONG + "é"), (9, "http://b/2", LONG + "é"), (4, None, LONG + "é"),
    (5, "u", None), (6, "u", ""), (7, "u", LONG), (8, "u", LONG), (10, "u", "a\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 400), (11, "u", "é" * 100_000),
    (None, "u", "n" * 2000), (12, "u", "n" * 2000), *((k, "u", "hot" * 500) for k in range(100, 200)),
]


def brute(rows):
    top = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000:
            top[html] = max(top.get(html, -1), -1 if i is None else i)
    out = Counter()
    for i, _, html in rows:
        raw, first = (html or "").encode(), top.get(html)
        revisit = first is not None and first != (-1 if i is None else i)
        out[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None, True] += 1
    return out


def pages(llm, rows):
    return llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS name", "2 AS first")


@pytest.mark.parametrize("segment_bytes", [100, 16 << 10])
def test_same_as_brute_force(llm, tmp_path, segment_bytes):
    W.write(pages(llm, ROWS), f"{tmp_path}/w", segment_bytes=segment_bytes)
    found = W.page_records(W.read(llm, f"{tmp_path}/w")).collect()
    assert Counter(tuple(r) for r in found) == brute(ROWS)


def test_archives_are_well_formed(llm, tmp_path):
    W.write(pages(llm, ROWS[:8]), f"{tmp_path}/w", segment_bytes=500)
    kinds = Counter()
    for file in Path(f"{tmp_path}/w").glob("*.gz"):
        raw = gzip.decompress(file.read_bytes())
        assert raw.endswith(W.ENDS) and raw.startswith(b"WARC/1.1\r\nWARC-Type: ")
        for r in W.records(raw):
            kinds[r["kind"]] += 1
            assert (r["kind"] == "continuation") == (r["segment"] > 1)
    assert kinds["response"] + kinds["revisit"] == 8 and kinds["continuation"] > 0


def test_repeated_rows_and_no_rows(llm, tmp_path):
    rows = [(1, "u", "y" * 3000)] * 3 + [(2, "u", "z" * 50)] * 2
    W.write(pages(llm, rows), f"{tmp_path}/w", segment_bytes=1000)
    found = Counter((r.page_id, r.payload_bytes, r.record_type, r.intact) for r in W.page_records(W.read(llm, f"{tmp_path}/w")).collect())
    assert found == {(1, 3000, "response", True): 3, (2, 50, "response", True): 2}
    W.write(pages(llm, []), f"{tmp_path}/e")
    assert W.page_records(W.read(llm, f"{tmp_path}/e")).count() == 0


def test_broken_records_are_told():
    payload = b"abc" * 100
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<urn:courtside:page:5:x>", "WARC-Target-URI": "u", "WARC-Payload-Digest": W._label(hashlib.sha1(payload).hexdigest())}
    parts = [next(W.records(r + W.ENDS)) for r in W.segments(fields, W.HTTP + W.chunked(payload, 7), 90)]
    assert W.reassembled(parts[::-1])[0]["payload"] == payload
    for broken in (parts[1:], parts[:-1], [p for p in parts if p["segment"] != 2]):
        row = W.reassembled(broken)[0]
        assert row["payload"] is None and not row["intact"] and row["page_id"] == 5
    for framing in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b""):
        with pytest.raises(ValueError):
            W.unchunked(framing)
    assert W.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    assert W.http_payload(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nplain") == b"plain"


def test_rows_that_refer_to_nothing_are_not_joined(llm, tmp_path):
    W.write(pages(llm, ROWS), f"{tmp_path}/w")
    plan = W.page_records(W.read(llm, f"{tmp_path}/w"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "isnotnull(refers" in plan and "isnull(refers" in plan
