import base64
import hashlib

import pytest
from rxcover.llm import warc
from rxcover.session import scratch_path

MARKED = "x" * 50 + "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc" + "WARC/1.1\r\n" * 30
ROWS = [(1, "http://a/1", "<p>é</p>" * 400), (2, None, None), (3, "http://a/ 3\r\nX: y", ""), (4, "u", "<p>é</p>" * 400),
        (5, "WARC/1.1", MARKED), (0, "u", MARKED), (7, "u", "short"), (7, "u", "short"), (None, "u", "short"),
        (None, None, "only"), (8, "u", "\r\n\r\n" * 700)]
SCHEMA = "page_id long, url string, html string, refers_to string"


def brute(rows):
    first = {}
    for i, _, h in rows:
        k = h or ""
        first[k] = min(first.get(k, (True, 0)), (i is None, i or 0))
    seen, out = set(), []
    for i, _, h in rows:
        k = h or ""
        b = k.encode()
        own = first[k] == (i is None, i or 0) and k not in seen
        if own:
            seen.add(k)
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit",
                    None if own or first[k][0] else first[k][1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment,chunk", [(512, 100), (64 * 1024, 8 * 1024), (97, 7)])
def test_round_trip(spark, segment, chunk):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA).repartition(3)
    path = scratch_path(spark, "llm", "warc-test", unique=True)
    got = warc.warc_summary(spark, pages, path, segment_bytes=segment, chunk_bytes=chunk)
    rows = got.collect()
    assert all(r.error is None for r in rows)
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == brute(ROWS)
    texts = {r.payload.decode() for r in warc.read_archives(spark, path).collect() if r.payload is not None}
    assert texts == {r[2] or "" for r in ROWS}


def test_empty(spark):
    path = scratch_path(spark, "llm", "warc-test", unique=True)
    assert warc.warc_summary(spark, spark.createDataFrame([], SCHEMA), path).count() == 0


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(*r, "") for r in ROWS], SCHEMA)
    path = scratch_path(spark, "llm", "warc-test", unique=True)
    got = warc.warc_summary(spark, pages, path, revisit_bytes=100)
    assert sorted(r.page_id for r in got.where("record_type = 'revisit'").collect()) == [4, 5]


def test_damage_is_reported(spark):
    recs = warc.records_of("urn:page:1:X:1", "u", b"a" * 1000, "X", None, 300, 100)
    other = warc.records_of("urn:page:2:Y:1", "u", b"b" * 10, "Y", None, 300, 100)
    path = scratch_path(spark, "llm", "warc-test", unique=True)
    parts = [r.decode() for r in recs[:1] + recs[2:] + other]
    spark.createDataFrame([(p,) for p in parts], "value string").write.option("lineSep", warc.END).text(path)
    got = {r.key: r.error for r in warc.read_archives(spark, path).collect()}
    assert got == {"1": "segments", "2": "digest"}
