import base64
import hashlib
import random

import pytest

from reviewloom.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows):
    """rows: (page_id, html), unique ids -> sorted result rows."""
    first = {}
    for page, html in rows:
        first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, html in rows:
        raw = (html or "").encode()
        one = first[html or ""]
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if one == page else "revisit", None if one == page else one))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(p, u, h, 0, "x") for p, u, h in rows], "page_id long, url string, html string, offset int, file string")


@pytest.fixture()
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def pages():
    rng = random.Random(4)
    rows = []
    for i in range(120):
        body = "".join(rng.choice(["<p>text é</p>\n", FAKE, "WARC/1.1\r\n", "\r\n\r\n", "x" * 400, "漢"]) for _ in range(rng.randrange(0, 9)))
        rows.append((i, rng.choice(["http://a.b/c d\r\nContent-Length: 1", None, "http://x.y/"]), rng.choice([body, body, "copy", None, ""])))
    rows.append((500, "u", "y" * 20_000 + FAKE + "z" * 20_000))
    return rows


def test_round_trip_with_records_inside_payloads(spark, small_blocks):
    rows = pages()
    got = sorted(tuple(r) for r in warc.archived(frame(spark, rows).repartition(3)).collect())
    assert got == expected([(p, h) for p, _, h in rows])


def test_payloads_come_back(spark, small_blocks, tmp_path):
    rows = pages()
    path = str(tmp_path / "w")
    warc.write_warc(frame(spark, rows).repartition(2), path, min_bytes=10**9)
    got = {r["record_id"]: bytes(r["payload"]) for r in warc.read_warc(spark, path, with_payload=True).collect()}
    assert got == {f"<urn:page:{p}>": (h or "").encode() for p, _, h in rows}


def test_whole_blocks(spark):
    rows = pages()
    got = sorted(tuple(r) for r in warc.archived(frame(spark, rows).coalesce(1)).collect())
    assert got == expected([(p, h) for p, _, h in rows])


def test_nulls_repeats_and_empty(spark):
    got = sorted([tuple(r)[:2] + tuple(r)[3:] for r in warc.archived(frame(spark, [(None, None, "a"), (2, None, "a"), (2, None, "a"), (1, None, None)])).collect()], key=str)
    assert got == sorted([(None, 1, "revisit", 2), (2, 1, "response", None), (2, 1, "response", None), (1, 0, "response", None)], key=str)
    assert warc.archived(frame(spark, [])).collect() == []


def test_file_that_begins_with_no_record(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"junk" + FAKE.encode())
    (tmp_path / "b.warc").write_bytes(FAKE.encode() + FAKE.encode()[:60])
    got = [(r["offset"], r["payload_bytes"]) for r in warc.read_warc(spark, str(tmp_path)).collect()]
    assert got == [(0, 5), (len(FAKE), None)]
