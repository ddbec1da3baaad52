"""Archives round trip, their index against a sort in memory, and the SQL twin."""

from __future__ import annotations

import glob
import gzip
import hashlib
import random
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.llm import queries, sql, warc
from lodestone.session import shared_dir

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"
SAME, BLANK = "<p>same</p>" * 20, "\r\n\r\nWARC/1.1\r\n\r\n" * 10
ODD = [
    (7, "http://B.example.com/x", SAME), (3, "http://b.example.com/x", SAME), (3, "http://b.example.com/x", SAME), (None, None, SAME),
    (11, "no scheme", "short"), (12, "no scheme", "short"), (13, "http://a.b/\r\nX: y", None), (14, "", ""), (15, "http://é.fr?q#f", BLANK),
    (16, "http://c.d", BLANK), (None, "http://c.d", "é" * 50), (None, "http://c.d", "é" * 50), (20, "http://c.d", "x" * 99), (21, "http://c.d", "x" * 99),
    (22, "http://c.d", "y" * 400_000), *[(100 + i, "http://hot.org/", f"<i>{i % 7}</i>" * 30) for i in range(300)],
]


def wanted(rows):
    first = {}
    for r in rows:
        body = r[2] or ""
        if r[0] is not None and len(body.encode()) >= 100:
            first[body] = min(first.get(body, r[0]), r[0])
    out = []
    for r in rows:
        body = r[2] or ""
        at = first.get(body)
        again = at is not None and r[0] != at
        out.append((r[0], len(body.encode()), hashlib.sha256(body.encode()).hexdigest(), "revisit" if again else "response", at if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(6).withColumns({"first": F.lit(1), "payload_digest": F.lit("x"), "position": F.lit("x")})


@pytest.mark.parametrize("small", [True, False])
def test_pages_come_back(spark, pages, small, monkeypatch):
    if not small:
        monkeypatch.setattr(warc, "is_small", lambda df: False)
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    rows = warc.archived(pages, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == wanted(ODD)
    # one order over all runs, without gaps
    rows.sort(key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(len(ODD)))
    assert [tuple(r)[:5] for r in rows] == [tuple(r)[:5] for r in sorted(rows, key=lambda r: warc._order(tuple(r)))]
    # an entry's place leads to its record
    files = {f.rpartition("/")[2]: gzip.open(f).read() for f in glob.glob(f"{path.removeprefix('file:')}/*.gz")}
    bodies = {i: h or "" for i, _, h in ODD}
    for r in rows:
        record = files[r.archive][r.offset : r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and record.endswith(b"\r\n\r\n")
        if r.record_type == "response" and r.page_id is not None:
            assert record[:-4].endswith(b"\r\n\r\n" + bodies[r.page_id].encode())


def test_many_ranges_and_one_hot_url(spark, pages):
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    warc.write(pages, path)
    entries = warc.runs(spark, path)
    whole, cut = (sorted((r.position, *warc._order(tuple(r[c] for c in ("url_key", "captured", "page_id", "archive", "offset")))) for r in warc.merged(entries, n).collect()) for n in (1 << 20, 16))
    assert whole == cut and len(cut) == len(ODD)
    # the hot URL has captures in many ranges
    assert len(warc._splitters(entries, 20)) == 19
    assert sum(k[0] == "org,hot)/" for k in warc._splitters(entries, 20)) > 10


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        lists = [sorted((rng.randrange(9), rng.random()) for _ in range(rng.randrange(7))) for _ in range(k)]
        got = list(warc.LoserTree(lists, lambda e: e[0]))
        assert [e[0] for e in got] == sorted(e[0] for x in lists for e in x) and sorted(got) == sorted(e for x in lists for e in x)


def test_broken_archives_are_refused():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:%s\r\nContent-Length: 40\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    right = good % hashlib.sha256(b"hi").hexdigest().encode()
    assert [e[2] for e in warc.parse("a", right)] == [1]
    for bad in (right[:-3], right.replace(b"\r\nhi", b"\r\nho"), right.replace(b"WARC/1.1", b"WORC/1.1")):
        with pytest.raises(ValueError):
            list(warc.parse("a", bad))


def test_no_pages(spark, pages):
    assert warc.archived(pages.where("false")).collect() == []


def test_sql_twin(spark):
    got = {tuple(r) for r in queries.op11_warc(spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    assert got == set(con.execute(sql.OP11).fetchall())
