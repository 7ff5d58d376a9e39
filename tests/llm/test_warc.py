import base64
import gzip
import hashlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNull, Not, StringStartsWith

from routelytics.llm import warc as q
from routelytics.llm.queries import ORACLE_SQL

PAGES = "page_id long, url string, html string"


def rows():
    same = "<p>same é</p>"
    out = [(i, f"http://x/{i}", f"<p>page {i}</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n") for i in range(20)]
    out += [(100 + i, None, same) for i in range(7)] + [(200, "u\r\nX: y", None), (201, "u", ""), (202, "", None)]
    out += [(300, "long", "z" * 3_000_000), (4, "again", out[4][2])]
    return out


def want(table):
    last = {}
    for i, _, h in table:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in table:
        b, top = (h or "").encode(), last.get(h or "")
        first, sha1 = top is None or i == top, base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), sha1, *(("response", None, len(b), sha1) if first else ("revisit", top, None, None))))
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r[:2]) + (r[3],)


@pytest.mark.parametrize("options", [{}, {"compression": "gzip"}, {"file_bytes": 2000, "stretch_bytes": 500}])
def test_round_trip(spark, tmp_path, options):
    table = rows() + [(None, "nameless", "<p>alone</p>"), (None, "nameless", "<p>same é</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in table], PAGES + ", payload string").repartition(5)
    path = f"file://{tmp_path}/w"
    q.write_pages(pages, path, **options)
    got = [tuple(r) for r in q.page_records(spark, path).collect()]
    assert sorted(got, key=key) == sorted(want(table), key=key)
    full = {r.record_id: r for r in q.read_warc(spark, path).collect()}
    html = {i: h for i, _, h in table}
    for i, h in html.items():
        if i is not None:
            r = full[f"urn:x-page:{i}"]
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == (h or "").encode()
    assert full["urn:x-page:200"].target_uri == "u%0D%0AX: y" and full["urn:x-page:100"].target_uri is None


def test_filters_reach_the_headers(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    q.write_pages(spark.createDataFrame(rows(), PAGES), path)
    got = q.read_warc(spark, path).filter((F.col("record_type") == "revisit") & F.col("refers_to").isNotNull()
                                          & F.col("record_id").startswith("urn:x-page:10")).collect()
    assert sorted(r.record_id for r in got) == [f"urn:x-page:{i}" for i in range(100, 106)]
    assert q.read_warc(spark, path).filter("payload_bytes = 0 AND record_type <> 'revisit'").count() == 1
    reader = q.WarcReader(path, None)
    filters = [EqualTo(("record_type",), "response"), EqualTo(("payload_bytes",), 3), In(("date",), ("a", "b")),
               Not(IsNull(("target_uri",))), Not(EqualTo(("target_uri",), "u"))]
    assert list(reader.pushFilters(filters)) == [filters[1]] and len(reader.filters) == 4


def test_null_semantics_of_header_tests():
    row = dict.fromkeys(q._TESTABLE)
    assert not q.header_test(EqualTo(("target_uri",), "a"))(row)
    assert not q.header_test(Not(EqualTo(("target_uri",), "a")))(row)
    assert not q.header_test(Not(StringStartsWith(("target_uri",), "a")))(row)
    assert q.header_test(IsNull(("target_uri",)))(row) and not q.header_test(Not(IsNull(("target_uri",))))(row)


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def test_unwanted_payloads_are_not_read():
    base = {"record_type": "response", "target_uri": "u", "date": "d", "payload_digest": None, "refers_to": None,
            "content_type": None, "payload_bytes": None}
    data = b"".join(q._record(base | {"record_id": f"r{i}", "payload": b"x" * 40_000_000}) for i in range(3))
    f = Counting(data)
    got = list(q.read_records(q._Source(f, 0), None, [q.header_test(EqualTo(("record_id",), "r2"))], True, False))
    assert [r["record_id"] for r in got] == ["r2"] and got[0]["payload_bytes"] == 40_000_000 and f.taken < len(data) / 10
    assert [len(r["payload"]) for r in q.read_records(q._Source(Counting(data), 0), None, [], True, True)] == [40_000_000] * 3


def test_foreign_files(spark, tmp_path):
    """Folded headers, other record types and block kinds, one gzip member for all records, no manifest."""
    block = b"software: x\r\n"
    raw = (b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Type: application/warc-fields\r\n"
           b"X-Note: one\r\n two\r\nContent-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
           b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:b>\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(raw)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "c.txt").write_bytes(b"no archive")
    got = q.read_warc(spark, f"file://{tmp_path}").orderBy("record_id").collect()
    assert [(r.record_id, r.record_type, bytes(r.payload)) for r in got] == [
        ("urn:a", "warcinfo", block)] * 2 + [("urn:b", "resource", b"")] * 2
    (tmp_path / "d.warc").write_bytes(raw[:-40])
    with pytest.raises(Exception, match="ends inside"):
        q.read_warc(spark, f"file://{tmp_path}/d.warc").collect()


def test_only_committed_files_count(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    q.write_pages(spark.createDataFrame(rows()[:3], PAGES), path)
    (tmp_path / "w" / "part-stray.warc").write_bytes(b"left by a lost attempt")
    assert q.page_records(spark, path).count() == 3
    q.write_pages(spark.createDataFrame(rows()[3:5], PAGES), path)
    assert q.page_records(spark, path).count() == 5


def test_empty_table(spark, tmp_path):
    assert q.digest(spark.createDataFrame([], PAGES), f"file://{tmp_path}").collect() == []


def test_query_matches_plain_python(spark, tmp_path):
    got = q.digest(spark.createDataFrame(rows(), PAGES), f"file://{tmp_path}").collect()
    assert sorted(map(tuple, got), key=key) == sorted(want(rows()), key=key)


def test_damaged_payloads_show(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    q.write_pages(spark.createDataFrame([(1, "u", "<p>sound</p>"), (2, "u", "<p>damaged</p>")], PAGES).coalesce(1), path)
    [name] = (tmp_path / "w").glob("*.warc")
    name.write_bytes(name.read_bytes().replace(b"<p>damaged", b"<p>dXmaged"))
    got = {r.page_id: r for r in q.page_records(spark, path).collect()}
    assert got[1].stored_digest == got[1].payload_digest
    assert got[2].stored_digest != got[2].payload_digest and got[2].stored_bytes == got[2].payload_bytes


def test_gzip_files_are_planned_in_stretches(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    table = [(i, "u", f"<p>page {i}</p>" * 50) for i in range(60)]
    q.write_pages(spark.createDataFrame(table, PAGES).coalesce(1), path, compression="gzip", stretch_bytes=1000)
    found = q.read_warc(spark, path, "record_id string, payload binary")
    assert found.rdd.getNumPartitions() > 5
    assert sorted((r.record_id, bytes(r.payload).decode()) for r in found.collect()) == sorted(
        (f"urn:x-page:{i}", h) for i, _, h in table)


def test_http_block_without_a_blank_line():
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:{}>\r\nContent-Type: application/http\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    raw = "".join(head.format(i, len(b), b) for i, b in enumerate(["HTTP/1.1 200 OK\r\nno end", "", "HTTP/1.1 200 OK\r\n\r\nbody"]))
    for payload in (True, False):
        got = list(q.read_records(q._Source(io.BytesIO(raw.encode()), 0), None, [], True, payload))
        assert [r["payload_bytes"] for r in got] == [23, 0, 4]
        assert [r["payload"] for r in got] == ([b"HTTP/1.1 200 OK\r\nno end", b"", b"body"] if payload else [None] * 3)


def test_sql_twin():
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows()[:-1])
    got = con.execute(ORACLE_SQL["op8_warc"]).fetchall()
    assert sorted(got, key=key) == sorted(want(rows()[:-1]), key=key)


def test_archives_of_the_query_are_smaller_than_the_pages(spark, tmp_path):
    """Archives stay on disk with the result, so they are compressed; payloads come back whole."""
    pages = [(i, "u", f"<html><p>{i}</p>" + "<p>the same words again and again</p>" * 200) for i in range(50)]
    got = {r.page_id: r for r in q.digest(spark.createDataFrame(pages, PAGES), f"file://{tmp_path}").collect()}
    held = sum(f.stat().st_size for f in tmp_path.rglob("*.warc*") if f.is_file())
    assert 0 < held < sum(len(p[2]) for p in pages) / 4
    for i, _, html in pages:
        sha1 = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert (got[i].payload_bytes, got[i].stored_bytes, got[i].stored_digest) == (len(html), len(html), sha1)
