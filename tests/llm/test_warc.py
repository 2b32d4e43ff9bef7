import gzip
import hashlib
import os
import zlib

import pytest

from tests.compare import connect, difference
from tests.conftest import SF
from tickerloom.llm import queries, warc


def expected(rows):
    """Brute force: payload, digest and role of every (page_id, html)."""
    out, groups = [], {}
    for page_id, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000:
            groups.setdefault(body, []).append(page_id)
    for page_id, html in rows:
        body = (html or "").encode()
        last = max(groups.get(body, [page_id]))
        role = ("response", None) if page_id == last else ("revisit", last)
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), *role))
    return sorted(out)


def got(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    body = "é<p>" * 300
    return [(1, body), (2, body), (9, body), (3, None), (4, ""), (5, "short"), (6, "short"), (7, "x" * 5000), (8, "y" * 999), (10, "y" * 999)]


@pytest.mark.parametrize("step", [7, 64, 1 << 20])
def test_round_trip_at_every_range_size(spark, rows, step, tmp_path):
    pages = spark.createDataFrame([(i, "http://a/\r\nb", h, 1) for i, h in rows], "page_id long, url string, html string, start int")
    assert got(warc.archive_round_trip(spark, pages, step)) == expected(rows)


def test_payloads_come_back(spark, rows, tmp_path):
    pages = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    records = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}/archive"), 50).collect()
    payloads = {r.page_id: bytes(r.payload) for r in records if r.record_type == "response"}
    html = dict(rows)
    assert payloads == {i: (html[i] or "").encode() for i in payloads} and len(payloads) == 8


def test_ties_and_missing_ids(spark):
    body = "z" * 2000
    pages = spark.createDataFrame([(None, "u", body), (None, "u", body), (5, "u", body), (5, "u", body), (4, "u", body)], "page_id long, url string, html string")
    rows = warc.archive_round_trip(spark, pages).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in rows)
    assert kinds == [(0, "response", 0), (0, "response", 0), (4, "revisit", 5), (5, "response", 0), (5, "revisit", 5)]
    assert warc.archive_round_trip(spark, pages.limit(0)).collect() == []


def test_members_inside_members_are_no_records(spark, tmp_path):
    inner = warc.record(77, None, b"inner", None, False)
    stored_only = gzip.compress(b"", 0)    # level 0 keeps bytes as they are
    assert warc.MAGIC in stored_only
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    plain = zlib.decompress(warc.record(1, None, b"A" * 30 + inner + warc.MAGIC + b"B" * 30, None, False), 31)
    outer = packer.compress(plain) + packer.flush()
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"junk" + outer + warc.MAGIC + warc.record(2, None, b"two", None, False))
    manifest = spark.createDataFrame([(str(path), path.stat().st_size, 2)], warc.MANIFEST)
    for step in (1, 5, 40, 1000):
        found = warc.read_archives(manifest, step).orderBy("start").collect()
        assert [(r.page_id, r.payload_bytes) for r in found] == [(1, 63 + len(inner)), (2, 3)]


def test_query_over_tables(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert got(queries.QUERIES["op2_warc"](spark, SF)) == expected(rows)


def test_query_equals_sql(spark):
    assert difference(queries.QUERIES["op2_warc"](spark, SF), connect(SF), queries.ORACLE["op2_warc"]) is None


def member(*lines, body=b"", level=6):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(("WARC/1.0", *lines)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def manifest_of(spark, path):
    return spark.createDataFrame([(str(path), path.stat().st_size, 0)], warc.MANIFEST)


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    sha = hashlib.sha1(b"abc").hexdigest()
    good = [
        member("WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:1>", "Content-Length: 9", body=b"software:"),
        member("WARC-Type: request", "WARC-Record-ID: <urn:uuid:2>", "Content-Length: 18", body=b"GET / HTTP/1.1\r\n\r\n"),
        member("WARC-Type: response", "WARC-Record-ID: <urn:uuid:3>", f"Content-Length: {len(http)}", body=http),
        member("WARC-Type: response", f"Content-Length: {len(http)}", body=http),                                       # no id
        member("WARC-Type: revisit", "WARC-Record-ID: <urn:page:x>", "WARC-Refers-To: <urn:uuid:3>", "Content-Length: 0"),   # no digest
        member("warc-type: revisit", "WARC-Record-ID: <urn:page:7>", f"WARC-Payload-Digest: SHA1:{sha.upper()}", f"content-length: {len(http) - 3}", body=http[:-3]),
        member("WARC-Record-ID: <urn:uuid:4>", "Content-Length: 2", body=b"no"),                                         # no type
    ]
    broken = [
        member("WARC-Type: response", "Content-Length: twelve", body=b"x"), member("WARC-Type: response", "Content-Length: 99", body=b"short"),
        member("WARC-Type: response", body=b"no length"), gzip.compress(b"other content"), member("Content-Length: 1", body=b"x")[:-6], b"\x1f\x8b\x08junk",
    ]
    path = tmp_path / "foreign.warc.gz"
    path.write_bytes(b"".join(x for pair in zip(good, [*broken, b""], strict=True) for x in pair))
    for step in (3, 100, 1 << 20):
        records = warc.read_archives(manifest_of(spark, path), step)
        rows = records.orderBy("start").collect()
        assert [(r.record_id, r.page_id, r.record_type, r.payload_bytes, r.refers_id, r.refers_to) for r in rows] == [
            ("urn:uuid:1", None, "warcinfo", 9, None, None), ("urn:uuid:2", None, "request", 0, None, None),
            ("urn:uuid:3", None, "response", 3, None, None), (None, None, "response", 3, None, None),
            ("urn:page:x", None, "revisit", None, "urn:uuid:3", None), ("urn:page:7", 7, "revisit", 3, None, None),
            ("urn:uuid:4", None, None, 2, None, None)]
        assert [r.payload_digest for r in rows][2:6] == [sha, sha, None, sha]
        held = warc.coverage(manifest_of(spark, path), records).first()
        assert (held.records, held.skipped_bytes) == (7, sum(map(len, broken)))


def test_reading_tasks_follow_the_ranges(spark, rows, tmp_path):
    pages = spark.createDataFrame([(i, None, h) for i, h in rows * 20], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, f"file://{tmp_path}/archive")
    total = sum(r.bytes for r in manifest.collect())
    plan = warc.read_archives(manifest, 100)._jdf.queryExecution().executedPlan().toString()
    wanted = min(-(-total // 100), 2 * spark.sparkContext.defaultParallelism)
    assert f", {wanted}), REPARTITION_BY_NUM" in plan


def test_one_very_long_record(tmp_path):
    body = os.urandom(48 << 20)                            # does not compress: the reader holds it once
    path = tmp_path / "long.warc.gz"
    path.write_bytes(warc.record(1, None, b"first", None, False) + warc.record(2, None, body, None, False) + warc.record(3, None, b"last", None, False))
    size = path.stat().st_size
    found = [r for at in range(0, size, 16 << 20) for r in warc.read_range(str(path), at, min(at + (16 << 20), size), size)]
    assert [(r[2], r[4]) for r in found] == [("urn:page:1", 5), ("urn:page:2", 48 << 20), ("urn:page:3", 4)]
    assert found[1][5] == hashlib.sha1(body).hexdigest()


def test_extra_columns_with_clashing_names(spark):
    pages = spark.createDataFrame([(1, "u", "a" * 1200, "d", 5, 6), (2, "u", "a" * 1200, "d", 5, 6)],
                                  "page_id long, url string, html string, digest string, refers_to long, n int")
    assert got(warc.archive_round_trip(spark, pages)) == expected([(1, "a" * 1200), (2, "a" * 1200)])
