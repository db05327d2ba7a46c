import base64
import gzip
import hashlib
import random

from tipscope.llm import warc

PAGES = "page_id long, url string, html string, record_type string"


def pages(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h{i % 7}.org/{i}", "<p>" + "x" * rng.randrange(0, 3000) + str(rng.randrange(40)), "z") for i in range(200)]
    rows += [(i, f"https://copy.org/{i}", "<b>hot</b>é", None) for i in range(300, 420)]
    rows += [(500, None, None, None), (501, "", "", None), (502, "http://a b\r\nX: y", "<i>\r\n\r\nWARC/1.1\r\n", None),
             (503, "http://long.org/" + "p" * 20_000, "y" * 400_000, None)]
    return rows, spark.createDataFrame(rows, PAGES).repartition(6)


def expected(rows, least):
    first = {}
    for i, _, html, _ in sorted(rows, key=lambda r: r[0]):
        first.setdefault((html or "").encode(), i)
    out = {}
    for i, _, html, _ in rows:
        body = (html or "").encode()
        to = first[body] if len(body) >= least and first[body] != i else None
        out[i] = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if to is None else "revisit", to)
    return out


def test_round_trip(spark):
    rows, df = pages(spark)
    for least in (0, 10):
        folder, manifest = warc.write_archives(df, min_revisit_bytes=least)
        got = warc.read_archives(spark, folder).collect()
        assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == expected(rows, least)
        assert len(got) == len(rows) == manifest.agg({"records": "sum"}).first()[0]
        bodies = {i: (h or "").encode() for i, _, h, _ in rows}
        assert all(r.payload_ok and bytes(r.payload) == bodies[r.page_id] for r in got if r.record_type == "response")
        assert all(r.payload is None for r in got if r.record_type == "revisit")
        assert {r.page_id: r.url for r in got}[3] == "http://h3.org/3"


def test_predicates_are_pushed_and_payloads_skipped(spark):
    rows, df = pages(spark)
    folder, _ = warc.write_archives(df, max_file_bytes=2000)
    found = warc.read_archives(spark, folder, payload="skip").where("record_type = 'revisit' AND page_id > 350 AND url LIKE 'https%'")
    assert "Filter (" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.page_id for r in found.collect()) == list(range(351, 420))
    some = warc.read_archives(spark, folder, payload="skip").where("refers_to IS NULL AND record_type IN ('response') AND NOT url = 'http://h1.org/1'")
    want = {i for i, (*_, kind, _) in expected(rows, 0).items() if kind == "response"} - {1, 500}
    assert {r.page_id for r in some.collect()} == want
    assert all(r.payload is None and r.payload_ok is None for r in some.collect())


def test_any_gzip_reader_reads_the_archives(spark):
    rows, df = pages(spark)
    folder, manifest = warc.write_archives(df)
    text = b"".join(gzip.open(r.uri.removeprefix("file://")).read() for r in manifest.collect())
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)


def test_members_without_the_length_field(tmp_path, spark):
    one = warc.record(1, "http://a/", b"<p>1", None, "2026-01-01T00:00:00Z")
    two = warc.record(2, "http://b/", b"<p>1", 1, "2026-01-01T00:00:00Z")
    (tmp_path / "other.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    got = warc.read_archives(spark, f"file://{tmp_path}").orderBy("page_id").collect()
    assert [(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got] == [(1, "response", None, 4), (2, "revisit", 1, 4)]


def test_repeated_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "u", "a"), (1, "v", "a"), (1, "w", "a"), (2, "x", "a"), (None, None, "b"), (None, None, "b")],
                               "page_id long, url string, html string")
    folder, _ = warc.write_archives(df)
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.read_archives(spark, folder).collect())
    assert got == [("1", "response", None), ("1", "response", None), ("2", "revisit", 1), ("None", "response", None),
                   ("None", "response", None), ("None", "revisit", 1)]
    folder, _ = warc.write_archives(df.limit(0))
    assert warc.read_archives(spark, folder).count() == 0


def test_files_of_other_attempts_are_not_read(spark):
    """One task runs twice in different row order, and one attempt stops midway: every record is read once."""
    rows, df = pages(spark)
    folder, manifest = warc.write_archives(df, max_file_bytes=3000)
    # further attempts of the same tasks, whose manifest is never committed
    again = df.selectExpr("page_id", "url", "html", "cast(null as long) as refers_to").orderBy("url", ascending=False).coalesce(6)
    again.mapInArrow(warc._write(folder, "2026-01-01T00:00:00Z", 3000), "uri string, records long, bytes long").collect()
    base = folder.removeprefix("file://")
    torn = manifest.first()["uri"].removeprefix("file://")
    with open(torn, "rb") as f, open(f"{base}/part-000000-0000-torn.warc.gz", "wb") as out:
        out.write(f.read()[:50])
    got = warc.read_archives(spark, folder).collect()
    assert sorted(r.page_id for r in got) == sorted(r[0] for r in rows)
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == expected(rows, 0)


def test_plain_files_and_a_large_payload(tmp_path, spark):
    big = bytes(range(256)) * 40_000
    records = [warc.record(1, "http://a/", b"<p>1\r\n\r\n2", None, "2026-01-01T00:00:00Z"), warc.record(2, "http://b/", big, None, "2026-01-01T00:00:00Z"),
               warc.record(3, "http://c/", b"<p>1", 1, "2026-01-01T00:00:00Z"), warc.record(4, "http://d/", b"", None, "2026-01-01T00:00:00Z")]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    got = warc.read_archives(spark, f"file://{tmp_path}").collect()
    for page_id, body in ((1, b"<p>1\r\n\r\n2"), (2, big), (4, b"")):
        assert [bytes(r.payload) == body and r.payload_ok for r in got if r.page_id == page_id] == [True, True]
    assert [(r.record_type, r.refers_to, r.payload) for r in got if r.page_id == 3] == [("revisit", 1, None)] * 2
    found = warc.read_archives(spark, f"file://{tmp_path}", payload="skip").where("record_type = 'revisit'").collect()
    assert [r.page_id for r in found] == [3, 3]
