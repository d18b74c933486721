import gzip
import hashlib
import io
import zlib

import duckdb
import pytest

from faremill.llm import warc
from faremill.llm.oracles import ORACLES
from faremill.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, digest string"


def digest(text):
    return hashlib.sha1((text or "").encode()).hexdigest()


def archive(pages):
    return [warc.record(i, f"http://x/{i}", text.encode(), digest(text)) for i, text in pages]


def test_every_split_gives_every_record_once():
    data = b"".join(archive([(i, "page %d " % i * (i * 37 % 50)) for i in range(40)]))
    whole = [r[0] for r in warc.records_in(io.BytesIO(data), 0, len(data))]
    assert len(whole) == 40
    for size in (1, 2, 3, 100, 777, len(data) - 1):
        starts = range(0, len(data), size) if size > 50 else range(0, 600, size)
        end = len(data) if size > 50 else 600
        found = [r[0] for s in starts for r in warc.records_in(io.BytesIO(data), s, min(s + size, end))]
        assert found == [at for at in whole if at < end]


def test_damage_costs_the_damaged_record_only():
    members = archive([(i, "some text %d " % i * 40) for i in range(5)])
    members[2] = members[2][:20] + b"\x00" * 30 + members[2][50:]
    noise = b"\x1f\x8b\x08 no member \x1f\x8b" + gzip.compress(b"a member, no record") + warc.MAGIC
    data = noise + b"".join(members) + b"\x1f\x8b"
    found = [warc._bare(h["warc-record-id"]) for _, h, _, _ in warc.records_in(io.BytesIO(data), 0, len(data))]
    assert found == [warc.page_urn(i) for i in (0, 1, 3, 4)]


def test_records_are_standard_gzip_members():
    text = "<html>é</html>"
    headers, http, payload = warc.parsed(zlib.decompress(warc.record(7, "http://x/\r\nWARC-Type: evil", text.encode(), digest(text)), wbits=31))
    assert payload.decode() == text and headers["warc-type"] == "response" and http["content-length"] == str(len(text.encode()))
    assert headers["warc-target-uri"] == "http://x/%0D%0AWARC-Type: evil"


def test_equal_payloads_refer_to_the_largest_page(spark):
    long, short = "x" * 1000, "y" * 999
    rows = [(1, "u", long, "a"), (9, "u", long, "b"), (9, "u", long, "b"), (4, None, long, None), (2, "u", short, ""), (3, "u", short, ""),
            (5, "u", None, ""), (None, "u", long, ""), (6, "u", "é" * 500, ""), (8, "u", "é" * 500, "")]
    found = sorted(map(tuple, warc.page_records(spark.createDataFrame(rows, SCHEMA), range_bytes=200).collect()), key=str)
    kept = {long: 9, "é" * 500: 8}
    expected = []
    for page, _, html, _ in rows:
        to = kept.get(html)
        revisit = to is not None and to != page
        expected.append((page, len((html or "").encode()), digest(html), "revisit" if revisit else "response", to if revisit else None))
    assert found == sorted(expected, key=str)


def test_payloads_of_several_files_come_back(spark):
    rows = [(i, f"http://x/{i}", "<p>%d</p>" % i * 300, "") for i in range(50)] + [(99, "u", "long " * 400_000, "")]
    files = warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(3), _folder(spark), file_bytes=1000)
    assert files.count() > 3
    found = warc.read_warc(spark, files, range_bytes=500, payloads=True).collect()
    assert {(r.uri, r.payload.decode()) for r in found} == {(r[1], r[2]) for r in rows} and len(found) == len(rows)


def _folder(spark):
    from faremill.session import scratch_path
    return scratch_path(spark, "warc-test")


def test_no_rows(spark):
    assert warc.page_records(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("path", ["/root/testdata/sf0.01"])
def test_query_against_sql(spark, path):
    with duckdb.connect() as connection:
        connection.sql(f"CREATE VIEW pages AS SELECT * FROM '{path}/pages.parquet'")
        expected = sorted(connection.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({ORACLES['op5_warc']})").fetchall())
    assert sorted(map(tuple, QUERIES["op5_warc"](spark, path).collect())) == expected
