import gzip
import hashlib
import io

import duckdb
import pytest

from churnlab.llm.common import mounted, shared_folder
from churnlab.llm.oracle import WARC
from churnlab.llm.warc import ARC_FIELDS, archived, arc_record, arc_version_block, convert, converted, http_response, read_arc, read_warc, read_warcs, revisit_plan, write_arcs

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + "é" * 200 + "</p>"
    rows = [
        (5, "http://a.example/x y", long), (3, "http://b.example/", long), (9, None, long), (3, "http://b.example/", long),
        (1, "http://c.example/ü", None), (2, "", ""), (4, "http://d.example/", "short"), (6, "http://e.example/", "short"),
        (7, "http://f.example/", "\r\n\r\nWARC/1.1\r\n" * 20), (8, "http://g.example/", "filedesc://x 1 2\n" * 10_000),
        (None, "http://h.example/", long), (10, "http://i.example/", "x" * 100), (11, "http://i.example/", "x" * 100), (12, "http://i.example/", "x" * 99), (13, None, "x" * 99),
    ]
    docs = spark.createDataFrame(rows, PAGES).repartition(3)
    for name in ("file", "offset", "digest"):
        docs = docs.withColumn(name, docs["url"])
    return docs


def plain(pages):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first, out, used = {}, [], set()
    for page_id, payload in rows:
        if len(payload) >= 100 and page_id is not None:
            first[payload] = min(first.get(payload, page_id), page_id)
    for page_id, payload in rows:
        is_first = len(payload) < 100 or (page_id == first[payload] and payload not in used)
        if is_first:
            used.add(payload)
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "response" if is_first else "revisit", None if is_first else first[payload]))
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_archive_and_back(pages, version):
    assert sorted(map(tuple, archived(pages, version=version).collect()), key=str) == plain(pages)


def test_matches_sql_on_distinct_ids(spark):
    table = spark.range(300).selectExpr("id as page_id", "concat('http://x.example/', id) as url", "repeat(cast(id % 40 as string), 60) as html")
    pages = table.toPandas()  # noqa: F841
    expected = duckdb.sql(WARC).fetchall()
    assert sorted(map(tuple, archived(table).collect()), key=str) == sorted(expected, key=str)


def test_files_hold_the_payloads(spark, pages):
    home = shared_folder(spark, "test-archive")
    index = write_arcs(pages, f"{home}/arc")
    convert(revisit_plan(index), f"{home}/warc").count()
    records = read_warcs(spark, f"{home}/warc", with_payload=True).collect()
    by_id = {r["record_id"]: r for r in records}
    assert len(by_id) == pages.count()
    for r in records:
        source = r if r["record_type"] == "response" else by_id[r["refers_to"]]
        assert hashlib.sha256(source["payload"]).hexdigest() == r["payload_digest"]
        assert r["date"] == "2024-01-01T00:00:00Z" and " " not in r["target_uri"]
    assert mounted("file:///x%20y") == "/x y"
    with pytest.raises(ValueError):
        mounted("hdfs://x/y")


@pytest.mark.parametrize("version", [1, 2])
def test_header_lines_by_version(version):
    payload = b"body\n\nmore"
    data = arc_version_block("f", version, "20010203") + arc_record(version, "http://x/", "1.2.3.4", "20010203040506", "text/html", http_response(7, payload)) * 2
    records = list(read_arc(io.BytesIO(data)))
    assert [list(h) for _, h, _ in records[1:]] == [ARC_FIELDS[version]] * 2
    offset, header, block = records[2]
    found = list(read_warc(io.BytesIO(converted("f.arc.gz", offset, header, block, None) + converted("f.arc.gz", 0, *records[0][1:], None))))
    assert found[0][0]["warc-date"] == "2001-02-03T04:05:06Z" and found[0][1].endswith(payload)
    assert found[1][0]["warc-type"] == "warcinfo"
    for bad in (data[:-5], data.replace(b"text/html", b"text/html more", 1)):
        with pytest.raises(ValueError):
            list(read_arc(io.BytesIO(bad)))
    assert gzip.decompress(gzip.compress(data)) == data


def test_no_pages(spark):
    assert archived(spark.createDataFrame([], PAGES)).count() == 0
