"""WARC records, the data source and the page archives."""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from check import canonical, same
from ticketloom.llm import queries, warc

RECORDS = [
    ({"WARC-Type": "warcinfo", "WARC-Date": "x"}, b""),
    ({"WARC-Type": "response", "WARC-Record-ID": "a", "WARC-Target-URI": "u" * 9000}, b"hello\r\n\r\nyou" * 5000),
    ({"WARC-Type": "revisit", "WARC-Record-ID": "b"}, b""),
    ({"WARC-Type": "response", "WARC-Record-ID": "c"}, b""),
]


@pytest.mark.parametrize("layout", ["told", "plain", "foreign"])
@pytest.mark.parametrize("payloads", [True, False])
def test_records_come_back(layout, payloads):
    plain = [warc.record_bytes(f, b) for f, b in RECORDS]
    packed = [warc.member(r) for r in plain]
    assert [gzip.decompress(p) for p in packed] == plain
    data = b"".join({"told": packed, "plain": plain, "foreign": [gzip.compress(r) for r in plain]}[layout])
    found = list(warc.read_records(pa.BufferReader(data), warc.Wanted({}, {}), payloads))
    assert [r["record_type"] for r, _ in found] == ["warcinfo", "response", "revisit", "response"]
    assert [b for _, b in found] == [b if payloads else None for _, b in RECORDS]
    only = warc.Wanted({"record_type": {"response"}}, {"record_id": "c"})
    assert [r["record_id"] for r, _ in warc.read_records(pa.BufferReader(data), only, payloads)] == ["c"]


def test_cut_archives_raise():
    data = warc.member(warc.record_bytes(*RECORDS[1]))
    with pytest.raises(ValueError):
        list(warc.read_records(pa.BufferReader(data[: len(data) // 2]), warc.Wanted({}, {}), True))


def test_skipped_payloads_are_not_read():
    """A member whose packed body is broken does no harm while its payload is not wanted."""
    record = warc.record_bytes({"WARC-Type": "response", "WARC-Record-ID": "a"}, bytes(range(256)) * 4000)
    broken = bytearray(warc.member(record))
    broken[-2000:-100] = bytes(1900)
    data = bytes(broken) + warc.member(warc.record_bytes(*RECORDS[3]))
    only = warc.Wanted({"record_id": {"c"}}, {})
    assert [r["record_id"] for r, _ in warc.read_records(pa.BufferReader(data), only, True)] == ["c"]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    warc.register(spark)
    rows = [
        (1, "http://a", "same"),
        (2, "http://b", "same"),
        (3, "http://c\r\nX: y", "ü" * 100_000),
        (4, None, None),
        (5, "http://e", ""),
        (None, "http://f", "same"),
        (None, None, "alone"),
        (7, "http://g", "twice"),
        (7, "http://g", "twice"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("best", F.lit("clash"))
    path = str(tmp_path_factory.mktemp("archive") / "pages")
    warc.archive_pages(pages.repartition(3), path)
    return path


def test_archived_pages(spark, archive):
    found = spark.read.format("warc").option("verify", "true").load(archive).where("record_type <> 'warcinfo'").collect()
    assert len(found) == 9
    by = {}
    for r in found:
        by.setdefault(r["record_id"], []).append(r)
    kinds = {k: sorted(r["record_type"] for r in v) for k, v in by.items()}
    assert kinds == {
        "<urn:record:1>": ["revisit"],
        "<urn:record:2>": ["response"],
        "<urn:record:3>": ["response"],
        "<urn:record:4>": ["revisit"],
        "<urn:record:5>": ["response"],
        "<urn:record:7>": ["response", "response"],
        "<urn:record:none>": ["response", "revisit"],
    }
    assert by["<urn:record:1>"][0]["refers_to"] == "<urn:record:2>" and by["<urn:record:1>"][0]["payload_length"] == 4
    long = by["<urn:record:3>"][0]
    assert bytes(long["payload"]).decode() == "ü" * 100_000 and long["target_uri"] == "http://c  X: y"
    assert long["payload_digest"] == "sha1:" + b32encode(hashlib.sha1(("ü" * 100_000).encode()).digest()).decode()


def test_filters_reach_the_reader(spark, archive):
    reader = warc.WarcReader(archive, {})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    kept = list(
        reader.pushFilters(
            [
                EqualTo(("record_type",), "response"),
                In(("target_uri",), ("http://b", None)),
                StringStartsWith(("date",), "1970"),
                GreaterThan(("payload_length",), 3),
            ]
        )
    )
    assert [type(f) for f in kept] == [GreaterThan]
    found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["record_id"] for r in found] == ["<urn:record:2>"]
    rows = spark.read.format("warc").load(archive).where("record_type = 'response' and target_uri like 'http://b%'")
    assert rows.count() == 1


def test_no_pages_no_files(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.archive_pages(pages, str(tmp_path / "none"))
    assert spark.read.format("warc").load(str(tmp_path / "none")).count() == 0


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    mine, theirs = queries.op10(spark, sf).toPandas(), con.execute(queries.ORACLES["op10_warc"]).df()
    assert sorted(mine.columns) == sorted(theirs.columns) and same(canonical(mine), canonical(theirs)) is None
