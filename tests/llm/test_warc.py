import hashlib
from collections import defaultdict

import pytest

from tierflow.llm.warc import MAGIC, candidates, reached, read_archives, round_trip, write_archives
from tierflow.session import scratch_path

from .cases import prose

SCHEMA = "page_id long, url string, html string, file string, split string, order string, at string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "f", "s", "o", "a") for i, u, h in rows], SCHEMA).repartition(2)


def brute(rows):
    largest = defaultdict(list)
    for i, _, h in rows:
        largest[h or ""].append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [x for x in largest[h or ""] if x is not None]
        first = max(ids, default=None)
        revisit = len(data) >= 1000 and len(largest[h or ""]) > 1 and first is not None and i != first
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def fake(body):
    return f"{MAGIC}WARC-Type: response\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"


def rows():
    big = "<p>é " + prose(3, 300)
    return [
        (1, "http://a/", "<html>x"),
        (2, "http://b/\r\nX: y", big),
        (3, "http://b/", big),
        (9, None, big),
        (4, "http://c/", None),
        (5, "http://c/", ""),
        (6, "http://d/", "head " + fake("HTTP/1.1 200 OK\r\n\r\nevil") + fake("z") + " tail"),
        (7, "http://e/", MAGIC),
        (8, "http://e/", MAGIC * 3 + "\r\n\r\n" + MAGIC),
        (10, "http://f/", "\r\n\r\n" + prose(4, 8000) + fake("q" * 40_000)),
        (11, "http://g/", "same"),
        (12, "http://g/", "same"),
        (13, "http://h/", fake("w" * 10**6)[: 10**4]),
        *((100 + k, "http://n/", prose(k, 40)) for k in range(60)),
        *((300 + k, "http://copies/", big + "copy") for k in range(40)),
    ]


def told(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip(spark):
    assert told(round_trip(pages(spark, rows()))) == brute(rows())


@pytest.mark.parametrize("size", [700, 5000])
def test_records_across_splits(spark, size):
    path = scratch_path(spark, "archives")
    write_archives(pages(spark, rows()), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert told(read_archives(spark, path)) == brute(rows())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_cut_otherwise_later(spark):
    """Cores that come or go while a query runs change how Spark cuts and packs the files."""
    path = scratch_path(spark, "archives")
    write_archives(pages(spark, rows()), path)
    found = read_archives(spark, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert told(found) == brute(rows())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_payload_bytes_come_back(spark):
    want = {i: (h or "").encode() for i, _, h in rows()}
    for row in round_trip(pages(spark, rows())).collect():
        if row.record_type == "response":
            assert bytes(row.payload) == want[row.page_id]


def test_files_are_archives(spark, tmp_path):
    """A plain sequential reader finds the same records."""
    path = str(tmp_path / "archives")
    write_archives(pages(spark, rows()), path)
    found = []
    for part in (tmp_path / "archives").glob("part-*"):
        data, at = part.read_bytes(), 0
        while at < len(data):
            assert data.startswith(MAGIC.encode(), at)
            end = data.index(b"\r\n\r\n", at)
            fields = dict(line.split(b": ", 1) for line in data[at + len(MAGIC) : end].split(b"\r\n"))
            length = int(fields[b"Content-Length"])
            found.append(int(fields[b"WARC-Record-ID"][10:-1]))
            assert data[end + 4 + length : end + 8 + length] == b"\r\n\r\n"
            at = end + 8 + length
    assert sorted(found) == sorted(i for i, _, _ in rows())


def test_only_chained_candidates_are_reached(spark):
    path = scratch_path(spark, "archives")
    write_archives(pages(spark, rows()), path)
    found = candidates(spark, path)
    assert found.where("next IS NOT NULL").count() > len(rows())  # false ones are candidates too
    assert reached(found).count() == len(rows())


def test_null_ids_repeated_rows_and_empty_table(spark):
    big = prose(8, 400)
    cases = [(None, None, big), (3, "u", big), (3, "u", big), (2, "u", big), (None, "u", "x")]
    assert told(round_trip(pages(spark, cases))) == brute(cases)
    assert round_trip(pages(spark, [])).count() == 0
