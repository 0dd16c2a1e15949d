import hashlib

import pytest

from marlstone.llm import files, warc
from marlstone.session import scratch_path

BIG = "<p>" + "é" * 600 + "</p>"
ROWS = [(1, "http://a/", BIG), (7, "http://b/", BIG), (3, "http://c d/\r\nX: y", BIG), (2, None, "small"), (4, "u", "small"),
        (5, "", None), (6, "u", ""), (8, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 40), (9, "u", "y" * 3_000_000),
        (10, "u", "\n\r\n\r\n"), (11, "u", "z" * 1000), (12, "u", "z" * 1000), (13, "u", "z" * 999), (14, "u", "z" * 999)]
SCHEMA = "page_id long, url string, html string, digest int, path int"


def expected(rows):
    out = []
    for k, _, h in rows:
        raw = (h or "").encode()
        keeper = max(j for j, _, g in rows if (g or "") == (h or ""))
        revisit = len(raw) >= 1000 and keeper != k
        out.append((k, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out)


def written(spark, rows):
    folder = scratch_path(spark, "warc")
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    streams = warc.write_archives(pages, folder)
    return streams, warc.normalise_archives(streams, folder)


def test_round_trip(spark):
    streams, archives = written(spark, ROWS)
    assert sorted(tuple(r) for r in warc.read_archives(archives).collect()) == expected(ROWS)
    for path in streams.collect():
        with files.reading(path.path) as source:
            raw = source.read()
        assert len(list(warc.records_of(warc.inflated(__import__("io").BytesIO(raw))))) > 0
    revisits = [r for r in expected(ROWS) if r[3] == "revisit"]
    assert len(revisits) == 3 and archives.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_empty_table_and_null_ids(spark):
    assert warc.read_archives(written(spark, [])[1]).count() == 0
    rows = [(None, "u", BIG), (None, "u", BIG), (2, "u", "a"), (2, "u", "a")]
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.read_archives(written(spark, rows)[1]).collect())
    assert got == [("2", "response", None)] * 2 + [("None", "response", None)] * 2
    mixed = [(None, "u", BIG), (4, "u", BIG)]
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.read_archives(written(spark, mixed)[1]).collect())
    assert got == [("4", "response", None), ("None", "revisit", 4)]


def test_damage_is_found():
    record = warc.warc_record(1, "u", b"payload", None)
    assert list(warc.records_of([record[:40], record[40:] + record])) == [record, record]
    with pytest.raises(ValueError):
        list(warc.records_of([record[:-3]]))
