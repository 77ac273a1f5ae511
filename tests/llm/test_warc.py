import base64
import gzip
import hashlib
from collections import Counter
from glob import glob

import pytest

from millrace.llm import warc

PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/\r\nX-Page: 99", "<p>one</p>"), (3, None, "<p>ünï \r\n\r\nWARC/1.1\r\n two"), (4, "u", None), (5, "u", ""), (None, "n", "<p>one</p>"),
    (7, "v", "only"), (8, "w", "twice"), (8, "w", "twice"), (9, "z", "x" * 300_000), (10, "z", "x" * 300_000),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages(spark, rows=PAGES):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit("x").alias(c) for c in ("digest", "key", "pid", "nth", "value")])


def test_round_trip(spark):
    path = warc.write_archives(pages(spark))
    got = warc.resolve_revisits(warc.read_archives(spark, path)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in got) == Counter((p, len((h or "").encode()), digest(h), (h or "").encode()) for p, _, h in PAGES)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([
        ("1", "revisit", 2), ("2", "response", None), ("3", "response", None), ("4", "revisit", 5), ("5", "response", None), ("None", "revisit", 2), ("7", "response", None),
        ("8", "response", None), ("8", "revisit", 8), ("9", "revisit", 10), ("10", "response", None),
    ])
    assert len({r.record_id for r in got}) == len(PAGES)


def test_records_are_well_formed(spark):
    path = warc.write_archives(pages(spark))
    seen = 0
    for f in glob(f"{path.removeprefix('file:')}/part-*"):
        data = gzip.open(f).read()
        found = list(warc.parse_archive(data))
        seen += len(found)
        assert data.count(b"WARC-Type: revisit\r\n") == sum(r["record_type"] == "revisit" for r in found)
        if data:
            with pytest.raises(ValueError):
                list(warc.parse_archive(data[:-5]))
    assert seen == len(PAGES)


def test_each_record_is_a_member(spark):
    import zlib

    path, seen = warc.write_archives(pages(spark)), 0
    for f in glob(f"{path.removeprefix('file:')}/part-*"):
        rest = open(f, "rb").read()
        while rest:
            one = zlib.decompressobj(31)
            assert len(list(warc.parse_archive(one.decompress(rest)))) == 1
            rest, seen = one.unused_data, seen + 1
    assert seen == len(PAGES)


def test_long_records_end_in_a_zero_byte():
    import pyarrow as pa

    text = "x" * (17 << 20)
    (got,) = warc._members(iter([pa.RecordBatch.from_arrays([pa.array([text])], names=["value"])]))
    assert gzip.decompress(got.column(0).buffers()[2].to_pybytes() + b"\0") == text.encode()


def test_many_revisits_of_one_response(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_ROWS", 3)
    rows = [(i, "u", "the same") for i in range(40)] + [(100 + i, "u", f"own {i}") for i in range(5)]
    got = warc.resolve_revisits(warc.read_archives(spark, warc.write_archives(pages(spark, rows)))).collect()
    assert Counter((r.page_id, bytes(r.payload).decode()) for r in got) == Counter((i, h) for i, _, h in rows)


def test_small_payloads_stay_responses(spark):
    got = warc.read_archives(spark, warc.write_archives(pages(spark), min_bytes=8), payloads=False)
    assert {r.page_id for r in got.filter("record_type = 'revisit'").collect()} == {None, 1, 9}


def test_empty_table(spark):
    path = warc.write_archives(pages(spark, PAGES[:1]).limit(0))
    assert warc.resolve_revisits(warc.read_archives(spark, path)).count() == 0
