import gzip
import glob
import hashlib
import os
from collections import Counter

import pytest

from quarry.llm import warc

TRICKY = "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nbody é你" * 40
ROWS = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\nX: y", TRICKY), (4, "http://a/", TRICKY), (5, "e", None), (6, "e", ""),
        (7, "big", "0123456789" * 5000), (8, "b", "other"), (8, "b", "other"), (None, "n", "<p>x</p>"), (None, "n", "alone")]


def want():
    out = Counter()
    for page, _, html in ROWS:
        payload = (html or "").encode()
        first = min((p for p, _, h in ROWS if (h or "") == (html or "") and p is not None), default=None)
        revisit = page != first
        out[(page, len(payload), warc.base32_sha1(hashlib.sha1(payload).digest()), "revisit" if revisit else "response",
             first if revisit else None, True)] += 1
    return out


@pytest.fixture
def pages(spark):
    rows = [(*r, "extra", 1) for r in ROWS]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, chunk int")


@pytest.mark.parametrize("chunk", [7, 100, 1 << 16])
def test_round_trip(pages, chunk):
    assert Counter(tuple(r) for r in warc.round_trip(pages, chunk).collect()) == want()


def test_chunks_give_the_payloads(spark, pages, tmp_path):
    path = f"{tmp_path}/archive"
    warc.write_warc(pages, path, 64, revisit_bytes=1 << 30)
    rows = warc.read_chunks(spark, path, 64).collect()
    assert max(len(r.data or b"") for r in rows) <= 64
    texts = {}
    for r in sorted(rows, key=lambda r: (r.record_id, r.chunk)):
        texts[r.record_id] = texts.get(r.record_id, b"") + (r.data or b"")
    assert Counter(texts.values()) == Counter((h or "").encode() for _, _, h in ROWS)
    assert {r.record_type for r in rows} == {"response"}


def test_records_end_as_the_format_asks(pages, tmp_path):
    path = f"{tmp_path}/archive"
    warc.write_warc(pages, path, 100, records_per_file=3)
    files = glob.glob(f"{path}/*.gz")
    assert len(files) > 3
    for file in files:
        data = gzip.open(file).read()
        assert not data or data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")


def test_a_small_payload_is_no_revisit(spark, pages, tmp_path):
    path = f"{tmp_path}/archive"
    warc.write_warc(pages, path, 1 << 16, revisit_bytes=20)
    found = warc.records(warc.read_chunks(spark, path)).collect()
    assert all((r.record_type == "revisit") == (r.page_id == 4) for r in found)


def test_damage_is_seen(spark, pages, tmp_path):
    path = f"{tmp_path}/archive"
    warc.write_warc(pages.where("page_id = 8"), path)
    for file in glob.glob(f"{path}/.*.crc"):
        os.remove(file)  # the file system's own checksums
    for file in glob.glob(f"{path}/*.gz"):
        data = gzip.open(file).read()
        with gzip.open(file, "wb") as out:
            out.write(data.replace(b"\r\n\r\nother", b"\r\n\r\nOther"))
    assert not any(r.intact for r in warc.records(warc.read_chunks(spark, path)).collect())


def test_empty_table(pages):
    assert warc.round_trip(pages.where("1 = 0")).collect() == []
