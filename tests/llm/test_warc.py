from __future__ import annotations

import base64
import hashlib
from collections import defaultdict

import pytest
import zstandard
from llm_cases import prose
from pyspark.sql import types as T

from opinara.llm import warc

PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("digest", "payload", "first_id")]
)
ROWS = [
    (5, "http://a/", "<p>é"),
    (3, "http://b/ x\r\nX-Bad: 1", "<p>é"),
    (9, None, "<p>é"),
    (None, "http://d/", "<p>é"),
    (4, "http://e/", None),
    (6, "", ""),
    (7, "http://f/", prose(41, 50_000)),
    (8, "http://g/", "WARC/1.1\r\n\r\n"),
    (11, "http://h/", "twice"),
    (11, "http://h/", "twice"),
    (None, "http://i/", "no id"),
    (None, "http://j/", "no id"),
] + [(100 + i, f"http://x/{i}", f"page {i % 40}") for i in range(120)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "d", "p", "f") for r in ROWS], PAGES).repartition(3)


def expected():
    first = defaultdict(lambda: None)
    for i, _, html in ROWS:
        if i is not None:
            first[html or ""] = min(i, first[html or ""] if first[html or ""] is not None else i)
    out = []
    for i, _, html in ROWS:
        payload = (html or "").encode()
        revisit = first[html or ""] is not None and i != first[html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def test_written_and_read_back(pages):
    assert sorted(map(tuple, warc.archive_pages(pages).collect()), key=str) == expected()


def test_bundles_are_plain_zstandard_and_frames_stand_alone(pages, tmp_path):
    index = warc.write_archives(pages.coalesce(1), str(tmp_path), frame_size=2000, bundle_size=3000)
    rows = index.collect()
    assert len({r.bundle for r in rows}) > 1 and max(r.frame for r in rows) > 0
    for r in rows:
        with warc.Reader(r.bundle) as reader:
            text = reader.frame(r.frame)[r.offset : r.offset + r.length]
            headers, _, end = warc.parse(text, 0)
            assert end == len(text) and headers["WARC-Record-ID"] == f"<urn:page:{r.page_id}>"
            assert headers["WARC-Type"] == r.record_type
            plain = b"".join(reader.frame(i) for i in range(len(reader.frames)))
        with open(r.bundle, "rb") as file:
            stream = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True)
            assert stream.read() == plain
    read = warc.read_archives(index, with_payload=True).collect()
    by_url = {r.url: r for r in read}
    assert bytes(by_url["http://f/"].payload).decode() == prose(41, 50_000)
    assert "http://b/%20x%0D%0AX-Bad:%201" in by_url


def test_fetching_single_records(spark, pages):
    index = warc.write_archives(pages)
    found = warc.fetch(index, spark.createDataFrame([(3,), (5,), (404,)], "page_id long")).collect()
    got = sorted((r.page_id, r.record_type, r.payload and bytes(r.payload).decode(), r.refers_to) for r in found)
    assert got == [(3, "response", "<p>é", None), (5, "revisit", None, 3)]


def test_small_payloads_may_all_be_stored(pages):
    index = warc.write_archives(pages, least=10_000)
    assert index.filter("record_type = 'revisit'").count() == 0


def test_damage_is_seen(pages, tmp_path):
    text = warc.record(1, "u", b"payload", None, False).replace(b"payload\r\n\r\n", b"Payload\r\n\r\n")
    headers, block, _ = warc.parse(text, 0)
    with pytest.raises(ValueError, match="damaged"):
        warc._described(headers, block, False)


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0
