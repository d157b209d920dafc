"""WARC archives and block files."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from moonstride.llm import token_blocks, warc

PAGES = [
    (5, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (9, None, None), (8, "http://c/\r\nX: y", ""), (1, "u", "once"),
    (None, "n", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (None, "n", "null alone"), (7, "l", "x" * 300_000), (6, "l", "x" * 300_000),
]


@pytest.fixture(scope="module")
def pages(llm):
    return llm.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string")


def wanted():
    out = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(ids, default=None)
        revisit = first is not None and page != first
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return out


def test_pages_through_archives(pages):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, warc.pages_through_archives(pages).collect()), key=key) == sorted(wanted(), key=key)


def test_no_pages(llm):
    assert warc.pages_through_archives(llm.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_small_payloads_are_not_joined(pages):
    assert warc.page_records(pages, min_bytes=1_000_000).where("warc_type = 'revisit'").count() == 0


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_predicates_and_payloads(llm, pages, tmp_path, compression):
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, compression=compression)
    records = warc.read_archives(llm, path).where("warc_type = 'response' and target_uri = 'u'")
    assert [bytes(r.payload).decode() for r in records.collect()] == ["once"]
    assert warc.read_archives(llm, path, splitbytes="1").count() == len(PAGES)
    assert warc.read_archives(llm, path, payload="false").where("payload is not null").count() == 0
    odd = warc.read_archives(llm, path).where("record_id = '<urn:page:8>'").first()
    assert odd.target_uri == "http://c/%0D%0AX: y" and odd.payload_bytes == 0


def test_damaged_archives_are_errors(llm, pages, tmp_path):
    path = tmp_path / "archives"
    warc.write_archives(pages.coalesce(1), str(path), compression="none")
    file = next(path.glob("*.warc"))
    whole = file.read_bytes()
    file.write_bytes(whole.replace(b"once", b"ONCE"))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(llm, str(path), verify="true").collect()
    file.write_bytes(whole[:-300_000])
    with pytest.raises(Exception, match="cut off"):
        warc.read_archives(llm, str(path), verify="true").collect()


def test_base32(llm):
    texts = ["", "a", "é", "longer text"]
    rows = llm.createDataFrame([(t,) for t in texts], "t string").withColumn("h", F.sha1(F.col("t").cast("binary")))
    for row in rows.select("t", warc._base32("h").alias("b")).collect():
        assert row.b == base64.b32encode(hashlib.sha1(row.t.encode()).digest()).decode()


@pytest.mark.parametrize("n", [1, 63, 1024, 1025, 300_000])
@pytest.mark.parametrize("high", [1, 2, 300, 50257, 2**32 - 1])
def test_blocks_round_trip(n, high):
    ids = np.random.RandomState(n).randint(0, high, n, dtype=np.int64).astype(np.uint32)
    ids[::9] = min(high, 60_000)
    blocks = token_blocks.pack_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks[:-1])])
    assert (token_blocks.unpack_blocks(b"".join(blocks), starts) == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.zeros(1024, np.uint32)
    ids[:50] = 2**31
    assert len(token_blocks.pack_blocks(ids)[0]) < 400
