from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from ridgeway.llm import warc as V
from ridgeway.llm.common import local_path

from tests.llm.helpers import prose

PAGES = [(3, "http://a/\r\nx", "<p>same</p>"), (1, None, "<p>same</p>"), (7, "http://c", None), (8, "http://d", ""), (9, "http://e", "é中" + prose(5, 50_000)),
         (None, "http://n", "<p>same</p>"), (2, "http://b", "WARC/1.1\r\n\r\n"), (1, None, "<p>same</p>"), (10, "http://f", "unique\n")]


@pytest.fixture(scope="module")
def run(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").select("*", F.lit(1).alias("size"), F.lit(2).alias("digest"), F.lit(3).alias("revisit"))
    manifest, folder = V.write(pages.repartition(2), max_bytes=1000)
    index = V.normalise(manifest, folder)
    return pages, manifest, folder, index


def test_round_trip(run):
    _, _, folder, index = run
    got = V.read(index, folder, with_payload=True).collect()
    want = {}
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        want.setdefault(data, []).append(page_id)
    assert len(got) == len(PAGES)
    for r in got:
        page = int(r.page_id) if r.page_id else None
        data = next(d for d, ids in want.items() if page in ids and len(d) == r.payload_bytes)
        first = min(x for x in want[data] if x is not None)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.record_type == "response") == (r.refers_to is None) == (r.payload is not None)
        assert r.payload in (None, data) and r.refers_to in (None, str(first))
    for data, ids in want.items():
        kinds = [r.record_type for r in got if (int(r.page_id) if r.page_id else None) in ids and r.payload_bytes == len(data)]
        assert kinds.count("response") == ids.count(min(x for x in ids if x is not None))
    assert {r.url for r in got if r.page_id == "3"} == {"http://a/%0D%0Ax"}


def test_every_member_stands_alone_and_the_sidecar_says_where(run):
    _, manifest, folder, index = run
    base = local_path(folder)
    assert manifest.count() > 2  # files end at max_bytes
    for f in {r.file for r in manifest.collect()}:  # monolithic: one member over all records
        one = zlib.decompressobj(31)
        one.decompress(open(f"{base}/{f}", "rb").read())
        assert one.eof and not one.unused_data
    for r in index.collect():
        with open(f"{base}/{r.file}", "rb") as f:
            f.seek(r.offset)
            assert gzip.decompress(f.read(r.length)).startswith(b"WARC/1.1\r\n")
        lines = [x.split("\t") for x in open(f"{base}/{r.sidecar}").read().splitlines()]
        assert [str(r.offset), str(r.length), r.record_type, r.record_id, r.target or "-"] in lines
    whole = gzip.decompress(open(f"{base}/{index.first().file}", "rb").read())
    assert whole.count(b"WARC/1.1\r\nWARC-Type") == index.where(F.col("file") == index.first().file).count()


def test_inflated_reads_members_and_refuses_cut_files():
    data = gzip.compress(b"ab\n") + gzip.compress(b"cd\nrest" * 100_000)
    s = V.Inflated(io.BytesIO(data))
    assert s.line() == b"ab\n" and s.line() == b"cd\n" and b"".join(s.take(4)) == b"rest"
    with pytest.raises(EOFError):
        b"".join(V.Inflated(io.BytesIO(gzip.compress(b"x" * 10**6)[:50])).take(10**6))


def test_empty_table(spark, run):
    pages, *_ = run
    manifest, folder = V.write(pages.limit(0))
    assert manifest.count() == 0
    assert V.read(V.normalise(manifest, folder), folder).count() == 0
