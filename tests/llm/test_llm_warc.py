import base64
import gzip
import hashlib

from flightlake import session
from flightlake.llm import warc

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (5, "http://a/5", "<p>same</p>"), (3, None, "<p>same</p>"), (2, "http://b/ x\ny", "own\r\n\r\nWARC/1.1\r\n"), (4, "u", None), (6, "u", ""),
    (7, "u", "é" * 5000), (7, "u", "é" * 5000), (None, "n", "null id"), (None, "n2", "null id"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, record_type string, offset int")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip_and_revisits(spark):
    got = sorted((repr(tuple(r)) for r in warc.resolved_pages(frame(spark, PAGES).repartition(3), per_archive=2).collect()))
    wanted = []
    for page, _, html in PAGES:
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        wanted.append((page, len((html or "").encode()), digest(html), "response", None) if not same or page == max(same) else (page, len((html or "").encode()), digest(html), "revisit", max(same)))
    # Equal ids and equal null ids: one of the rows is the original.
    wanted[7] = (7, 10000, digest("é" * 5000), "revisit", 7)
    wanted[9] = (None, 7, digest("null id"), "revisit", None)
    assert got == sorted(map(repr, wanted))


def test_small_payloads_stay(spark):
    got = {r["page_id"]: r["record_type"] for r in warc.resolved_pages(frame(spark, PAGES[:6]), min_bytes=20).collect()}
    assert set(got.values()) == {"response"}


def test_archives_are_warc(spark):
    path = session.workdir(spark, "warc")
    warc.write_pages(frame(spark, PAGES).coalesce(1), path)
    files = [r["content"] for r in spark.read.format("binaryFile").load(path).collect() if r["path"].endswith(".gz")]
    records = [x for f in files for x in warc.walk(gzip.decompress(bytes(f)))]
    assert len(records) == len(PAGES)
    for _, headers, block in records:
        assert int(headers["content-length"]) == len(block)
        payload = block.partition(b"\r\n\r\n")[2]
        assert headers["warc-payload-digest"] == f"sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}"


def test_no_pages(spark):
    assert warc.resolved_pages(frame(spark, [])).collect() == []
