"""WARC archives of pages, and revisit resolution over them.

Archives are written by Spark's text sink, whose commit protocol survives lost executors and which reaches any store
Spark reaches: each row is one record but for its last line end, which is the line separator. Reading takes archives
as whole files, bounded by the records of each, and walks them by Content-Length. Resolution moves headers only: they are shuffled by payload digest,
folded to one original per digest before the shuffle, and joined back. The revisits of an archive then join it as one short
list, and the archive is written anew, payloads of revisits left out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake import session
from flightlake.llm.common import arrow_batch, drop_path, stage

END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = "archive string, offset long, page_id long, uri string, date string, record_type string, payload_bytes long, payload_digest string, refers_to long"
_HEADERS = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("uri", pa.string()), ("date", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits, five hex digits, make four digits at a time."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_pages(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", per_archive: int = 10_000) -> None:
    """One response record for each row of ``page_id, url, html``, in archives of at most ``per_archive`` records.

    The payload is the html as it is in UTF-8, empty for null. A null url gives a record without target; control characters in
    one are escaped. Repeated rows are records of their own. Other columns are not read.
    """
    html = F.coalesce(pages["html"], F.lit(""))
    page = F.concat(F.lit("<urn:page:"), F.coalesce(pages["page_id"].cast("string"), F.lit("null")), F.lit(">"))
    uri = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(pages["url"], r"[\x00-\x20\x7F]", "%20"), F.lit(END)), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.octet_length(html).cast("string"), F.lit(END + END))
    record = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: response{END}WARC-Record-ID: "), page, F.lit(f"{END}WARC-Date: {date}{END}"), uri,
        F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(html), F.lit(f"{END}Content-Type: application/http;msgtype=response{END}Content-Length: "),
        (F.octet_length(http) + F.octet_length(html)).cast("string"), F.lit(END + END), http, html, F.lit(END),
    )
    _write(pages.select(record.alias("value")), path, per_archive)


def _write(records: DataFrame, path: str, per_archive: int) -> None:
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


def walk(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers in lower case and block of each record."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8", "replace").split(END)
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        yield at, headers, archive[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def _page(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return int(name) if name.lstrip("-").isdigit() else None


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = []
            for at, h, block in walk(gzip.decompress(content.as_py())):
                http, _, payload = block.partition(b"\r\n\r\n")
                if h["warc-type"] == "revisit":
                    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                else:
                    length, digest = len(payload), _digest(payload)
                rows.append((path, at, _page(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-date"], h["warc-type"], length, digest, _page(h.get("warc-refers-to"))))
            if rows:
                yield arrow_batch(_HEADERS, *map(list, zip(*rows)))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives, payload digest and length taken from the payload, or for revisits from their headers."""
    return _files(spark, path).mapInArrow(_read, HEADERS)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``archive, offset, refers_to, uri, date`` of each record to become a revisit, with its original's page, target and date.

    Of records whose payloads are equal and have ``min_bytes`` at least, that with the largest page id (null ids last, then by place)
    stays. ``headers`` are read twice: stage them.
    """
    large = headers.filter(F.col("payload_bytes") >= min_bytes)
    same = ["payload_digest", "payload_bytes"]
    # Written first: then both sides of the join are plain shuffles, and a frequent digest's share of the headers is split.
    originals = stage(large.groupBy(*same).agg(F.count("*").alias("n"), F.max(F.struct("page_id", "archive", "offset", "uri", "date")).alias("first")).filter("n > 1").drop("n"))
    both = large.join(originals, same)
    later = (F.col("archive") != F.col("first.archive")) | (F.col("offset") != F.col("first.offset"))
    return both.filter(later).select("archive", "offset", F.col("first.page_id").alias("refers_to"), F.col("first.uri").alias("uri"), F.col("first.date").alias("date"))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, revisits in zip(batch.column("content"), batch.column("revisits")):
            revisit = {r["offset"]: r for r in revisits.as_py() or ()}
            out = []
            for at, h, block in walk(gzip.decompress(content.as_py())):
                lines = [f"WARC-Record-ID: {h['warc-record-id']}", f"WARC-Date: {h['warc-date']}"]
                if "warc-target-uri" in h:
                    lines.append(f"WARC-Target-URI: {h['warc-target-uri']}")
                http, _, payload = block.partition(b"\r\n\r\n")
                lines.append(f"WARC-Payload-Digest: sha1:{_digest(payload)}")
                if at in revisit:
                    r = revisit[at]
                    lines += ["WARC-Type: revisit", f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'null' if r['refers_to'] is None else r['refers_to']}>", f"WARC-Refers-To-Date: {r['date']}"]
                    if r["uri"] is not None:
                        lines.append(f"WARC-Refers-To-Target-URI: {r['uri']}")
                    block = http + b"\r\n\r\n"
                else:
                    lines.append("WARC-Type: response")
                lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
                out.append("\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n")
            for a in range(0, len(out), 500):
                yield pa.RecordBatch.from_arrays([pa.array(out[a : a + 500], pa.binary()).view(pa.string())], names=["value"])


def deduplicate(spark: SparkSession, path: str, out: str, min_bytes: int = 0, per_archive: int = 10_000) -> None:
    """Archives at ``out`` with the records of those at ``path``, fresh headers, and revisits in place of repeated payloads."""
    headers = stage(read_headers(spark, path))
    lists = resolve(headers, min_bytes).groupBy("archive").agg(F.collect_list(F.struct("offset", "refers_to", "uri", "date")).alias("revisits"))
    files = _files(spark, path)
    both = files.join(lists, files["path"] == lists["archive"], "left").select("content", "revisits")
    _write(both.mapInArrow(_rewrite, "value string"), out, per_archive)
    drop_path(spark, headers.stage_path)


def resolved_pages(pages: DataFrame, min_bytes: int = 0, per_archive: int = 10_000) -> DataFrame:
    """Headers of the deduplicated archives of ``pages``, read back from them.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``, one row per row of ``pages``. No pages give no archive and no row.
    """
    spark = pages.sparkSession
    first, out = session.workdir(spark, "warc"), session.workdir(spark, "warc")
    write_pages(pages, first, per_archive=per_archive)
    deduplicate(spark, first, out, min_bytes, per_archive)
    drop_path(spark, first)
    return read_headers(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
