"""What the corpus operators share: staging, document keys and words of whole batches.

A document is known by its id and a hash of its text. Rows equal in both are one document stored
twice: they are judged once and each of them gets that result. A null id is an id like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake import session

#: Multiplier of the polynomial hash of a word's bytes and of the rolling hash of words; odd, so it has an inverse.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that a batch of texts may have before it is cut into smaller ones.
BATCH_BYTES = 2 << 20


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; a lost executor costs no recomputation."""
    path = session.workdir(df.sparkSession, "llm")
    df.write.mode("errorifexists").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stage_path = path
    return back


def unstage(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        drop_path(df.sparkSession, df.stage_path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` and the second half of the key; other columns of ``docs`` only if named."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(docs["text"]).alias("_h"), docs["text"].alias("text"), *(docs[c] for c in more))


def text_key(text: Column) -> Column:
    """Tells texts of one id apart; 64 bits, as a null or repeated id may have millions of texts."""
    return F.xxhash64(text)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3).compress
    for batch in batches_of(batches):
        texts = [None if t is None else press(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_h"), pa.array(texts, pa.binary())], names=["doc_id", "_h", "packed"])


def packed(texts: DataFrame) -> DataFrame:
    """``doc_id, _h, packed``: texts that are to be shuffled, compressed one by one; a third less to move than what Spark makes of them."""
    return texts.select("doc_id", "_h", "text").mapInArrow(_packed, "doc_id long, _h long, packed binary")


def unpacked(column: pa.Array) -> pa.Array:
    """The texts of a batch as bytes."""
    plain = zstandard.ZstdDecompressor().decompress
    return pa.array([None if t is None else plain(t) for t in column.to_pylist()], pa.large_binary())


def on_key(left: DataFrame, right: DataFrame) -> Column:
    """Join condition: the same document."""
    return (left["_h"] == right["_h"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batches_of(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of ``column``, or of one row."""
    for batch in batches:
        ends = np.cumsum(sizes(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for null."""
    wide = "large" in str(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32, len(texts) + 1 + texts.offset)[texts.offset :] if len(texts) else np.zeros(1, np.int64)
    out = np.diff(offsets.astype(np.int64))
    return np.where(np.asarray(texts.is_null()), 0, out) if texts.null_count else out


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, one after the other, and where each text begins (and the last ends)."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def table_of(gaps: bytes) -> np.ndarray:
    """True for the bytes that words are made of, False for ``gaps``."""
    table = np.ones(256, bool)
    table[np.frombuffer(gaps, np.uint8)] = False
    return table


#: Words are runs of anything but ASCII white space.
SPACED = table_of(bytes([0x20, *range(0x09, 0x0E)]))
#: Words are runs of ASCII letters, digits and everything beyond ASCII.
ALNUM = table_of(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of words before it (and in all)."""
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base^0 .. base^n modulo 2^64."""
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    have = 1
    while have <= n:
        step = min(have, n + 1 - have)
        with np.errstate(over="ignore"):
            out[have : have + step] = out[:step] * (out[have - 1] * base)
        have += step
    return out


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is None or len(have) <= n:
        have = _POWERS[kind] = powers(max(n, 1 << 16), BASE if kind == "up" else _INVERSE)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """For ``span_hash``: sums of value i times base^-i, modulo 2^64."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers("down", len(values))[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of values; equal spans hash alike wherever they stand."""
    with np.errstate(over="ignore"):
        return mixed((sums[ends] - sums[starts]) * _powers("up", len(sums))[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each word."""
    with np.errstate(over="ignore"):
        seed = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return span_hash(prefix_sums(seed[data]), starts, ends)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)


def arrow_batch(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of ``edges`` (longs ``a, b``): the smallest node that links lead to.

    Each round takes the smallest label among the neighbours and then the label of that label, so chains shrink by
    powers; it ends when no label changes. Labels are staged round by round and the older ones deleted.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        lower = stage(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stage(lower.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")))
        changed = new.filter("label <> old").limit(1).count()
        unstage(labels, lower)
        labels = new
        if not changed:
            unstage(both)
            return labels.select("node", "label")
