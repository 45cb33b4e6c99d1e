"""Resampling of documents by importance for a target distribution, with exact ranks.

Features are runs of words, counted in a fixed number of buckets over both tables; the gains of all buckets are one array of fixed
size, and a task scores its texts by looking up that array. Ranks come from a parallel sort by regular sampling: every partition is
sorted by itself, each such run gives its keys at regular distances, and these give the splitters. Counting each run between the
splitters gives the number of rows before every segment, so the segments that hold drawn rows are known before any row moves. Only
those are exchanged, merged where they arrive, and ranked from their prefix count on.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import ALNUM, LOWER, arrow_batch, batches_of, flat, partitions, stage, word_bounds

#: Keys that the runs give for the choice of splitters, in all; the driver sorts them.
SAMPLES = 50_000
#: Rows of a segment at most, on average.
SEGMENT = 1_000_000
#: Longer words go through zlib one by one.
LONG = 48


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``runs`` words, joined by one space, in ``buckets`` by their CRC-32."""

    runs: int = 1
    buckets: int = 10_000


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32, by its reflected polynomial."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> np.uint32(1)) ^ np.uint32(0xEDB88320), x >> np.uint32(1))
    return x


_TABLE = _crc_table()


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 register of each ``state`` after the bytes of its span; all spans advance together, byte by byte."""
    order = np.argsort(-np.minimum(lengths, LONG + 1), kind="stable")
    out, at, left = state[order], starts[order], lengths[order]
    n_long = int(np.count_nonzero(left > LONG))
    for i in range(n_long):
        out[i] = zlib.crc32(data[at[i] : at[i] + left[i]], int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out, rest = out.copy(), slice(n_long, None)
    active = np.searchsorted(-left[rest], -np.arange(1, LONG + 1), "right")
    for i, n in enumerate(active.tolist()):
        if not n:
            break
        s = slice(n_long, n_long + n)
        out[s] = _TABLE[(out[s] ^ data[at[s] + i]) & np.uint32(0xFF)] ^ (out[s] >> np.uint32(8))
    back = np.empty_like(out)
    back[order] = out
    return back


def features_of(texts: pa.Array, spec: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature, the text it is of, and the words of each text."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, counts = word_bounds(data, offsets, ALNUM)
    lengths, words = ends - starts, np.diff(counts)
    owner = np.repeat(np.arange(len(words)), words)
    state = crc_on(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, lengths)
    buckets, owners, last = [(~state) % np.uint32(spec.buckets)], [owner], np.arange(len(starts))
    for _ in range(1, spec.runs):
        # A run one word longer: go on from the register of the shorter one, where the text has another word.
        fits = last + 1 < counts[1:][owner]
        state, owner, last = state[fits], owner[fits], last[fits] + 1
        state = _TABLE[(state ^ np.uint32(32)) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        state = crc_on(state, data, starts[last], lengths[last])
        buckets.append((~state) % np.uint32(spec.buckets))
        owners.append(owner)
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners), words


def bucket_counts(docs: DataFrame, spec: Features) -> np.ndarray:
    """How often each bucket's features stand in all texts; a task sends at most one row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(spec.buckets, np.int64)
        for batch in batches_of(batches):
            total += np.bincount(features_of(batch.column("text"), spec)[0], minlength=spec.buckets)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(total[has], pa.int64())], names=["bucket", "n"])

    counted = docs.select(docs["text"].alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(spec.buckets, np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of how much likelier a bucket is in the target), with one more of each bucket on both sides."""
    n = len(source)
    s_all, t_all = float(source.sum()) + n, float(target.sum()) + n
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(ids: list[int | None], seed: int) -> np.ndarray:
    """floor(-1000 ln(-ln u)) with u drawn from each id; a null id draws like an id without digits."""
    heads = (hashlib.sha256(b"%d:%s" % (seed, b"" if i is None else b"%d" % i)).digest()[:4] for i in ids)
    return np.array([math.floor(-1000 * math.log(-math.log((int.from_bytes(h, "big") + 0.5) / 4294967296))) for h in heads], np.int64)


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64()), ("n_words", pa.int64())])
_SCORED_COLUMNS = "doc_id long, n_features long, weight long, score long, n_words long"


def scored(docs: DataFrame, gain: np.ndarray, seed: int, spec: Features) -> DataFrame:
    """``doc_id, n_features, weight, score, n_words`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            buckets, owner, words = features_of(batch.column("text"), spec)
            n = np.bincount(owner, minlength=len(words))
            total = np.zeros(len(words), np.int64)
            np.add.at(total, owner, gain[buckets])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield arrow_batch(_SCORED, batch.column("doc_id"), n, weight, weight + noise(batch.column("doc_id").to_pylist(), seed), words)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, _SCORED_COLUMNS)


#: Best first; the place in the sorted run tells rows equal in score and id apart.
def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("run"), F.asc("at")]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, run), pa.int64()), pa.array(np.arange(at, at + n), pa.int64())], names=[*batch.schema.names, "run", "at"])
        at += n


def _keys(columns: dict[str, pa.Array]) -> list[np.ndarray]:
    ids = columns["doc_id"]
    number = lambda c: c.to_numpy(zero_copy_only=False)
    return [-number(columns["score"]), np.asarray(ids.is_null()).astype(np.int64), number(ids.fill_null(0)), number(columns["run"]), number(columns["at"])]


def segments_of(keys: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """For each key how many splitters are not behind it."""
    k = len(splitters[0])
    both = [np.concatenate([s, x]) for s, x in zip(splitters, keys)]
    order = np.lexsort(both[::-1])  # stable: a splitter stands before the key equal to it
    is_splitter = order < k
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(is_splitter)
    return out[k:]


def _segment(batches: Iterator[pa.RecordBatch], splitters: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segments_of(_keys(columns), splitters), pa.int32())], names=[*batch.schema.names, "segment"])


def _ranked(batches: Iterator[pa.RecordBatch], before: np.ndarray, draw: int) -> Iterator[pa.RecordBatch]:
    now, at = -1, 0
    for batch in batches:
        seg = batch.column("segment").to_numpy()
        if not len(seg):
            continue
        cuts = np.flatnonzero(np.diff(seg, prepend=seg[0] - 1))
        place = np.arange(len(seg)) - np.repeat(cuts, np.diff(np.append(cuts, len(seg))))
        if seg[0] == now:
            place[: cuts[1] if len(cuts) > 1 else len(seg)] += at
        now, at = int(seg[-1]), int(place[-1]) + 1
        rank = before[seg] + place + 1
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_features", "weight", "score")), pa.array(rank, pa.int64(), mask=rank > draw)], names=["doc_id", "n_features", "weight", "score", "rank"])


def ranked(scores: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: exact ranks of the best ``percent`` of the ``eligible`` rows, null for all others.

    Higher scores come first, ties go to the smaller id, null ids last; rows equal in both get ranks one after the other.
    """
    spark = scores.sparkSession
    marked = scores.withColumn("takes_part", F.coalesce(eligible, F.lit(False)))
    runs = stage(marked.sortWithinPartitions(F.desc("takes_part"), F.desc("score"), F.asc_nulls_last("doc_id")).mapInArrow(_numbered, f"{_SCORED_COLUMNS}, takes_part boolean, run long, at long"))
    taking = runs.filter("takes_part")
    n = taking.count()
    draw = percent * n // 100
    width = max(partitions(spark), -(-n // SEGMENT))
    step = max(1, n // SAMPLES)
    sample = taking.filter(F.col("at") % step == step // 2).select("doc_id", "score", "run", "at").toArrow().combine_chunks()
    keys = _keys({name: sample.column(name).combine_chunks() for name in sample.column_names})
    order = np.lexsort(keys[::-1])
    # Regular distances among the sorted samples; fewer samples than segments leave segments empty.
    chosen = order[np.unique(np.arange(1, width) * len(order) // width)] if len(order) else order
    splitters = [k[chosen] for k in keys]
    placed = taking.mapInArrow(partial(_segment, splitters=splitters), f"{_SCORED_COLUMNS}, takes_part boolean, run long, at long, segment int")
    sizes = np.zeros(len(chosen) + 1, np.int64)
    for row in placed.groupBy("segment").count().collect():
        sizes[row["segment"]] = row["count"]
    before = np.cumsum(sizes) - sizes
    going = max(1, int(np.count_nonzero(before < draw)))
    moved = placed.filter(F.col("segment") < going).repartitionById(going, F.col("segment")).sortWithinPartitions("segment", *_order())
    columns = "doc_id long, n_features long, weight long, score long, rank long"
    best = moved.mapInArrow(partial(_ranked, before=before, draw=draw), columns)
    plain = lambda df: df.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return best.unionByName(plain(placed.filter(F.col("segment") >= going))).unionByName(plain(runs.filter("NOT takes_part")))


def resampled(docs: DataFrame, target: DataFrame, min_words: int = 20, percent: int = 10, seed: int = 2024, spec: Features = Features()) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``: documents like those of ``target`` come first.

    Words are runs of ASCII letters, digits and everything beyond ASCII, A-Z in lower case. A document's weight is the floored mean of its
    features' gains, 0 without features; noise drawn from its id makes the score. Of the documents of at least ``min_words`` words the best
    ``percent`` are drawn and ranked. A null or empty text has no words. Ties go to the smaller id, a null id comes last and draws like an id
    without digits. Repeated rows count, and come out, as often as they are there; with an empty ``target`` all of its counts are 0.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    gain = gains(bucket_counts(docs, spec), bucket_counts(target, spec))
    return ranked(scored(docs, gain, seed, spec), F.col("n_words") >= min_words, percent)
