"""Byte-exact removal of repeated stretches by threshold-bounded expansion on Burrows-Wheeler transforms.

Windows of the given length are partitioned by their anchors (see ``repeats``): stretches that repeat as a whole and
those that cannot repeat are known without a closer look. The rest is dealt by anchor over shards of a few megabytes. Each
builds the Burrows-Wheeler transform of its stretches and finds common prefixes breadth first: the intervals of all strings of one
length are extended backward by a byte at a time, and the ends of new intervals are the places where neighbouring suffixes have
just that much in common. After as many steps as a window has bytes it stops; suffixes not parted by then begin with the same window.

An anchor with very many different stretches would outgrow a shard. Its windows are counted by their hashes instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import repeats
from flightlake.llm.common import arrow_batch, batches_of, flat, keyed, stage

#: Bytes of an anchor, of the 400 of a window.
ANCHOR = 150
#: Bytes of a shard, and the most stretches of one anchor that go to one.
SHARD, MOST = 1 << 20, 4096


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of segments of symbols above 0, each ended by a 0; equal ones by place.

    Suffixes end at the next 0. The first seven symbols make the first key; then ranks of twice the length follow from pairs.
    """
    n, step = len(text), 7
    key, going = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(step):
        here = np.zeros(n, np.int64)
        here[: n - i] = text[i:]
        here[~going] = 0
        going &= here > 0
        key = key << 9 | here
    ends = np.flatnonzero(text == 0)
    left = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(n)
    longest = int(left.max(initial=0)) + 1
    while True:
        order = np.argsort(key, kind="stable")
        parted = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])])
        if step >= longest or parted[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = parted + 1
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:]
        after[left < step] = 0
        key = rank * (n + 1) + after
        step *= 2


def parted_within(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place between neighbouring suffixes (and both ends) whether they have fewer than ``length`` symbols in common."""
    n = len(text)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)
    back[by_symbol] = np.arange(n)
    first = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=258))])
    symbols = np.flatnonzero(np.diff(first))
    parted = np.zeros(n + 1, bool)
    parted[[0, n]] = True
    lo, hi = np.array([0]), np.array([n])
    for known in range(length):
        if not len(lo):
            break
        many = hi - lo > 1
        child_lo, child_hi = [], []
        one = lo[~many]
        one = one[bwt[one] > 0] if known else one
        child_lo.append(back[one])
        child_hi.append(back[one] + 1)
        wide_lo, wide_hi = lo[many], hi[many]
        if len(wide_lo):
            sizes = wide_hi - wide_lo
            if sizes.sum() > 4 * len(symbols) * len(wide_lo):
                for s in symbols if not known else symbols[symbols > 0]:
                    places = by_symbol[first[s] : first[s + 1]]
                    a, b = np.searchsorted(places, wide_lo), np.searchsorted(places, wide_hi)
                    some = a < b
                    child_lo.append(first[s] + a[some])
                    child_hi.append(first[s] + b[some])
            else:
                rows = repeats.expanded(wide_lo, sizes)
                group = np.repeat(np.arange(len(sizes)), sizes) * 258 + bwt[rows]
                at = np.argsort(group, kind="stable")
                group, target = group[at], back[rows[at]]
                new = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                end = np.append(new[1:], len(group)) - 1
                use = (group[new] % 258 > 0) | (known == 0)
                child_lo.append(target[new[use]])
                child_hi.append(target[end[use]] + 1)
        lo, hi = np.concatenate(child_lo), np.concatenate(child_hi)
        fresh = ~parted[hi]
        lo, hi = lo[fresh], hi[fresh]
        parted[hi] = True
    return parted


def windows_met_twice(segments: list[bytes], copies: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and offset of the windows that the segments, counted by their copies, hold more than once."""
    sizes = np.array([len(s) for s in segments], np.int64)
    text = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int64) + 1, 0) for s in segments])
    order = suffix_order(text)
    group = np.cumsum(parted_within(text, order, length)[:-1])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    segment = np.repeat(np.arange(len(sizes)), sizes + 1)[order]
    offset = order - begins[segment]
    whole = offset + length <= sizes[segment]
    times = np.bincount(group[whole], copies[segment[whole]])
    use = whole & (copies[segment] == 1)
    use[use] = times[group[use]] > 1
    return segment[use], offset[use]


def _resolve(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    segment, offset = windows_met_twice(list(rows["segment"]), rows["copies"].to_numpy(), window)
    at = np.lexsort((offset, segment))
    segment, offset = segment[at], offset[at]
    # Neighbouring windows of a segment come out as one run.
    new = np.ones(len(at), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    own = rows.iloc[segment[first]]
    return pd.DataFrame({"doc_id": own["doc_id"].astype("Int64").array, "_h": own["_h"].to_numpy(), "start": (own["start"].to_numpy() + offset[first]).astype(np.int32), "n": np.diff(np.append(first, len(at))).astype(np.int32)})


_SEGMENTS = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("start", pa.int32()), ("anchor", pa.int64()), ("copies", pa.int64()), ("segment", pa.binary())])


def _segments(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches):
        data, counts = flat(batch.column("text"))
        rows, (start, n, anchor, copies) = repeats._columns(batch, ("start", "n", "anchor", "copies"))
        at = start + counts[rows]
        for a in range(0, len(rows), 4096):
            part = slice(a, a + 4096)
            texts = [data[s : s + m + window - 1].tobytes() for s, m in zip(at[part], n[part])]
            yield arrow_batch(_SEGMENTS, batch.column("doc_id").take(pa.array(rows[part])), batch.column("_h").take(pa.array(rows[part])), start[part], anchor[part], copies[part], texts)


def repeated_windows(docs: DataFrame, window: int = 400, anchor: int | None = None, shard: int = SHARD, most: int = MOST) -> DataFrame:
    """``doc_id, _h, start, n``: runs of ``n`` windows from byte ``start`` on whose bytes also start elsewhere.

    A window is ``window`` bytes of one text in UTF-8. Rows are documents, also where they are equal; a null text is empty. Runs may
    overlap and come in no order. Shards take about ``shard`` bytes; anchors of more than ``most`` different stretches are counted by hash. Other columns are not read.
    """
    texts = keyed(docs)
    whole, unclear = repeats.repeated_and_open(texts, "bytes", window, anchor or max(1, min(ANCHOR, window // 2)))
    unclear = stage(unclear)
    sizes = unclear.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.col("n") + window).alias("size"))
    large = stage(sizes.filter(F.col("kinds") > most).select("anchor"))
    total = sizes.filter(F.col("kinds") <= most).agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-int(total) // shard))
    small = unclear.join(large, "anchor", "left_anti")
    places = repeats.of_documents(texts, small, "start", "n", "anchor", "copies").filter("places IS NOT NULL")
    segments = places.mapInArrow(partial(_segments, window=window), "doc_id long, _h long, start int, anchor long, copies long, segment binary")
    dealt = segments.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = stage(dealt.groupBy("shard").applyInPandas(partial(_resolve, window=window), "doc_id long, _h long, start int, n int"))
    out = whole.unionByName(found)
    if large.limit(1).count():
        out = out.unionByName(repeats.windows_that_repeat(texts, unclear.join(large, "anchor", "left_semi"), "bytes", window))
    return out


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches_of(batches):
        data, counts = flat(batch.column("text"))
        rows, (start, n) = repeats._columns(batch, ("start", "n"))
        yield batch, data, counts, repeats.covered(start + counts[rows], n, window, len(data))


def _digests(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    for batch, data, counts, gone in _cut(batches, window):
        out: list[list] = [[], [], []]
        for a, b in zip(counts[:-1], counts[1:]):
            own = gone[a:b]
            for column, x in zip(out, (int(own.sum()), len(repeats.spans_of(own)[0]), hashlib.sha256(data[a:b][~own].tobytes()).hexdigest())):
                column.append(x)
        yield arrow_batch(schema, batch.column("doc_id"), np.diff(counts), *out)


def digests(docs: DataFrame, window: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row: the bytes that no repeated window covers."""
    found = repeated_windows(docs, window)
    return repeats.of_documents(keyed(docs), found, "start", "n").mapInArrow(partial(_digests, window=window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
    for batch, _, counts, gone in _cut(batches, window):
        ids = batch.column("doc_id").to_pylist()
        for i, (a, b) in enumerate(zip(counts[:-1], counts[1:])):
            first, last = repeats.spans_of(gone[a:b])
            if len(first):
                yield arrow_batch(schema, [ids[i]] * len(first), first, last)


def removal_spans(docs: DataFrame, window: int = 400) -> DataFrame:
    """``doc_id, start, end``: the longest spans of bytes of each document that repeated windows cover."""
    found = repeated_windows(docs, window)
    return repeats.of_documents(keyed(docs), found, "start", "n").filter("places IS NOT NULL").mapInArrow(partial(_spans, window=window), "doc_id long, start long, end long")
