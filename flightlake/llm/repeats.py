"""Stretches of text around anchors: what both exact repeat operators filter and partition by.

Of the runs of k units (words or bytes) in a window, the one with the least hash is its anchor. Neighbouring windows mostly share
it; all of a document's windows with one anchor form a stretch. A window stands in one stretch of its document, and
equal windows have equal anchors, so a window can repeat only where its anchor does. Stretches known by one hash each are thus all that
has to be shuffled: about two for every W - k units. An anchor whose stretches are all equal needs no closer look, nor does a
stretch that occurs twice as a whole: all its windows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import SPACED, arrow_batch, batches_of, flat, mixed, on_key, prefix_sums, signed, span_hash, stage, unstage, word_bounds, word_hashes

#: Starts of windows that are looked at together; bounds the memory a long text takes.
CHUNK = 1 << 20
_POSITION = np.uint64((1 << 28) - 1)
STRETCHES = "doc_id long, _h long, start int, n int, anchor long, whole long"
_STRETCHES = pa.schema([(c, pa.int64() if t == "long" else pa.int32()) for c, t in (x.split() for x in STRETCHES.split(", "))])
#: The stretch before one in its document: the hash of all its text, 0 for none.
_LINKED = pa.schema([*_STRETCHES, ("before", pa.int64())])
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03 >> 1 | 1))


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours, by running minima from both ends of blocks of ``w``."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def stretches_of(units: np.ndarray, ends: np.ndarray, first: int, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows, anchor and hash of the stretches in one chunk of unit hashes.

    ``ends`` is where the document of each unit ends; both it and the starts count from ``first``, the place of the chunk. Windows must lie in
    one document and begin in the chunk, whose units reach ``window`` - 1 beyond its last start.
    """
    n = len(units) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    sums = prefix_sums(units)
    at = np.arange(len(units) - k + 1)
    grams = span_hash(sums, at, at + k)
    least = sliding_least((grams & ~_POSITION) | at.astype(np.uint64), window - k + 1)
    place = (least & _POSITION).astype(np.int64)
    good = np.arange(n) + first + window <= ends[:n]
    new = good.copy()
    # A new document begins where the end that counts changes.
    new[1:] &= (place[1:] != place[:-1]) | ~good[:-1] | (ends[1:n] != ends[: n - 1])
    starts = np.flatnonzero(new)
    stop = np.ones(n, bool)
    stop[:-1] = ~good[1:] | new[1:]
    last = np.flatnonzero(good & stop)
    return starts + first, last - starts + 1, signed(grams[place[starts]]), signed(span_hash(sums, starts, last + window))


def word_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and how many stand before each text (and in all)."""
    data, offsets = flat(texts)
    starts, ends, counts = word_bounds(data, offsets, SPACED)
    return word_hashes(data, starts, ends), counts


def byte_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, and how many stand before each text (and in all); ``hashed`` makes units of them."""
    return flat(texts)


def hashed(units: np.ndarray) -> np.ndarray:
    return _BYTES[units] if units.dtype == np.uint8 else units


def _stretches(batches: Iterator[pa.RecordBatch], kind: str, window: int, k: int, links: bool = False) -> Iterator[pa.RecordBatch]:
    units_of = word_units if kind == "words" else byte_units
    for batch in batches_of(batches, limit=4 << 20):
        units, counts = units_of(batch.column(2))
        ids, marks = (batch.column(i) for i in range(2))
        for first in range(0, max(len(units) - window + 1, 0), CHUNK):
            part = units[first : first + CHUNK + window - 1]
            doc = np.searchsorted(counts, np.arange(first, first + len(part)), "right") - 1
            starts, n, anchor, whole = stretches_of(hashed(part), counts[doc + 1], first, window, k)
            if len(starts):
                at = doc[starts - first]
                own = pa.array(at)
                columns = [ids.take(own), marks.take(own), starts - counts[at], n, anchor, whole]
                if links:
                    columns.append(np.append(0, whole[:-1] * (at[1:] == at[:-1])))
                yield arrow_batch(_LINKED if links else _STRETCHES, *columns)


def stretches(texts: DataFrame, kind: str, window: int, k: int, links: bool = False) -> DataFrame:
    """``doc_id, _h, start, n, anchor, whole``: place and number of windows, hash of the anchor and of all its text; with ``links`` also ``before``."""
    return texts.select("doc_id", "_h", "text").mapInArrow(partial(_stretches, kind=kind, window=window, k=k, links=links), f"{STRETCHES}, before long" if links else STRETCHES)


def met_again(texts: DataFrame, kind: str, window: int, k: int, links: bool = False) -> DataFrame:
    """The stretches whose anchor another stretch has too, staged."""
    every = stage(stretches(texts, kind, window, k, links))
    # Staged on both sides, so that the share of a frequent anchor or stretch is split among tasks.
    kept = stage(every.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor"))
    again = stage(every.join(kept, "anchor", "left_semi"))
    unstage(every, kept)
    return again


def repeated_and_open(texts: DataFrame, kind: str, window: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Stretches that repeat as a whole, and those that have to be compared window by window.

    The first are ``doc_id, _h, start, n``. The second, ``doc_id, _h, start, n, anchor, copies``, stand for all equal ones, ``copies`` in number,
    of the anchors that have different stretches and any that occurs once; only those with one copy are still to be judged.
    """
    again = met_again(texts, kind, window, k)
    classes = stage(again.groupBy("anchor", "whole").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "_h", "start", "n")).alias("at")))
    whole = again.join(classes.filter("copies > 1"), ["anchor", "whole"], "left_semi").select("doc_id", "_h", "start", "n")
    branching = stage(classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("fewest")).filter("kinds > 1 AND fewest = 1").select("anchor"))
    unclear = classes.join(branching, "anchor", "left_semi").select("at.*", "anchor", "copies")
    return whole, unclear


def of_documents(texts: DataFrame, places: DataFrame, *columns: str, once: bool = False) -> DataFrame:
    """``texts`` with the list ``places`` of what ``columns`` hold for each document; null for none, with ``once`` without repeats."""
    collected = F.collect_set if once else F.collect_list
    lists = places.groupBy("doc_id", "_h").agg(collected(F.struct(*columns)).alias("places"))
    return texts.join(lists, on_key(texts, lists), "left").select(texts["doc_id"], texts["_h"], texts["text"], "places")


WINDOWS = "anchor long, window long, copies long, doc_id long, _h long, start int"
_WINDOWS = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("copies", pa.int64()), ("doc_id", pa.int64()), ("_h", pa.int64()), ("start", pa.int32())])


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row of each place in a batch, and the places' fields."""
    lists = batch.column("places")
    flat_places = lists.flatten()
    rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return rows, [flat_places.field(c).to_numpy(zero_copy_only=False) for c in names]


def expanded(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1 .. of each range, one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _windows(batches: Iterator[pa.RecordBatch], kind: str, window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, limit=4 << 20):
        units, counts = (word_units if kind == "words" else byte_units)(batch.column("text"))
        rows, (start, n, anchor, copies) = _columns(batch, ("start", "n", "anchor", "copies"))
        n = n.astype(np.int64)
        at = expanded(start.astype(np.int64) + counts[rows], n)
        each = np.repeat(np.arange(len(n)), n)
        for a in range(0, len(at), CHUNK):
            own = each[a : a + CHUNK]
            hashes = _window_hashes(units, at[a : a + CHUNK], window)
            doc = pa.array(rows[own])
            yield arrow_batch(_WINDOWS, anchor[own], signed(hashes), copies[own], batch.column("doc_id").take(doc), batch.column("_h").take(doc), at[a : a + CHUNK] - counts[rows[own]])


def _window_hashes(units: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the windows at ascending places, a stretch of the units at a time."""
    out = np.zeros(len(at), np.uint64)
    order = np.argsort(at, kind="stable")
    done = 0
    while done < len(order):
        first = int(at[order[done]])
        to = done + int(np.searchsorted(at[order[done:]], first + CHUNK))
        own = order[done:to]
        sums = prefix_sums(hashed(units[first : first + CHUNK + window]))
        out[own] = span_hash(sums, at[own] - first, at[own] - first + window)
        done = to
    return out


def windows_that_repeat(texts: DataFrame, unclear: DataFrame, kind: str, window: int) -> DataFrame:
    """``doc_id, _h, start, n`` (1): windows of stretches with one copy that stand in another stretch too.

    Windows of all unclear stretches are counted by their hash within their anchor, folded before the shuffle.
    Where equal rows show a stretch twice it has two copies at least, so counting it again changes nothing.
    """
    with_places = of_documents(texts, unclear, "start", "n", "anchor", "copies").filter("places IS NOT NULL")
    found = stage(with_places.mapInArrow(partial(_windows, kind=kind, window=window), WINDOWS))
    often = found.groupBy("anchor", "window").agg(F.sum("copies").alias("c")).filter("c > 1").select("anchor", "window")
    kept = stage(often)
    return found.filter("copies = 1").join(kept, ["anchor", "window"], "left_semi").select("doc_id", "_h", "start", F.lit(1).alias("n"))


def covered(starts: np.ndarray, n: np.ndarray, window: int, size: int) -> np.ndarray:
    """True for the units of a document that the windows cover."""
    depth = np.zeros(size + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + n + window - 1, -1)
    return np.cumsum(depth[:-1]) > 0


def spans_of(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of True."""
    edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
