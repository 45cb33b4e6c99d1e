"""Substring deduplication by De Bruijn compaction of token k-mers.

Windows of consecutive words are the edges of a De Bruijn graph. Its nodes are the words that neighbouring windows share, and a document
is a path in it. An edge can repeat only where its anchor does (see ``repeats``), so documents are first cut into stretches of at most a few dozen
edges with one anchor, and stretches whose anchor occurs once fall away. A stretch that is alone with its anchor is a nonbranching path as it stands.
Where different stretches share an anchor, their edges are counted and cut into paths at every node with more than one way in or out.
Joins then link paths over nodes that all documents pass in the same way, and pointer jumping, again by joins, gives
each path the first one of its chain. A document that enters such a chain runs through all of it, so one source coordinate tells a whole
repeated span. In the end the words at these coordinates are read and compared by a digest of the text itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm import repeats
from flightlake.llm.common import SPACED, arrow_batch, batches_of, flat, keyed, on_key, signed, stage, unstage, word_bounds

#: Words of an anchor, of the 35 of a window.
ANCHOR = 12
EDGES = "anchor long, whole long, copies long, i int, edge long, before long, after long"
_EDGES = pa.schema([(c, pa.int64() if t == "long" else pa.int32()) for c, t in (x.split() for x in EDGES.split(", "))])


def _edges(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The edges of stretches, numbered, each with those before and after it in its stretch (0: none)."""
    for batch in batches_of(batches, limit=4 << 20):
        units, counts = repeats.word_units(batch.column("text"))
        rows, (start, n, anchor, whole, copies) = repeats._columns(batch, ("start", "n", "anchor", "whole", "copies"))
        n = n.astype(np.int64)
        at = repeats.expanded(start + counts[rows], n)
        own, i = np.repeat(np.arange(len(n)), n), repeats.expanded(np.zeros(len(n), np.int64), n)
        edge = signed(repeats._window_hashes(units, at, window))
        before, after = np.zeros_like(edge), np.zeros_like(edge)
        before[1:] = edge[:-1] * (own[1:] == own[:-1])
        after[:-1] = edge[1:] * (own[1:] == own[:-1])
        for a in range(0, len(at), repeats.CHUNK):
            part = slice(a, a + repeats.CHUNK)
            yield arrow_batch(_EDGES, anchor[own[part]], whole[own[part]], copies[own[part]], i[part], edge[part], before[part], after[part])


def paths(texts: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    """``anchor, whole, i, n, path, c``, staged: the nonbranching paths in each different stretch, from its edge ``i`` on, and how often each occurs.

    ``path`` is null where that is once. ``classes`` are the different stretches, with how often each occurs and one place of it.
    """
    anchors = classes.groupBy("anchor").agg(F.count("*").alias("kinds"))
    branching = stage(anchors.filter("kinds > 1").select("anchor"))
    alone = classes.join(branching, "anchor", "left_anti").select("anchor", "whole", F.lit(0).alias("i"), F.col("at.n").cast("long").alias("n"), F.col("whole").alias("path"), F.col("copies").alias("c"))
    mixed = classes.join(branching, "anchor", "left_semi").select("at.*", "anchor", "whole", "copies")
    places = repeats.of_documents(texts, mixed, "start", "n", "anchor", "whole", "copies", once=True).filter("places IS NOT NULL")
    # Rows equal in id and text all show a stretch that stands for them.
    edges = stage(places.mapInArrow(partial(_edges, window=window), EDGES).dropDuplicates(["anchor", "whole", "i"]))
    nodes = stage(edges.groupBy("anchor", "edge").agg(
        F.sum("copies").alias("c"), (F.min("before") == F.max("before")).alias("one_in"), (F.min("after") == F.max("after")).alias("one_out")))
    stretch = Window.partitionBy("anchor", "whole").orderBy("i")
    cut = ~(F.col("one_in") & F.coalesce(F.lag("one_out").over(stretch), F.lit(False)))
    numbered = edges.join(nodes, ["anchor", "edge"]).withColumn("cut", cut).withColumn("run", F.sum(F.col("cut").cast("int")).over(stretch))
    found = numbered.groupBy("anchor", "whole", "run").agg(
        F.min("i").alias("i"), F.count("*").alias("n"), F.min_by(F.when(F.col("c") > 1, F.col("edge")), "i").alias("path"), F.max("c").alias("c"))
    out = stage(alone.unionByName(found.drop("run")))
    unstage(branching, edges, nodes)
    return out


def links(again: DataFrame, parts: DataFrame) -> DataFrame:
    """``path, back``, staged: paths that every document enters from the path ``back``, which every document leaves that way.

    So it is if a node between two stretches is passed from the one to the other as often as each of the two paths occurs at all: then no document
    begins, ends, branches off or comes in there.
    """
    ends = parts.groupBy("whole").agg(F.min_by(F.struct("path", "c"), "i").alias("first"), F.max_by(F.struct("path", "c"), "i").alias("last"))
    ends = stage(ends)
    borders = again.filter("before <> 0").groupBy("before", "whole").agg(F.count("*").alias("m"))
    left = ends.select(F.col("whole").alias("before"), F.col("last.path").alias("back"), F.col("last.c").alias("out")).filter("back IS NOT NULL")
    right = ends.select("whole", F.col("first.path").alias("path"), F.col("first.c").alias("c")).filter("path IS NOT NULL")
    passed = borders.join(left, "before").join(right, "whole").groupBy("back", "path").agg(F.sum("m").alias("m"), F.max("out").alias("out"), F.max("c").alias("c"))
    out = stage(passed.filter("m = out AND m = c").select("path", "back"))
    unstage(ends)
    return out


def chains(linked: DataFrame) -> DataFrame:
    """``path, head``: the first path of the chain each linked path stands in, by pointer jumping.

    Open pointers of one round all span the same number of links, so no two meet and no join key is frequent.
    """
    heads = linked.select(F.col("back").alias("path")).join(linked.select("path"), "path", "left_anti").select("path", F.lit(True).alias("first"))
    state = stage(linked.join(heads.withColumnRenamed("path", "back"), "back", "left").select("path", F.col("back").alias("head"), F.coalesce("first", F.lit(False)).alias("done")))
    while state.filter("NOT done").limit(1).count():
        via = state.select(F.col("path").alias("head"), F.col("head").alias("to"), F.col("done").alias("there"))
        jumped = state.filter("NOT done").join(via, "head").select("path", F.col("to").alias("head"), F.col("there").alias("done"))
        older, state = state, stage(state.filter("done").unionByName(jumped))
        unstage(older)
    return state.select("path", "head")


def repeated_paths(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc_id, _h, start, n, path``: where a document enters a chain of repeated edges, of ``n`` in all."""
    again = repeats.met_again(texts, "words", window, anchor, links=True)
    classes = stage(again.groupBy("anchor", "whole").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "_h", "start", "n")).alias("at")))
    parts = paths(texts, classes, window)
    linked = links(again, parts)
    of = chains(linked)
    known = parts.filter("path IS NOT NULL").select("path", "n").distinct().join(of, "path", "left")
    long = known.groupBy(F.coalesce("head", "path").alias("path")).agg(F.sum("n").alias("n"))
    entered = stage(parts.filter("path IS NOT NULL").select("anchor", "whole", "i", "path").join(long, "path"))
    out = stage(again.join(entered.withColumnRenamed("n", "all"), ["anchor", "whole"]).select(
        "doc_id", "_h", (F.col("start") + F.col("i")).alias("start"), F.col("all").alias("n"), "path"))
    unstage(again, classes, parts, linked, entered)
    return out


def _digest_places(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("start", pa.int64()), ("path", pa.int64()), ("digest", pa.binary())])
    for batch in batches_of(batches):
        data, offsets = flat(batch.column("text"))
        starts, ends, counts = word_bounds(data, offsets, SPACED)
        rows, (start, n, path) = repeats._columns(batch, ("start", "n", "path"))
        whole, at = data.tobytes(), start + counts[rows]
        out = []
        for a, b in zip(at.tolist(), (at + n + window - 1).tolist()):
            out.append(hashlib.blake2b(b" ".join([whole[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]), digest_size=16).digest())
        own = pa.array(rows)
        yield arrow_batch(schema, batch.column("doc_id").take(own), batch.column("_h").take(own), start, path, out)


def located(docs: DataFrame, window: int = 35, anchor: int | None = None) -> DataFrame:
    """``doc_id, _h, text, places, wrong``: every row with where it enters repeated spans (``start, n, path``), for ``n`` windows each.

    Words are runs of anything but ASCII white space, unchanged; windows are ``window`` consecutive words of one row. Rows are documents, also where they
    are equal. A null text has no words. Places come in no order and are null for none. ``wrong`` lists starts at which no
    other row has the same words after all, as only two hashes were equal. Other columns of ``docs`` are not read.
    """
    texts = keyed(docs)
    found = repeated_paths(texts, window, anchor or max(1, min(ANCHOR, window // 2)))
    placed = stage(repeats.of_documents(texts, found, "start", "n", "path", once=True))
    unstage(found)
    read = placed.filter("places IS NOT NULL").mapInArrow(partial(_digest_places, window=window), "doc_id long, _h long, start long, path long, digest binary")
    single = read.groupBy("path", "digest").agg(F.count("*").alias("c"), F.first(F.struct("doc_id", "_h", "start")).alias("at")).filter("c = 1")
    wrong = stage(single.select("at.*").groupBy("doc_id", "_h").agg(F.collect_list("start").alias("wrong")))
    return placed.join(wrong, on_key(placed, wrong), "left").select(placed["doc_id"], placed["_h"], placed["text"], "places", "wrong")


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches with their bytes, the bounds of their words, the words before each text, and which words go."""
    for batch in batches_of(batches):
        data, offsets = flat(batch.column("text"))
        starts, ends, counts = word_bounds(data, offsets, SPACED)
        rows, (start, n) = repeats._columns(batch, ("start", "n"))
        if batch.column("wrong").null_count < batch.num_rows:
            wrong = batch.column("wrong").to_pylist()
            right = np.array([s not in (wrong[r] or ()) for r, s in zip(rows, start.tolist())], bool)
            rows, start, n = rows[right], start[right], n[right]
        gone = repeats.covered(start + counts[rows], n, window, len(starts))
        yield batch, data, starts, ends, counts, gone


def _digests(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    for batch, data, starts, ends, counts, gone in _cut(batches, window):
        removed = np.concatenate([[0], np.cumsum(gone)])
        out = [hashlib.sha256(kept).hexdigest() for kept in _kept(data, starts, ends, counts, gone)]
        yield arrow_batch(schema, batch.column("doc_id"), np.diff(counts), np.diff(removed[counts]), out)


def _kept(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, gone: np.ndarray) -> Iterator[bytes]:
    """The words of each text that stay, joined by one space."""
    whole = data.tobytes()
    for a, b in zip(counts[:-1], counts[1:]):
        stay = np.flatnonzero(~gone[a:b]) + a
        yield b" ".join([whole[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist())])


def digests(docs: DataFrame, window: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row: the words that no repeated window covers."""
    return located(docs, window).mapInArrow(partial(_digests, window=window), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("passage", pa.string())])
    for batch, data, starts, ends, counts, gone in _cut(batches, window):
        whole, ids = data.tobytes(), batch.column("doc_id").to_pylist()
        for i, (a, b) in enumerate(zip(counts[:-1], counts[1:])):
            first, last = repeats.spans_of(gone[a:b])
            if len(first):
                yield arrow_batch(schema, [ids[i]] * len(first), first, last, [whole[starts[a + s] : ends[a + e - 1]].decode("utf-8", "replace") for s, e in zip(first, last)])


def repeated_spans(docs: DataFrame, window: int = 35) -> DataFrame:
    """``doc_id, start, end, passage``: the longest spans of words of each document that repeated windows cover, and their text."""
    return located(docs, window).filter("places IS NOT NULL").mapInArrow(partial(_spans, window=window), "doc_id long, start long, end long, passage string")
