"""Benchmark decontamination with an FM-index per training shard.

A shard is one batch of documents. Its words become ids of the words that test phrases are made of; all others end a
run, and only runs as long as the shortest phrase can hold one. The index stands over these runs: the Burrows-Wheeler transform
in a wavelet matrix, with every eighth text position sampled. All phrases are searched backward together, their occurrences located
through the samples, and the spans they cover merged. Documents stay where they were read; only phrases travel, in
blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import ALNUM, LOWER, arrow_batch, batches_of, flat, keyed, stage, text_key, word_bounds, word_hashes

SAMPLE = 8
#: Characters of test items whose phrases travel as one block.
BLOCK_CHARS = 8_000_000
SPANS = "doc_id long, _h long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_ROWS = f"{SPANS}, row long"


class WaveletMatrix:
    """Ranks of any symbol at any place, by one bit vector for each bit of the symbols."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.levels = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (text >> bit) & 1
            count = np.zeros(len(text) + 1, np.int32)
            np.cumsum(ones, out=count[1:])
            self.levels.append((bit, count, len(text) - int(count[-1])))
            text = np.concatenate([text[ones == 0], text[ones == 1]])

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            one = ones[at]
            at = np.where((symbols >> bit) & 1, zeros + one, at - one)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the place."""
        return self._down(symbols, at) - self._down(symbols, np.zeros(len(at), np.int64))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; ``text`` ends with its smallest symbol, which stands nowhere else."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, step = len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        changed = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank[order] = changed
        if changed[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search and location in a text of symbols 1 .. ``symbols`` - 1; 0 is its end."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.append(text, 0)
        suffixes = suffix_order(text)
        self.n, self.bwt = len(text), text[suffixes - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.ranks = WaveletMatrix(self.bwt, symbols)
        marked = suffixes % SAMPLE == 0
        self.marked, self.marks, self.samples = marked, np.cumsum(marked) - 1, suffixes[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix array that begin with each phrase (padded at its end): first, and behind the last."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for i in range(phrases.shape[1] - 1, -1, -1):
            at = np.flatnonzero((lengths > i) & (lo < hi))
            s = phrases[at, i]
            lo[at], hi[at] = self.before[s] + self.ranks.rank(s, lo[at]), self.before[s] + self.ranks.rank(s, hi[at])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back through the text up to the next sample."""
        out, steps, at = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy()
        going = np.arange(len(rows))
        while len(going):
            there = self.marked[at[going]]
            done = going[there]
            out[done] = self.samples[self.marks[at[done]]] + steps[done]
            going = going[~there]
            s = self.bwt[at[going]]
            at[going] = self.before[s] + self.ranks.rank(s, at[going])
            steps[going] += 1
        return out


@dataclass
class Phrases:
    """Distinct phrases as word ids (from 2, in the order of ``words``), and the items each one stands in."""

    words: np.ndarray
    ids: np.ndarray
    lengths: np.ndarray
    item_of: np.ndarray  # pairs of phrase and item, by phrase
    phrase_at: np.ndarray  # where the pairs of each phrase begin
    names: list[str]


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many stand before each text (and in all)."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, counts = word_bounds(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), counts


def phrases_of(items: list[tuple[object, str | None]], size: int) -> Phrases | None:
    """All runs of ``size`` words of the items; an item of fewer words, but not none, is one phrase."""
    hashes, counts = hashed_words(pa.array([t for _, t in items], pa.large_string()))
    words, ids = np.unique(hashes, return_inverse=True)
    rows, owner, lengths = [], [], []
    for i in range(len(items)):
        own = ids[counts[i] : counts[i + 1]] + 2
        for a in range(max(1, len(own) - size + 1) if len(own) else 0):
            part = own[a : a + size]
            rows.append(np.pad(part, (0, size - len(part))))
            owner.append(i)
            lengths.append(len(part))
    if not rows:
        return None
    distinct, of = np.unique(np.array(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([of.ravel(), np.array(owner)], 1), axis=0)
    return Phrases(words, distinct, (distinct > 0).sum(1), pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), [str(k) for k, _ in items])


def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1 .. of each range, one after the other."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())


def occurrences(hashes: np.ndarray, counts: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence in a shard: phrase, and its first word."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(hashes):
        return none
    found = np.searchsorted(p.words, hashes)
    known = p.words[np.minimum(found, len(p.words) - 1)] == hashes
    cut = np.zeros(len(hashes) + 1, bool)
    cut[counts] = True  # a run ends with its document
    first = known.copy()
    first[1:] &= ~known[:-1] | cut[1:-1]
    last = known.copy()
    last[:-1] &= ~known[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    keep = ends - starts >= p.lengths.min()
    starts, lengths = starts[keep], (ends - starts)[keep]
    if not len(starts):
        return none
    # Each run is followed by the separator 1.
    source = _expand(starts, lengths + 1)
    text = np.where(source < np.repeat(starts + lengths, lengths + 1), found[np.minimum(source, len(found) - 1)] + 2, 1)
    index = FMIndex(text, len(p.words) + 2)
    lo, hi = index.search(p.ids, p.lengths)
    n = np.maximum(hi - lo, 0)
    return np.repeat(np.arange(len(n)), n), source[index.locate(_expand(lo, n))]


def _search(batches: Iterator[pa.RecordBatch], phrases, hits_only: bool = False) -> Iterator[pa.RecordBatch]:
    """Spans and items of each row; with a column ``row`` behind the text it is passed on. ``hits_only``: of rows with a span."""
    schema = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])
    p = phrases.value
    for batch in batches_of(batches):
        hashes, counts = hashed_words(batch.column(2))
        phrase, at = occurrences(hashes, counts, p) if p else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        doc = np.searchsorted(counts, at, "right") - 1
        spans: list[list] = [[] for _ in range(batch.num_rows)]
        items: list[list] = [[] for _ in range(batch.num_rows)]
        if len(at):
            # Words that some occurrence covers, as merged spans of one document each.
            depth = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(depth, at, 1)
            np.add.at(depth, at + p.lengths[phrase], -1)
            hit = np.cumsum(depth[:-1]) > 0
            cut = np.zeros(len(hashes) + 1, bool)
            cut[counts] = True
            before, behind = np.append(False, hit[:-1]), np.append(hit[1:], False)
            for a, b in zip(np.flatnonzero(hit & (~before | cut[:-1])), np.flatnonzero(hit & (~behind | cut[1:])) + 1):
                d = int(np.searchsorted(counts, a, "right")) - 1
                spans[d].append({"start": int(a - counts[d]), "end": int(b - counts[d])})
            pairs = np.unique(np.stack([doc, phrase], 1), axis=0)
            for d, f in pairs:
                items[d] += [p.names[i] for i in p.item_of[p.phrase_at[f] : p.phrase_at[f + 1]]]
        out = arrow_batch(schema, batch.column(0), batch.column(1), np.diff(counts), spans, [sorted(set(x)) for x in items])
        if "row" in batch.schema.names:
            out = out.append_column("row", batch.column("row"))
        yield out.filter(pa.array([len(x) > 0 for x in spans], pa.bool_())) if hits_only else out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and items of several blocks of phrases, as one."""
    for batch in batches:
        merged, items = [], []
        for spans, names in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            out: list[dict] = []
            for s in sorted(spans, key=lambda s: s["start"]):
                if out and s["start"] <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], s["end"])
                else:
                    out.append(s)
            merged.append(out)
            items.append(sorted(set(names)))
        yield arrow_batch(batch.schema, *(batch.column(i) for i in range(3)), merged, items)


def removal_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``doc_id, _h, n_words, spans, items``: the words of each document that test phrases cover, and the items they are from.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z in lower case; phrases are ``size`` consecutive
    words of an item, or a whole shorter one. Spans count words from 0, are disjoint and in order. A null or empty text has no word, and such an item
    no phrase. Items with the same text are all named; rows of one document with equal text come out as often as they go in.
    The phrases travel in blocks of at most ``BLOCK_CHARS`` characters of items, or one item.
    """
    spark = docs.sparkSession
    texts = keyed(docs)
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].alias("text"))
    blocks = max(1, -(-int(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS))
    if blocks > 1:
        # Rows are numbered once, so that each is merged with itself only, whatever ids and texts repeat.
        texts = stage(texts.withColumn("row", F.monotonically_increasing_id()))
    found = []
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        phrases = spark.sparkContext.broadcast(phrases_of([tuple(r) for r in part.toLocalIterator()], size))
        found.append(texts.mapInArrow(partial(_search, phrases=phrases, hits_only=b > 0), SPANS if blocks == 1 else _ROWS))
    if blocks == 1:
        return found[0]
    every = found[0]
    for df in found[1:]:
        every = every.unionByName(df)
    merged = (F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items"))
    both = every.groupBy("row").agg(*(F.first(c).alias(c) for c in ("doc_id", "_h", "n_words")), *merged)
    return both.drop("row").mapInArrow(_merge, SPANS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
    for batch in batches:
        hits = [sum(s["end"] - s["start"] for s in spans) for spans in batch.column(3).to_pylist()]
        items = batch.column(4).to_pylist()
        yield arrow_batch(schema, batch.column(0), batch.column(2), hits, [len(x) for x in items], [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], [h > 0 for h in hits])


def digests(spans: DataFrame) -> DataFrame:
    """Counts and a digest of the items for each document."""
    return spans.mapInArrow(_digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches):
        data, offsets = flat(batch.column("text"))
        starts, ends, counts = word_bounds(LOWER[data], offsets, ALNUM)
        texts, whole = [], data.tobytes()
        for i, spans in enumerate(batch.column("__spans").to_pylist()):
            at, parts = int(offsets[i]), []
            for s in spans or ():
                parts.append(whole[at : starts[counts[i] + s["start"]]])
                at = int(ends[counts[i] + s["end"] - 1])
            texts.append(b"".join([*parts, whole[at : offsets[i + 1]]]))
        nulls = batch.column("text").is_null().to_numpy(zero_copy_only=False)
        cleaned = pa.array([None if null else t for t, null in zip(texts, nulls)], pa.binary()).view(pa.string())
        names = [n for n in batch.schema.names if n not in ("text", "__spans")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), cleaned], names=[*names, "text"])


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` with all columns; every span that test phrases cover is cut out, from its first word to its last."""
    found = removal_spans(docs, benchmark, size).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "_h"])
    marked = docs.withColumn("__h", text_key(docs["text"]))
    same = (marked["__h"] == found["_h"]) & marked["doc_id"].cast("long").eqNullSafe(found["doc_id"])
    both = marked.join(found, same, "left").select(*(marked[f"`{c}`"] for c in docs.columns if c != "text"), found["spans"].alias("__spans"), marked["text"])
    kinds = dict(docs.dtypes)
    out = both.mapInArrow(_without, ", ".join(f"`{c}` {kinds[c]}" for c in [*(c for c in docs.columns if c != "text"), "text"]))
    return out.select(*(out[f"`{c}`"] for c in docs.columns))
