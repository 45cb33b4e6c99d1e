"""Sum-of-squares packing of tokenised documents into sequences of one size.

Documents become token ids in parallel; only those above the size of a sequence are cut. Pieces that
fill a sequence are done. The others are dealt at random over shards, each packed by one task: a piece goes to
the bin, or opens the bin, that leaves the smallest sum of squared counts of open bins over all residual gaps.
A shard holds some ten thousand pieces, known by their length alone, so its work does not depend on how
long documents are, and only the bins it leaves open at its end are lost to the split.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import arrow_batch, batches_of, stage

_ENCODERS: dict[str, object] = {}


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level vocabulary, whose entries stand for bytes by printable characters."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return {bytes(of[c] for c in entry): i for entry, i in vocabulary.items()}


def encoder(path: str):
    """The tokenizer of a byte-level BPE file, run by tiktoken: the same ids, several times as fast."""
    import public_tokenizers
    import tiktoken

    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = byte_ranks({w: i for w, i in spec["model"]["vocab"].items() if w not in special})
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and end of the pieces of ``n`` tokens: full ones, after a first that takes the rest."""
    first = n % size or min(n, size)
    return [(0, first), *((a, a + size) for a in range(first, n, size))] if n else []


def _cut_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema, path: str, size: int, end_id: int, ids: bool) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode_to_numpy
    for batch in batches_of(batches):
        out: list[list] = [[] for _ in schema]
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
            tokens = np.append(encode((text or b"").decode("utf-8", "replace"), allowed_special="all"), end_id).astype("<u4")
            for i, (a, b) in enumerate(cut(len(tokens), size)):
                for column, value in zip(out, (doc, i, a, b - a, zlib.crc32(tokens[a:b].tobytes()), tokens[a:b].astype(np.int32))):
                    column.append(value)
        yield arrow_batch(schema, *out)


def pieces(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, ids: bool = True) -> DataFrame:
    """Pieces of at most ``size`` tokens: ``doc_id, piece, start, length, ids_crc32`` and, unless ``ids`` is False, the token ids.

    Each text, null counting as empty, is followed by ``end_id``, so an empty one is a piece of one token. Only longer
    ones are cut; the first piece takes what does not fill a sequence. Repeated rows are packed as often as they occur.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
    schema = pa.schema(fields if ids else fields[:-1])
    spark_schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return texts.mapInArrow(partial(_cut_batches, schema=schema, path=path, size=size, end_id=end_id, ids=ids), spark_schema)


def place(lengths: np.ndarray, size: int, last: float = 0.1, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, all between 1 and ``size``.

    Lengths above half a bin come first, longest first: no two share a bin. The others follow in random order, as the rule
    likes best. At the end the open bins are of no more use to anyone, so the ``last`` share of the pieces, longest first, goes
    where the least room is left.
    """
    order = np.random.default_rng(seed).permutation(len(lengths))
    large = order[lengths[order] * 2 > size]
    small = order[lengths[order] * 2 <= size]
    tail = int(len(small) * last)
    by_length = lambda at: at[np.argsort(-lengths[at], kind="stable")]
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    counts = np.zeros(size + 1, np.int64)
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    never = 1 << 60

    def put(i: int, level: int, n: int) -> None:
        nonlocal made
        if level:
            bins[i] = open_at[level].pop()
            counts[level] -= 1
        else:
            bins[i] = made
            made += 1
        offsets[i] = level
        if level + n < size:
            open_at[level + n].append(int(bins[i]))
            counts[level + n] += 1

    for i in np.concatenate([by_length(large), small[tail:]]):
        n, level = int(lengths[i]), 0
        if n < size:
            # The change of the sum of squares if the piece goes to a bin filled to 1 .. size - n; a bin that it fills counts no more.
            now = counts[1 : size - n + 1]
            change = 2 * (counts[1 + n :] - now) + 2
            change[-1] = 1 - 2 * now[-1]
            change[now == 0] = never
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            level = best + 1 if change[best] <= 2 * counts[n] + 1 else 0
        put(int(i), level, n)
    for i in by_length(small[:tail]):
        n = int(lengths[i])
        there = np.flatnonzero(counts[1 : size - n + 1])
        put(int(i), int(there[-1]) + 1 if len(there) else 0, n)
    return bins, offsets


def _pack_shard(key: tuple, rows: pd.DataFrame, size: int) -> pd.DataFrame:
    bins, offsets = place(rows["length"].to_numpy(), size, seed=int(key[0]))
    rows = rows.drop(columns="_shard")
    rows["sequence_id"], rows["offset"] = 2 * ((int(key[0]) << 32) + bins), offsets
    return rows


def pack(cut_pieces: DataFrame, size: int = 1024, shard: int = 25_000) -> DataFrame:
    """``cut_pieces`` with ``sequence_id`` and ``offset``: pieces of one sequence fill it from 0 without a gap.

    Any columns beside ``length`` are passed on. About ``shard`` pieces that do not fill a sequence are packed together.
    The order and the shards come from the rows' places, so equal rows, null ids or one frequent id pack like any others.
    """
    part = cut_pieces.filter(F.col("length") < size)
    shards = max(1, round(part.count() / shard))
    dealt = part.withColumn("_shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)))
    schema = ", ".join(f"`{c}` {t}" for c, t in cut_pieces.dtypes) + ", sequence_id long, offset long"
    packed = dealt.groupBy("_shard").applyInPandas(lambda key, rows: _pack_shard(key, rows, size), schema)
    full = cut_pieces.filter(F.col("length") >= size).withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(full)


def packed_documents(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, ids: bool = False) -> DataFrame:
    """``pieces`` of ``docs``, staged, and ``pack``."""
    return pack(stage(pieces(docs, path, size, end_id, ids)), size)
