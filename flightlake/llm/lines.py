"""Line deduplication over range-partitioned hashes: frequent lines go, found without moving any text.

One row per line, a 128-bit hash with its document and position, is dealt by ranges of (hash, document, position) and sorted
by them. A frequent line therefore spreads over as many ranges as it fills; nothing gathers in one task. Each task streams
its range and holds back at most the first occurrences of one line, until enough documents have shown it. Only the first
and last line of a range can go on in another one; the few occurrences of those that are still undecided are counted again, together.
The outcome is one compressed bitmap for each document that loses a line.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import arrow_batch, batches_of, keyed, on_key, stage, text_key

#: Stripped from both ends of a line before it is compared.
BLANKS = b" \t\n\x0b\x0c\r"
_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("_h", pa.int64()), ("line", pa.int32())])
_FOUND = pa.schema([("kind", pa.int32()), *_LINES])
_COLUMNS = "h1 long, h2 long, doc_id long, _h long, line int"
DROP, OPEN, FULL = 0, 1, 2


def _hash_lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches_of(batches, limit=4 << 20):
        hashes, docs, marks, lines = [], [], [], []
        for doc, mark, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2).cast(pa.large_binary()).to_pylist()):
            for i, line in enumerate((text or b"").split(b"\n")):
                key = line.strip(BLANKS).lower()
                if key and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars):
                    hashes.append(digest(key))
                    docs.append(doc)
                    marks.append(mark)
                    lines.append(i)
        if hashes:
            both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield arrow_batch(_LINES, both[:, 0].copy(), both[:, 1].copy(), docs, marks, lines)


def _new(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _rows(kind: int, table: list[np.ndarray], at: np.ndarray) -> pa.RecordBatch:
    return arrow_batch(_FOUND, np.full(len(at), kind, np.int32), *(c[at] for c in table))


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Of one sorted range: positions to drop, positions of undecided lines at its ends, and lines known to be frequent at its ends.

    Between batches it keeps the rows of the line that the last batch ended in, until they are decided.
    """
    held: list[np.ndarray] | None = None  # rows of the line that goes on, while undecided
    full: tuple[int, int] | None = None  # that line, once it is frequent
    opening = True  # no line has ended yet: the first may have begun in the range before
    for batch in batches:
        if not batch.num_rows:
            continue
        # A null id takes part as the smallest one; its rows are told apart by the hash of their text.
        t = [(c.fill_null(-(1 << 63)) if c.null_count else c).to_numpy(zero_copy_only=False) for c in batch.columns]
        if full is not None:
            same = int(np.searchsorted((t[0] != full[0]) | (t[1] != full[1]), True))
            yield _rows(DROP, t, np.arange(same))
            t = [c[same:] for c in t]
            if not len(t[0]):
                continue
            if opening:
                yield arrow_batch(_FOUND, [FULL], [full[0]], [full[1]], [0], [0], [0])
            full, opening = None, False
        if held is not None:
            t = [np.concatenate(x) for x in zip(held, t)]
        runs = np.flatnonzero(_new(t[0], t[1]))
        docs = np.add.reduceat(_new(*t[:4]).astype(np.int64), runs)
        frequent = docs >= min_docs
        lengths = np.diff(np.append(runs, len(t[0])))
        yield _rows(DROP, t, np.flatnonzero(np.repeat(frequent, lengths)))
        if opening and len(runs) > 1:
            if frequent[0]:
                yield arrow_batch(_FOUND, [FULL], [t[0][0]], [t[1][0]], [0], [0], [0])
            else:
                yield _rows(OPEN, t, np.arange(lengths[0]))
            opening = False
        if frequent[-1]:
            held, full = None, (int(t[0][-1]), int(t[1][-1]))
        else:
            held = [c[runs[-1] :] for c in t]
    if full is not None:
        yield arrow_batch(_FOUND, [FULL], [full[0]], [full[1]], [0], [0], [0])
    elif held is not None:
        yield _rows(OPEN, held, np.arange(len(held[0])))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("keep", pa.binary())])
    for batch in batches:
        maps = []
        for lines in batch.column(2).to_pylist():
            keep = np.ones(max(lines) // 8 * 8 + 8, bool)
            keep[lines] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield arrow_batch(schema, batch.column(0), batch.column(1), maps)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``doc_id, _h, keep`` for each document that loses a line; all other documents keep all of theirs.

    A line is compared by its text without ASCII white space at both ends and with A-Z in lower case. Lines of at least
    ``min_chars`` code points (and never empty ones) found in at least ``min_docs`` documents go everywhere. ``keep`` is a
    zlib-compressed bitmap, one bit per line in order, ending with the byte of the last line that goes; later lines stay. A null text is one
    empty line. Rows equal in id and text count as one document; columns other than ``doc_id`` and ``text`` are not read.
    """
    lines = keyed(docs).select("doc_id", "_h", "text").mapInArrow(partial(_hash_lines, min_chars=min_chars), _COLUMNS)
    order = ["h1", "h2", "doc_id", "_h", "line"]
    found = stage(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(partial(_stream, min_docs=min_docs), f"kind int, {_COLUMNS}"))
    ends = found.filter(F.col("kind") != DROP)
    enough = (F.max("kind") == FULL) | (F.count_distinct(F.when(F.col("kind") == OPEN, F.struct("doc_id", "_h"))) >= min_docs)
    frequent = ends.groupBy("h1", "h2").agg(enough.alias("enough")).filter("enough").select("h1", "h2")
    late = ends.filter(F.col("kind") == OPEN).join(frequent, ["h1", "h2"], "left_semi")
    # A null id came out as the smallest long; it goes back to null.
    doc_id = F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")).alias("doc_id")
    dropped = found.filter(F.col("kind") == DROP).unionByName(late).select(doc_id, "_h", "line")
    grouped = dropped.groupBy("doc_id", "_h").agg(F.collect_list("line").alias("lines"))
    return grouped.mapInArrow(_bitmaps, "doc_id long, _h long, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> tuple[list[bytes], int]:
    """The lines that stay, and the number of all lines."""
    lines = text.split(b"\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)]
    return [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]], len(lines)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
    for batch in batches_of(batches):
        out: list[list] = [[], [], []]
        for text, keep in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
            stay, n = kept_lines(text or b"", keep)
            for column, x in zip(out, (n, n - len(stay), hashlib.sha256(b"\n".join(stay)).hexdigest())):
                column.append(x)
        yield arrow_batch(schema, batch.column(0), *out)


def digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row: the bitmaps applied to the texts."""
    left = keyed(docs)
    both = left.join(bitmaps, on_key(left, bitmaps), "left").select(left["doc_id"], left["text"], bitmaps["keep"])
    return both.mapInArrow(_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches):
        texts = []
        for text, keep in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("__keep").to_pylist()):
            texts.append(None if text is None else b"\n".join(kept_lines(text, keep)[0]))
        names = [n for n in batch.schema.names if n not in ("text", "__keep")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.binary()).view(pa.string())], names=[*names, "text"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with all its columns and without the dropped lines; a null text stays null."""
    marked = docs.withColumn("__h", text_key(docs["text"]))
    same = (marked["__h"] == bitmaps["_h"]) & marked["doc_id"].cast("long").eqNullSafe(bitmaps["doc_id"])
    rest = [c for c in docs.columns if c != "text"]
    both = marked.join(bitmaps, same, "left").select(*(marked[f"`{c}`"] for c in rest), bitmaps["keep"].alias("__keep"), marked["text"])
    kinds = dict(docs.dtypes)
    cleaned = both.mapInArrow(_apply, ", ".join(f"`{c}` {kinds[c]}" for c in [*rest, "text"]))
    return cleaned.select(*(cleaned[f"`{c}`"] for c in docs.columns))
