"""Fill-in-middle transformation by displacement scatter.

All texts of a batch lie in one byte array. A scan finds the code points, and with them the bytes at which each text is cut. How far a
byte moves in the output is constant between two cuts: a difference array holds the changes, its cumulative sum the shift of every
byte, and one scatter builds all outputs. The way back finds the three marks in each output and gathers by shifts of the same kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flightlake.llm.common import arrow_batch, batches_of, flat

MARKS = b"PSM"
#: Bytes of a mark: ``<P>``, ``<S>`` or ``<M>``.
MARK = 3
#: Order of (prefix, middle, suffix) in the output, and the order of their marks there.
ORDERS = {"psm": (b"PSM", (0, 2, 1)), "spm": (b"SPM", (1, 2, 0))}
FORMS = np.array(["plain", "psm", "spm"], object)
PLAIN, PSM, SPM = range(3)


@dataclass(frozen=True)
class Rule:
    """``seed`` of the draw, percent of the texts transformed, and percent of those with the suffix first."""

    seed: int = 1
    rate: int = 90
    spm: int = 20


def draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four 32-bit numbers of each id; a null id draws as no digits."""
    out = b"".join(hashlib.sha256(b"%d:%s" % (seed, b"" if i is None else b"%d" % i)).digest()[:16] for i in ids)
    return np.frombuffer(out, ">u4").reshape(-1, 4).astype(np.int64)


def marks_in(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions of marks; none reaches over the end of its text."""
    if len(data) < MARK:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(data[:-2] == ord("<"))
    at = at[(data[at + 2] == ord(">")) & np.isin(data[at + 1], np.frombuffer(MARKS, np.uint8))]
    return at[at + MARK <= offsets[np.searchsorted(offsets, at, "right")]]


def shifts(size: int, starts: np.ndarray, displacement: np.ndarray) -> np.ndarray:
    """Shift of each of ``size`` bytes: ``displacement[i]`` from ``starts[i]`` on. Of equal starts the last one counts."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, np.diff(displacement, prepend=0))
    return np.cumsum(change[:size])


@dataclass
class Batch:
    """Outputs of a batch of texts, one after the other, with what was drawn for each text."""

    data: np.ndarray
    offsets: np.ndarray
    n: np.ndarray
    form: np.ndarray
    prefix: np.ndarray
    middle: np.ndarray


def transformed_batch(data: np.ndarray, offsets: np.ndarray, drawn: np.ndarray, rule: Rule) -> Batch:
    starts, ends = offsets[:-1], offsets[1:]
    points = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(points, offsets)
    n = np.diff(first)
    cut = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    form = np.where(drawn[:, 3] % 100 < rule.spm, SPM, PSM)
    form[(n == 0) | (drawn[:, 2] % 100 >= rule.rate)] = PLAIN
    form[np.searchsorted(offsets, marks_in(data, offsets), "right") - 1] = PLAIN
    # The byte of a cut; code point 0 is the text's begin and the one behind the last its end.
    points = np.append(points, len(data))
    byte = np.where(cut == n[:, None], ends[:, None], points[np.minimum(first[:-1, None] + cut, len(points) - 1)])
    byte = np.where(cut == 0, starts[:, None], byte)
    moved = form != PLAIN
    out_offsets = offsets + np.concatenate([[0], np.cumsum(moved * 3 * MARK)])
    begin = np.stack([starts, byte[:, 0], byte[:, 1]], 1)  # of prefix, middle and suffix
    length = np.diff(np.concatenate([begin, ends[:, None]], 1), axis=1)
    target = begin - starts[:, None] + out_offsets[:-1, None]
    out = np.empty(out_offsets[-1], np.uint8)
    for kind, name in ((PSM, "psm"), (SPM, "spm")):
        own = np.flatnonzero(form == kind)
        marks, order = ORDERS[name]
        at = out_offsets[own]
        # The order in which marks and parts follow each other: P prefix, S suffix and M middle.
        for mark in marks:
            out[at], out[at + 1], out[at + 2] = ord("<"), mark, ord(">")
            part = {"P": 0, "M": 1, "S": 2}[chr(mark)]
            target[own, part] = at + MARK
            at = at + MARK + length[own, part]
    shift = shifts(len(data), begin.ravel(), (target - begin).ravel())
    out[np.arange(len(data)) + shift] = data
    none = np.where(moved, 0, -1)
    return Batch(out, out_offsets, n, form, np.where(moved, cut[:, 0], none), np.where(moved, cut[:, 1] - cut[:, 0], none))


def restored_batch(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts from outputs and forms alone, and where each begins."""
    moved = form != PLAIN
    marks = marks_in(data, offsets)
    marks = marks[moved[np.searchsorted(offsets, marks, "right") - 1]].reshape(-1, 3)
    sizes = np.diff(offsets) - moved * 3 * MARK
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    begin = np.repeat(offsets[:-1, None], 3, axis=1)  # in the output, of prefix, middle and suffix
    length = np.stack([sizes, np.zeros_like(sizes), np.zeros_like(sizes)], 1)
    part_begin = marks + MARK
    part_length = np.diff(np.concatenate([marks, offsets[1:][moved, None]], 1), axis=1) - MARK
    for name, column in (("P", 0), ("M", 1), ("S", 2)):
        which = data[part_begin - 2] == ord(name)
        begin[moved, column] = part_begin[which]
        length[moved, column] = part_length[which]
    to = out_offsets[:-1, None] + np.cumsum(length, axis=1) - length
    shift = shifts(out_offsets[-1], to.ravel(), (begin - to).ravel())
    return data[np.arange(out_offsets[-1]) + shift], out_offsets


def _slices(data: np.ndarray, offsets: np.ndarray) -> list[memoryview]:
    whole = memoryview(np.ascontiguousarray(data))
    return [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def _optional(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values < 0)


_TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _cut(batch: pa.RecordBatch, rule: Rule) -> Batch:
    return transformed_batch(*flat(batch.column("text")), draws(batch.column("doc_id").to_pylist(), rule.seed), rule)


def transform(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row: texts rearranged for filling in their middle.

    A text of ``n`` code points is cut at two places drawn from its id. A null text counts as empty. An empty text, one that holds a
    mark itself and the share of all texts that the rule leaves out stay ``plain``, with null for both lengths. Rows that repeat, also by
    id, come out as often as they go in; a null id draws like an id without digits. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            b = _cut(batch, rule)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(b.n, pa.int64()), pa.array(FORMS[b.form], pa.string()), _optional(b.prefix), _optional(b.middle), _texts(b.data, b.offsets)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return _documents(docs).mapInArrow(run, _TRANSFORMED)


def restore(outputs: DataFrame) -> DataFrame:
    """``doc_id, text`` of every row of ``transform``'s result, rebuilt from ``output`` and ``form`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {name: i for i, name in enumerate(FORMS)}
        for batch in batches_of(batches, "output"):
            data, offsets = flat(batch.column("output"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _texts(*restored_batch(data, offsets, np.array([kinds[f] for f in batch.column("form").to_pylist()], np.int64)))], names=["doc_id", "text"])

    return outputs.select("doc_id", "form", "output").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """As ``transform``, with SHA-256 of the output and of the text restored from it in place of the output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda parts: [hashlib.sha256(p).hexdigest() for p in parts]
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
        for batch in batches_of(batches):
            b = _cut(batch, rule)
            back = restored_batch(b.data, b.offsets, b.form)
            yield arrow_batch(schema, batch.column("doc_id"), b.n, list(FORMS[b.form]), _optional(b.prefix), _optional(b.middle), sha(_slices(b.data, b.offsets)), sha(_slices(*back)))

    return _documents(docs).mapInArrow(run, _DIGESTS)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
