"""Passages, byte repeats and what both are built on, against plain versions."""

import brute
import numpy as np
import pyarrow as pa
import pytest

from flightlake.llm import passages, repeats, suffixes

EMPTY = []


@pytest.mark.parametrize("seed", [0, 1])
def test_passages(spark, rows, seed):
    corpus = brute.corpus(seed)
    assert rows(passages.digests(brute.frame(spark, corpus), window=6)) == sorted(brute.passages(corpus, 6), key=repr)


def test_passages_of_production_length(spark, rows):
    corpus = brute.corpus(2, words=90, vocabulary=400)
    corpus += [(900 + i, f"x{i} " * i + " ".join(f"p{j}" for j in range(34 + i % 3)) + f" y{i}") for i in range(12)]
    got = rows(passages.digests(brute.frame(spark, corpus)))
    assert got == sorted(brute.passages(corpus, 35), key=repr)


def test_passage_spans_carry_their_text(spark, rows):
    shared = "one two  three four"
    corpus = [(1, f"a b {shared} c"), (2, f"{shared} d"), (3, "one two")]
    assert rows(passages.repeated_spans(brute.frame(spark, corpus), window=4)) == [(1, 2, 6, shared), (2, 0, 4, shared)]


@pytest.mark.parametrize("seed", [0, 1])
def test_byte_repeats(spark, rows, seed):
    corpus = brute.corpus(seed, n=36)
    assert rows(suffixes.digests(brute.frame(spark, corpus), window=30)) == sorted(brute.repeats(corpus, 30), key=repr)


@pytest.mark.parametrize("most", [1, 4096])
def test_byte_repeats_in_small_shards_and_by_hash(spark, rows, most):
    corpus = brute.corpus(3, n=30)
    texts = brute.frame(spark, corpus)
    found = suffixes.repeated_windows(texts, window=25, anchor=9, shard=500, most=most)
    kept = repeats.of_documents(suffixes.keyed(texts), found, "start", "n")
    got = rows(kept.mapInArrow(lambda b: suffixes._digests(b, 25), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    assert got == sorted(brute.repeats(corpus, 25), key=repr)


def test_very_common_passage(spark, rows):
    passage = " ".join(f"p{i}" for i in range(12))
    corpus = [(i, f"u{i} v{i} {passage} z{i}") for i in range(60)]
    assert rows(passages.digests(brute.frame(spark, corpus), window=8)) == sorted(brute.passages(corpus, 8), key=repr)
    assert rows(suffixes.digests(brute.frame(spark, corpus), window=20)) == sorted(brute.repeats(corpus, 20), key=repr)


def test_chunks_do_not_show(spark, rows, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 50)
    texts = [t for _, t in brute.corpus(4, n=20)]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(texts)), pa.array([2] * len(texts), pa.int32()), pa.array(texts)], names=["doc_id", "_h", "text"])
    windows = sum(sum(b.column("n").to_pylist()) for b in repeats._stretches(iter([batch]), "words", 5, 2))
    assert windows == sum(max(0, len(brute.SPACED.findall(t or "")) - 4) for t in texts)


@pytest.mark.parametrize("op", [passages.digests, suffixes.digests])
def test_empty_table(spark, rows, op):
    assert rows(op(brute.frame(spark, EMPTY))) == []


def test_sliding_least():
    x = np.random.default_rng(0).integers(0, 50, 200).astype(np.uint64)
    for w in (1, 2, 7, 200):
        assert repeats.sliding_least(x, w).tolist() == [x[i : i + w].min() for i in range(201 - w)]


def test_windows_met_twice():
    rng = np.random.default_rng(0)
    segments = [bytes(rng.integers(97, 99, rng.integers(1, 40), dtype=np.uint8)) for _ in range(40)]
    copies = rng.integers(1, 3, 40)
    counts = {}
    for s, c in zip(segments, copies):
        for i in range(len(s) - 7):
            counts[s[i : i + 8]] = counts.get(s[i : i + 8], 0) + c
    wanted = {(k, i) for k, s in enumerate(segments) for i in range(len(s) - 7) if counts[s[i : i + 8]] > 1 and copies[k] == 1}
    assert set(zip(*(x.tolist() for x in suffixes.windows_met_twice(segments, copies, 8)))) == wanted


def test_paths_are_compacted_over_stretches_and_cut_at_branches(spark, rows):
    a, b = [[f"{c}{i}" for i in range(60)] for c in "ab"]
    corpus = [(1, " ".join(a)), (2, " ".join(["x"] + a + ["y"])), (3, " ".join(b)), (4, " ".join(b[:30] + a[:20])), (5, " ".join(["z"] + a + ["w"]))]
    got = rows(passages.repeated_paths(passages.keyed(brute.frame(spark, corpus)), 6, 3).select("doc_id", "start", "n"))
    # a is left after its word 20 by document 4, and documents begin and end inside others: each such node parts a path, nothing else does.
    assert got == sorted([(1, 0, 15), (1, 15, 40), (2, 1, 15), (2, 16, 40), (3, 0, 25), (4, 0, 25), (4, 30, 15), (5, 1, 15), (5, 16, 40)], key=repr)


def test_chains(spark, rows):
    linked = spark.createDataFrame([(i, i - 1) for i in range(2, 40)] + [(101, 100)], "path long, back long")
    assert rows(passages.chains(linked)) == sorted([(i, 1) for i in range(2, 40)] + [(101, 100)], key=repr)


def test_places_whose_words_differ_are_left_alone(spark, rows):
    corpus = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "v w x y z")]
    batch = pa.RecordBatch.from_pylist([{"doc_id": 3, "_h": 1, "text": "v w x y z", "places": [{"start": 0, "n": 2, "path": 7}], "wrong": [0]}])
    assert [b.column("n_removed").to_pylist() for b in passages._digests(iter([batch]), 4)] == [[0]]
    assert rows(passages.digests(brute.frame(spark, corpus), window=4)) == sorted(brute.passages(corpus, 4), key=repr)
