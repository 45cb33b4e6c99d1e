import brute
import numpy as np
import pytest

from flightlake.llm import contamination


def items(spark, rows):
    return spark.createDataFrame([(k, t, 1) for k, t in rows], "item_id long, text string, doc_id long")


ITEMS = [(1, "w1 w2 w3 w1 W2"), (2, "w3"), (3, None), (4, ""), (5, "w1 w2 w3 w1 W2"), (10, "no such words at all here"), (6, "ab ab ab ab"), (7, "Common line")]


@pytest.mark.parametrize(("size", "block"), [(3, 8_000_000), (2, 12), (10, 8_000_000)])
def test_spans(spark, rows, monkeypatch, size, block):
    monkeypatch.setattr(contamination, "BLOCK_CHARS", block)
    corpus = [(d, t) for d, t in brute.corpus(0, n=40) if d is not None][:-1]
    got = rows(contamination.digests(contamination.removal_spans(brute.frame(spark, corpus), items(spark, ITEMS), size)))
    assert got == sorted(brute.contamination(corpus, ITEMS, size), key=repr)


def test_nulls_and_repeated_rows(spark, rows):
    corpus = brute.corpus(1, n=20)
    got = rows(contamination.digests(contamination.removal_spans(brute.frame(spark, corpus), items(spark, ITEMS), 3)))
    assert got == sorted(brute.contamination(corpus, ITEMS, 3), key=repr)


def test_nulls_and_repeated_rows_over_several_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_CHARS", 12)
    corpus = [*brute.corpus(1, n=20), (None, "w1 w2 w3 and so on"), (None, "w1 w2 w3 and so on"), (None, "no such words at all here")]
    got = rows(contamination.digests(contamination.removal_spans(brute.frame(spark, corpus), items(spark, ITEMS), 3)))
    assert got == sorted(brute.contamination(corpus, ITEMS, 3), key=repr)


def test_empty_tables(spark, rows):
    assert rows(contamination.removal_spans(brute.frame(spark, []), items(spark, ITEMS))) == []
    got = rows(contamination.digests(contamination.removal_spans(brute.frame(spark, [(1, "a b")]), items(spark, []))))
    assert got == [(1, 2, 0, 0, brute.sha(b""), False)]


def test_spans_are_cut_out(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    corpus = [(1, f"before, {item.title()}! after"), (2, "clean: text\n stays."), (3, None)]
    docs = brute.frame(spark, corpus)
    out = contamination.without_spans(docs, items(spark, [(1, item)]))
    assert out.dtypes == docs.dtypes
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "before, ! after", 2: "clean: text\n stays.", 3: None}


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(0)
    text = rng.integers(1, 6, 500)
    index = contamination.FMIndex(text, 6)
    phrases = rng.integers(2, 6, (30, 4))
    lengths = rng.integers(1, 5, 30)
    lo, hi = index.search(phrases, lengths)
    for p, n, a, b in zip(phrases, lengths, lo, hi):
        found = sorted(index.locate(np.arange(a, max(a, b))).tolist())
        assert found == [i for i in range(501 - n) if (text[i : i + n] == p[:n]).all()]
