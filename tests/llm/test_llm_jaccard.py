import random

import brute
import numpy as np
import pytest

from flightlake.llm import common, jaccard


def joined(df):
    return df.select("doc_id", "n_shingles", "component_id")


@pytest.mark.parametrize(("seed", "size", "percent"), [(0, 4, 85), (1, 3, 60), (2, 5, 80)])
def test_components(spark, rows, seed, size, percent):
    corpus = brute.corpus(seed, n=90)
    got = rows(joined(jaccard.jaccard_components(brute.frame(spark, corpus), size, percent)))
    assert got == sorted(brute.jaccard(corpus, size, percent), key=repr)


def test_large_group_of_near_copies_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"t{i}" for i in range(120)]
    corpus = [(0, " ".join(base))]
    for i in range(1, 90):
        w = list(base)
        for _ in range(rng.randrange(1, 7)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(1000)}"
        corpus.append((i, " ".join(w)))
    got = rows(joined(jaccard.jaccard_components(brute.frame(spark, corpus), 4, 85)))
    assert got == sorted(brute.jaccard(corpus, 4, 85), key=repr)


def test_threshold_is_exact(spark, rows):
    a = [f"a{i}" for i in range(23)]  # 20 shingles of 4 words; 17 shared of 20 united
    corpus = [(1, " ".join(a)), (2, " ".join(a[:20]))]
    assert {r[2] for r in rows(joined(jaccard.jaccard_components(brute.frame(spark, corpus), 4, 85)))} == {1}
    assert {r[2] for r in rows(joined(jaccard.jaccard_components(brute.frame(spark, corpus), 4, 86)))} == {1, 2}


def test_one_of_each(spark):
    corpus = [(3, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (2, "other words stand here now"), (None, "a b c d e f"), (7, None), (8, "")]
    docs = brute.frame(spark, corpus)
    out = jaccard.one_of_each(docs)
    assert out.dtypes == docs.dtypes
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 2), (False, 7), (False, 8), (True, 0)]


def test_histograms_never_overstate():
    rng = np.random.default_rng(0)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        x, y = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        hist = jaccard._opened(common.pa.array([jaccard.histogram(x), jaccard.histogram(y)]))
        apart = np.abs(hist[0].astype(int) - hist[1]).sum()
        assert apart <= len(np.setxor1d(x, y))


def test_empty_table(spark, rows):
    assert rows(jaccard.jaccard_components(brute.frame(spark, []))) == []


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in common.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
