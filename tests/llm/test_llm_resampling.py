import hashlib
import math
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flightlake.llm import queries, resampling


def features(text, runs=1):
    words = brute.ALNUM.findall((text or "").translate(brute.LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def plain_resampling(rows, items, min_words=20, percent=10, runs=1, buckets=10_000):
    """(doc_id, n_features, weight, score) of every row, and the scores and ids that are drawn, best first."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    source, target = [0] * buckets, [0] * buckets
    for counts, texts in ((source, rows), (target, items)):
        for _, t in texts:
            for f in features(t, runs)[1]:
                counts[bucket(f)] += 1
    s_all, t_all = sum(source), sum(target)
    gain = [math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for s, t in zip(source, target)]
    out, taking = [], []
    for d, t in rows:
        words, found = features(t, runs)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((d, len(found), weight, score))
        if len(words) >= min_words:
            taking.append((score, d))
    taking.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
    return out, taking[: percent * len(taking) // 100]


def check(got, rows, items, **options):
    want, drawn = plain_resampling(rows, items, **options)
    assert sorted((r[:4] for r in got), key=repr) == sorted(want, key=repr)
    best = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in best] == list(range(1, len(drawn) + 1))
    assert [(r["score"], r["doc_id"]) for r in best] == drawn


@pytest.mark.parametrize(("runs", "samples", "segment"), [(1, 200_000, 1_000_000), (3, 50, 7)])
def test_against_plain_version(spark, monkeypatch, runs, samples, segment):
    monkeypatch.setattr(resampling, "SAMPLES", samples)
    monkeypatch.setattr(resampling, "SEGMENT", segment)
    rows, items = brute.corpus(n=120) + [(7, "tie " * 25)] * 40, [(i, t) for i, t in brute.corpus(seed=3, n=20)]
    docs = brute.frame(spark, rows).repartition(5)
    got = resampling.resampled(docs, brute.frame(spark, items), percent=60, spec=resampling.Features(runs, 500)).collect()
    check(got, rows, items, percent=60, runs=runs, buckets=500)


def test_empty_tables(spark):
    empty = brute.frame(spark, [])
    assert resampling.resampled(empty, empty).collect() == []
    rows = brute.corpus(n=30)
    check(resampling.resampled(brute.frame(spark, rows), empty, percent=100).collect(), rows, [], percent=100)
    check(resampling.resampled(brute.frame(spark, rows), brute.frame(spark, rows), percent=0).collect(), rows, rows, percent=0)


def test_query_on_whole_tables(spark):
    sf = "/root/testdata/sf0.01"
    rows, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    check(queries.op13_importance_resampling(spark, sf).collect(), rows, items)


def test_one_score_for_most_rows(spark, monkeypatch):
    """Equal keys spread over segments; every rank is given once."""
    monkeypatch.setattr(resampling, "SEGMENT", 50)
    scores = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"), F.lit(1).cast("long").alias("n_features"), F.lit(2).cast("long").alias("weight"), F.when(F.col("id") % 3 > 0, F.lit(9)).otherwise(F.col("id") % 10).cast("long").alias("score"), F.lit(30).cast("long").alias("n_words")).repartition(6)
    got = resampling.ranked(scores, F.col("n_words") >= 20, 100).collect()
    best = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in best] == list(range(1, 2001))
    assert [(-r["score"], r["doc_id"]) for r in best] == sorted((-r["score"], r["doc_id"]) for r in got)


def test_crc_of_long_and_short_words():
    rng = random.Random(1)
    words = [bytes(rng.randrange(97, 123) for _ in range(n)) for n in [1, 2, 47, 48, 49, 50, 500, 3, 9000, 8]]
    data = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths + 1) - lengths - 1
    got = ~resampling.crc_on(np.full(len(words), 0xFFFFFFFF, np.uint32), data, starts, lengths)
    assert got.tolist() == [zlib.crc32(w) for w in words]
    assert resampling.features_of(pa.array([], pa.string()), resampling.Features())[0].tolist() == []
