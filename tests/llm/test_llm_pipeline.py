import brute
import duckdb
import pytest

import corpus_pipeline
from flightlake.llm import queries
from tools import check

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    counts = [docs.count()]
    now = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stage(step(spark, now, SMALL))
        assert now.columns == docs.columns, name
        counts.append(now.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    rows = [(r["doc_id"], r["text"]) for r in now.collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    # Cutting a span can bring words together, but hardly makes a phrase anew; near copies are gone but for what later stages cut.
    assert not [r for r in brute.contamination(rows, items, 10) if r[-1]]
    last = corpus_pipeline.STAGES[-1][1](spark, now, SMALL).collect()
    assert {r["doc_id"] for r in last} == {d for d, _ in rows}


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, name):
    out = check.compare(name, spark, check.open_tables(SMALL), SMALL)
    assert out.ok, out.detail


@pytest.mark.parametrize("name", ["op4_bwt_repeats", "op5_grouped_prefix_join"])
def test_queries_without_sql(spark, rows, name):
    corpus = [tuple(r) for r in duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY length(text) LIMIT 120").fetchall()]
    docs = brute.frame(spark, corpus)
    if name == "op4_bwt_repeats":
        assert rows(queries.suffixes.digests(docs, window=400)) == sorted(brute.repeats(corpus, 400), key=repr)
    else:
        assert rows(queries.jaccard.jaccard_components(docs, 4, 85).select("doc_id", "n_shingles", "component_id")) == sorted(brute.jaccard(corpus, 4, 85), key=repr)


def test_byte_repeats_of_a_whole_table(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    corpus = [tuple(r) for r in docs.collect()]
    want = brute.byte_repeats(corpus, 400)
    assert rows(queries.QUERIES["op4_bwt_repeats"](spark, "/root/testdata/sf0.01")) == sorted(want, key=repr)
    assert sum(w[2] > 0 for w in want) > 50
