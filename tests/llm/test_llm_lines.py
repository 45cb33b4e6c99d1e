import brute
import pytest

from flightlake.llm import lines


@pytest.mark.parametrize("seed", [0, 1])
def test_lines(spark, rows, seed):
    corpus = brute.corpus(seed)
    docs = brute.frame(spark, corpus).repartition(3)
    assert rows(lines.digests(docs, lines.keep_bitmaps(docs, min_docs=8))) == sorted(brute.lines(corpus, 8), key=repr)


def test_one_line_over_many_ranges(spark, rows):
    corpus = [(i, f"Hot\nown {i}\n hot ") for i in range(400)] + [(900, "few"), (901, "few")]
    docs = brute.frame(spark, corpus).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert rows(lines.digests(docs, lines.keep_bitmaps(docs))) == sorted(brute.lines(corpus, 10), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ranges_that_each_see_few(spark, rows):
    corpus = [(i, "same line") for i in range(10)]
    docs = brute.frame(spark, corpus)
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        assert rows(lines.digests(docs, lines.keep_bitmaps(docs, min_docs=10))) == sorted(brute.lines(corpus, 10), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_minimum_length_and_small_batches(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        corpus = [(i, "é\nab\nabc\n" + "q" * (i % 3)) for i in range(30)]
        docs = brute.frame(spark, corpus)
        got = rows(lines.digests(docs, lines.keep_bitmaps(docs, min_docs=10, min_chars=3)))
        assert {r[2] for r in got} == {1}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_apply_keeps_columns(spark):
    corpus = [(i, f"hot\n{i}") for i in range(12)] + [(50, None)]
    docs = brute.frame(spark, corpus)
    out = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {**{i: str(i) for i in range(12)}, 50: None}


def test_empty_table(spark, rows):
    docs = brute.frame(spark, [])
    assert rows(lines.digests(docs, lines.keep_bitmaps(docs))) == []
