"""Chunked operators equal plain windows, also for a key that holds most rows."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from flightlake.plans import sequence
from flightlake.plans.ranking import with_rank

T0 = datetime(2024, 1, 1)


def frame(spark, data):
    rows = [(k, T0 + timedelta(minutes=m), i, v) for i, (k, m, v) in enumerate(data)]
    return spark.createDataFrame(rows, "k string, t timestamp, i int, v int")


def skewed(n=600):
    data = [("hot", (j * 37) % 5000, j % 5 or None) for j in range(n)]
    return data + [(f"k{j % 50}", (j * 91) % 5000, j % 3 or None) for j in range(n // 2)]


def plain_neighbours(df):
    w = Window.partitionBy("k").orderBy("t", "i")
    return df.withColumn("p", F.lag("v").over(w)).withColumn("pi", F.lag("i").over(w)).withColumn("ni", F.lead("i").over(w))


def chunked_neighbours(df, width):
    out = sequence.with_neighbours(df, ["k"], ["t", "i"], ["v", "i"], width)
    return out.select(*df.columns, F.col("before.v").alias("p"), F.col("before.i").alias("pi"), F.col("after.i").alias("ni"))


def plain_fill(df):
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("f", F.last("v", ignorenulls=True).over(w))


def test_neighbours_of_a_hot_key(spark, rows):
    df = frame(spark, skewed())
    for width in (600, 3600, 10**7):
        assert rows(chunked_neighbours(df, width)) == rows(plain_neighbours(df))


def test_fill_of_a_hot_key(spark, rows):
    df = frame(spark, skewed())
    for width in (600, 3600, 10**7):
        assert rows(sequence.with_last_known(df, ["k"], ["t", "i"], "v", width, "f")) == rows(plain_fill(df))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 300), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=25))
def test_any_rows(spark, rows, data):
    df = frame(spark, data)
    assert rows(chunked_neighbours(df, 3600)) == rows(plain_neighbours(df))
    assert rows(sequence.with_last_known(df, ["k"], ["t", "i"], "v", 3600, "f")) == rows(plain_fill(df))


def test_scan_is_shuffled_once(spark, tmp_path):
    """Both halves of the neighbour plan read one shuffle of the rows."""
    frame(spark, skewed()).write.parquet(str(tmp_path / "t"))
    out = chunked_neighbours(spark.read.parquet(str(tmp_path / "t")), 3600)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_hot_key_is_split(spark):
    """No window task of the first step holds more than one chunk of the hot key."""
    df = frame(spark, skewed(2000)).withColumn("c", sequence.chunk_of("t", 3600))
    largest = df.filter("k = 'hot'").groupBy("c").count().agg(F.max("count")).first()[0]
    assert largest < 2000 / 20


def test_latest_and_first(spark, rows):
    df = frame(spark, skewed(100))
    w = Window.partitionBy("k").orderBy("t", "i")
    first = df.withColumn("n", F.row_number().over(w)).filter("n = 1").drop("n")
    last = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("t"), F.desc("i")))).filter("n = 1").drop("n")
    assert rows(sequence.first_per_key(df, ["k"], ["t", "i"])) == rows(first)
    assert rows(sequence.latest_per_key(df, ["k"], ["t", "i"])) == rows(last)


def test_rank_equals_sql_rank(spark, rows):
    df = spark.createDataFrame([(g, i, n) for i, (g, n) in enumerate([("a", 3), ("a", 3), ("a", 1), ("b", 5), ("b", 2), ("b", 2), ("b", 1)])], "g string, i int, n long")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("n"))).cast("long"))
    assert rows(with_rank(df, "n", "r", by=["g"])) == rows(want)
    whole = df.withColumn("r", F.rank().over(Window.orderBy(F.desc("n"))).cast("long"))
    assert rows(with_rank(df, "n", "r")) == rows(whole)


def test_one_hour_of_one_key_is_cut(spark, rows, monkeypatch):
    """A third of all rows on one key in one hour, many at one moment: no window task has more than a few ranges' rows."""
    monkeypatch.setattr(sequence, "MOST", 50)
    data = [("hot", j % 7, j % 5 or None) for j in range(900)] + [(f"k{j % 300}", (j * 91) % 5000, j % 3 or None) for j in range(1800)]
    df = frame(spark, data)
    pieces, parts = sequence.in_pieces(df, ["k"], ["t", "i"], 3600, 50)
    assert parts == ["_chunk", "_piece"] and not sequence.is_calm(df, ["k"], "t", 3600)
    sizes = [r["count"] for r in pieces.filter("k = 'hot'").groupBy("_chunk", "_piece").count().collect()]
    assert sum(sizes) == 900 and len(sizes) > 9 and max(sizes) <= 150
    assert rows(chunked_neighbours(df, 3600)) == rows(plain_neighbours(df))
    assert rows(sequence.with_last_known(df, ["k"], ["t", "i"], "v", 3600, "f")) == rows(plain_fill(df))


def shuffles(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_few_rows_a_key_are_not_cut(spark, rows):
    """Neighbours, fill and neighbours again of keys with few rows: one shuffle, and the rows of the plain windows."""
    df = frame(spark, skewed())
    assert sequence.density(df, ["k"], ["t", "i"], 3600) == sequence.SPARSE
    for calm in (sequence.SPARSE, sequence.CALM):
        near = lambda d: sequence.with_neighbours(d, ["k"], ["t", "i"], ["v", "i"], 3600, calm=calm)
        out = near(df).select(*df.columns, F.col("before.v").alias("p"), F.col("before.i").alias("pi"), F.col("after.i").alias("ni"))
        assert rows(out) == rows(plain_neighbours(df))
        filled = sequence.with_last_known(df, ["k"], ["t", "i"], "v", 3600, "f", calm=calm)
        assert rows(filled.select(*df.columns, "f")) == rows(plain_fill(df))
    steps = sequence.with_neighbours(df, ["k"], ["t", "i"], ["v"], 3600, calm=sequence.SPARSE)
    steps = sequence.with_last_known(steps, ["k"], ["t", "i"], "v", 3600, "f", calm=sequence.SPARSE)
    steps = sequence.with_neighbours(steps, ["k"], ["t", "i"], ["f"], 3600, "b", "a", calm=sequence.SPARSE)
    assert shuffles(steps) == 1
    assert rows(steps.select(*df.columns, "f")) == rows(plain_fill(df))


def test_many_rows_a_key_are_cut(spark, monkeypatch):
    df = frame(spark, skewed())
    monkeypatch.setattr(sequence, "FEW", 100)
    assert sequence.density(df, ["k"], ["t", "i"], 3600) == sequence.CALM
    monkeypatch.setattr(sequence, "MOST", 5)
    assert sequence.density(df, ["k"], ["t", "i"], 3600) == sequence.CROWDED
    monkeypatch.setattr(sequence, "FEW", 10_000)
    # The rows without a key are filled within a chunk only, as they are by the chunked steps.
    monkeypatch.setattr(sequence, "MOST", 10_000)
    assert sequence.density(df.unionByName(frame(spark, [(None, 1, 1)])), ["k"], ["t", "i"], 3600) == sequence.CALM
    # Nor is there one order of rows that share their place.
    assert sequence.density(df.unionByName(df.limit(1)), ["k"], ["t", "i"], 3600) == sequence.CALM
    assert sequence.density(df, ["k"], ["t", "i"], 3600) == sequence.SPARSE
