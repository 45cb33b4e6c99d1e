"""Filters of keys per partition: nothing is missed, little is read in vain."""

from pyspark.sql import functions as F

from flightlake.plans import bloom

KEY = ("a", "b")


def rows(spark, start, stop, part):
    return spark.range(start, stop).select(F.col("id").cast("string").alias("a"), (F.col("id") * 7).alias("b"), F.lit(part).alias("part"))


def test_finds_every_partition_that_has_a_key(spark):
    every = rows(spark, 0, 50_000, "p").unionByName(rows(spark, 50_000, 50_010, "q")).unionByName(rows(spark, 60_000, 60_001, "r"))
    made = bloom.filters(every, "part", KEY).unionByName(bloom.filters(rows(spark, 70_000, 70_100, "q"), "part", KEY)).cache()
    assert made.filter("part = 'p'").select("slots").first()["slots"] == 32
    ask = lambda keys: sorted(r[0] for r in bloom.candidates(keys.select(*KEY), made, "part", KEY).collect())
    for start, want in ((17, "p"), (49_999, "p"), (50_003, "q"), (60_000, "r"), (70_099, "q")):
        assert want in ask(rows(spark, start, start + 1, "x"))
    strange = rows(spark, 1_000_000, 1_001_000, "x")
    wrong = [len(ask(strange.filter(F.col("a") == str(k)))) for k in range(1_000_000, 1_000_020)]
    assert sum(wrong) <= 2
    assert ask(rows(spark, 5, 5, "x")) == []
    own = bloom.candidates(rows(spark, 10, 20, "q").unionByName(rows(spark, 60_000, 60_001, "r")), made, "part", KEY)
    assert [r[0] for r in own.collect()] == ["r"]


def test_no_filters(spark):
    made = bloom.filters(rows(spark, 0, 0, "p"), "part", KEY)
    assert bloom.candidates(rows(spark, 0, 5, "p").select(*KEY), made, "part", KEY).collect() == []
