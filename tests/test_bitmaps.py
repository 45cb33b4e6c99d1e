"""Distinct counts out of folded bitmaps equal those over the rows, for any union of groups."""

import uuid

from pyspark.sql import functions as F

from flightlake.plans import bitmaps


def test_unions_of_days(spark):
    table = f"numbers_{uuid.uuid4().hex}"
    rows = spark.range(3000).select((F.col("id") % 30).alias("day"), F.when(F.col("id") % 11 != 0, F.concat(F.lit("k"), (F.col("id") * 7919 % 400).cast("string"))).alias("key")).repartition(5)
    old = rows.filter("day < 10")
    first = bitmaps.number_keys(spark, old, "key", table)
    folded = bitmaps.fold(old, ["day"], "key", first)
    before = {r["key"]: r["number"] for r in first.collect()}
    every = bitmaps.number_keys(spark, rows, "key", table)
    after = {r["key"]: r["number"] for r in every.collect()}
    assert before.items() <= after.items() and len(set(after.values())) == len(after) and None not in after
    both = folded.unionByName(bitmaps.fold(rows.filter("day >= 10"), ["day"], "key", every))
    week = (F.col("day") / 7).cast("int").alias("week")
    got = bitmaps.distinct_of(both.withColumn("week", week), ["week"], "keys")
    want = rows.groupBy(week).agg(F.count("*").alias("rows"), F.count_distinct("key").alias("keys"))
    assert sorted(map(tuple, got.select("week", "rows", "keys").collect())) == sorted(map(tuple, want.collect()))
    assert bitmaps.number_keys(spark, rows.filter("day < 0"), "key", table).count() == len(after)
    spark.sql(f"DROP TABLE {table}")


def test_only_unknown_keys(spark):
    table = f"numbers_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(1, None), (1, None), (2, None)], "day int, key string")
    numbers = bitmaps.number_keys(spark, rows, "key", table)
    got = bitmaps.distinct_of(bitmaps.fold(rows, ["day"], "key", numbers), ["day"], "keys")
    assert sorted(map(tuple, got.collect())) == [(1, 2, 0), (2, 1, 0)]
    spark.sql(f"DROP TABLE {table}")
