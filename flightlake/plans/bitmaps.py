"""Exact distinct counts that can be added up: bitmaps over numbered keys.

Every key has a number for good. A group's keys are kept as bitmaps of 32,768 bits, one row for each stretch of numbers it has any of;
the union of two groups is the bitwise or of their rows. So folded groups give distinct counts over any of
their unions without the keys themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import cut_lineage

#: Bits of one bitmap.
BITS = 32_768


def number_keys(spark: SparkSession, keys: DataFrame, key: str, table: str) -> DataFrame:
    """``key, number`` of all keys seen so far, kept in a catalog table; new ones are numbered after those it has.

    Each task numbers its new keys on end, with gaps between tasks only, so bitmaps stay dense and no task sees all keys. A
    job that ends before its numbers are written has used none of them. A null key has no number.
    """
    fresh = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    first = 0
    if spark.catalog.tableExists(table):
        have = spark.table(table)
        fresh = fresh.join(have.select(key), key, "left_anti")
        top = have.agg(F.max("number")).first()[0]
        first = 0 if top is None else (top // BITS + 1) * BITS
    numbered = cut_lineage(fresh.withColumn("number", F.lit(first) + F.monotonically_increasing_id()))
    numbered.write.mode("append").format("parquet").saveAsTable(table)
    return spark.table(table)


def fold(rows: DataFrame, by: Sequence[str], key: str, numbers: DataFrame) -> DataFrame:
    """``by, stretch, bits, rows``: which keys the rows of each group have, and how many rows there are with keys of a stretch.

    Rows are counted per group and key before they meet the numbers. Rows without a key are counted under stretch -1.
    """
    counted = rows.groupBy(*by, key).agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.join(numbers.select(key, "number"), key, "left")
    stretch = F.coalesce(F.floor(F.col("number") / BITS), F.lit(-1)).cast("bigint")
    return placed.groupBy(*by, stretch.alias("stretch")).agg(F.bitmap_construct_agg(F.col("number") % BITS).alias("bits"), F.sum("_n").alias("rows"))


def distinct_of(folded: DataFrame, by: Sequence[str], out: str = "distinct_keys") -> DataFrame:
    """Rows and distinct keys of unions of folded groups; ``by`` are columns that tell which groups belong together."""
    united = folded.groupBy(*by, "stretch").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("rows").alias("rows"))
    keys = F.when(F.col("stretch") >= 0, F.bitmap_count("bits")).otherwise(0)
    return united.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum(keys).alias(out))
