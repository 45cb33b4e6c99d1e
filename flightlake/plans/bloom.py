"""Which partitions may hold some keys: Bloom filters as bitmaps of 32,768 bits, made and tested by built-in functions.

A filter is kept per partition, in as many bitmaps as its keys need. Rows added later get filters of their own,
so nothing is built anew; a partition is a candidate if any of its filters may hold a key. A filter never misses a key it was made of.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap, filter bits for each key, and hash functions: about one wrong candidate in 400 keys.
BITS, BITS_PER_KEY, HASHES = 32_768, 16, 4


def _positions(key: Sequence[str], slots: Column) -> Column:
    hashes = [F.pmod(F.xxhash64(*key, F.lit(i)), slots * BITS) for i in range(HASHES)]
    return F.explode(F.array(*hashes))


def filters(rows: DataFrame, by: str, key: Sequence[str]) -> DataFrame:
    """``by, slots, slot, bits``: one filter for each value of ``by``, a power of two of bitmaps long."""
    sized = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    needed = F.greatest(F.lit(1.0), F.col("_n") * BITS_PER_KEY / BITS)
    slots = sized.select(by, F.pow(F.lit(2), F.ceil(F.log2(needed))).cast("bigint").alias("slots"))
    set_bits = rows.join(slots, by).select(by, "slots", _positions(key, F.col("slots")).alias("_p"))
    return set_bits.groupBy(by, "slots", F.floor(F.col("_p") / BITS).alias("slot")).agg(F.bitmap_construct_agg(F.col("_p") % BITS).alias("bits"))


def most_keys(made: DataFrame, by: str) -> DataFrame:
    """``by, keys``: how many keys the filters of each value were made for, at most; read from their sizes alone."""
    # A load that came later has bitmaps of the same numbers.
    sizes = made.groupBy(by, "slots", "slot").agg(F.count(F.lit(1)).alias("_c")).groupBy(by, "slots").agg(F.max("_c").alias("_copies"))
    return sizes.groupBy(by).agg(F.sum(F.col("slots") * F.col("_copies") * F.lit(BITS // BITS_PER_KEY)).alias("keys"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def candidates(keys: DataFrame, made: DataFrame, by: str, key: Sequence[str]) -> DataFrame:
    """Values of ``by`` whose filters may hold one of ``keys``. If ``keys`` has that column too, a key is looked for in its own partition only."""
    own = by in keys.columns
    place = [by] if own else []
    if own:
        probes = keys.join(made.select(by, "slots").distinct(), by)
    else:
        sizes = [F.lit(r["slots"]) for r in made.select("slots").distinct().collect()]  # powers of two: a few
        probes = keys.withColumn("slots", F.explode(F.array(*sizes).cast("array<bigint>")))
    asked = probes.select(*place, "slots", F.struct(*key).alias("_k"), _positions(key, F.col("slots")).alias("_p"))
    asked = asked.distinct().withColumn("slot", F.floor(F.col("_p") / BITS))
    hits = asked.join(made, [*place, "slots", "slot"]).filter(_is_set(F.col("bits"), F.col("_p") % BITS))
    # Two of a key's positions may be the same one, so they are counted as asked.
    wanted = asked.groupBy(*place, "slots", "_k").agg(F.count("*").alias("_asked"))
    found = hits.groupBy(by, "slots", "_k").agg(F.count_distinct("_p").alias("_hits"))
    return found.join(wanted, [*place, "slots", "_k"]).filter(F.col("_hits") == F.col("_asked")).select(by).distinct()
