"""Joining many rows to a measured lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A stored table up to this many bytes on disk may be broadcast. Decompressed it
# takes several times that, which still fits an executor.
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def join_lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], stored_bytes: int | None, spread: Sequence[Column], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join to a lookup with one row or a few per key.

    A table known to be small is broadcast, so the rows are not shuffled. A
    larger or unmeasured one is joined by shuffle with every key split into
    ``salts`` parts: a key that holds a third of the rows becomes that many
    tasks, at the price of as many copies of the lookup. ``spread`` are columns that vary
    within a key; the salt is a hash of them, so a retried task repeats it.
    """
    if stored_bytes is not None and stored_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), list(on), how)
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")
