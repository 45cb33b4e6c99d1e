"""Ordered-row operators that survive a hot key.

A plain window over one key puts that key's whole history into one task. Here
the history of a key is first cut into time chunks, the window runs per
(key, chunk), and only what crosses a chunk border is resolved in a second,
small step over the key. That step sees at most two rows per chunk.

A chunk that holds too many rows itself is cut further: the rows of all such chunks are
sorted into ranges of (key, order), however many a chunk fills, and every range is a piece with borders of its own.
Which chunks these are is counted beforehand, over the key and time columns alone; where there are none nothing
else is done. Results equal those of the plain window.

Where every key has few rows, chunks would only part what one task can order: nearly each row would be a border.
Steps told so (``SPARSE``) run the plain window, and steps after one another share one shuffle and sort.

``order`` starts with a timestamp column and must be unique within a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import cut_lineage

MINUTE = 60
HOUR = 3600
DAY = 86400
#: Rows of a key and chunk that one task may have; more are cut into ranges.
MOST = 1_000_000
#: Rows a key may have, in all, to be ordered in one piece.
FEW = 100_000
#: What ``calm`` tells: some chunk may have too many rows, none has, or every key has few.
CROWDED, CALM, SPARSE = range(3)
_CHUNK, _PIECE = "_chunk", "_piece"
_ROW = "_row"


def chunk_of(ts: Column | str, width: int) -> Column:
    """Number of the time chunk of ``width`` seconds a timestamp lies in."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c) / F.lit(width * 1_000_000))


def is_calm(df: DataFrame, key: Sequence[str], ts: str, width: int, most: int | None = None) -> bool:
    """Whether no chunk of ``df`` has too many rows; nor has then any of fewer rows of the same, so steps that only leave rows out need not count again."""
    counts = df.groupBy(*key, chunk_of(ts, width).alias(_CHUNK)).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > (MOST if most is None else most)).isEmpty()


def density(df: DataFrame, key: Sequence[str], order: Sequence[str], width: int) -> int:
    """``SPARSE``, ``CALM`` or ``CROWDED``; it holds for steps that leave rows out or add an earliest one a key, too.

    A null key, whose values are filled forward within a chunk only, and rows of equal order, which chunks may bring into
    another one, are left to the chunked steps.
    """
    places = df.groupBy(*key, *order).agg(F.count(F.lit(1)).alias("_same"))
    rows = places.groupBy(*key).agg(F.sum("_same").alias("_n"), F.max("_same").alias("_same"))
    if rows.filter((F.col("_n") > FEW) | (F.col("_same") > 1) | reduce(or_, [F.col(c).isNull() for c in key])).isEmpty():
        return SPARSE
    return CALM if is_calm(df, key, order[0], width) else CROWDED


def in_pieces(df: DataFrame, key: Sequence[str], order: Sequence[str], width: int, most: int, calm: int = CROWDED) -> tuple[DataFrame, list[str]]:
    """Rows with their chunk and, in chunks of more than ``most`` rows, the range of (key, order) they lie in; and the columns that tell the parts of a key."""
    cut = df.withColumn(_CHUNK, chunk_of(order[0], width))
    place = [*key, _CHUNK]
    if calm or is_calm(df, key, order[0], width, most):
        return cut, [_CHUNK]
    dense = cut_lineage(cut.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most))
    same = lambda a, b: reduce(and_, [a[c].eqNullSafe(b[c]) for c in place])
    crowded = cut.join(dense, same(cut, dense), "left_semi")
    ranges = -(-dense.agg(F.sum("_n")).first()[0] // most) + 1
    # Staged, as the number of a range must not depend on when it is computed.
    ranged = cut_lineage(crowded.repartitionByRange(ranges, *key, *order).withColumn(_PIECE, F.spark_partition_id() + 1))
    return cut.join(dense, same(cut, dense), "left_anti").withColumn(_PIECE, F.lit(0)).unionByName(ranged), [_CHUNK, _PIECE]


def with_neighbours(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    width: int,
    back: str = "before",
    ahead: str = "after",
    calm: int = CROWDED,
) -> DataFrame:
    """Add the previous and the next row of the key as structs of ``fields``.

    A missing neighbour is a NULL struct. ``calm`` says that no chunk is crowded or, as ``SPARSE``, no key; else chunks are counted.
    """
    if calm == SPARSE:
        whole = Window.partitionBy(*key).orderBy(*order)
        return df.withColumn(_ROW, F.struct(*fields)).select(*df.columns, F.lag(_ROW).over(whole).alias(back), F.lead(_ROW).over(whole).alias(ahead))
    cut, parts = in_pieces(df, key, order, width, MOST, calm)
    near = Window.partitionBy(*key, *parts).orderBy(*order)
    far = Window.partitionBy(*key).orderBy(*order)
    cut = cut.withColumn(_ROW, F.struct(*fields))
    cut = cut.select(*df.columns, _ROW, F.lag(_ROW).over(near).alias(back), F.lead(_ROW).over(near).alias(ahead))
    border = F.col(back).isNull() | F.col(ahead).isNull()
    joined = cut.filter(border).select(
        *df.columns,
        F.coalesce(F.col(back), F.lag(_ROW).over(far)).alias(back),
        F.coalesce(F.col(ahead), F.lead(_ROW).over(far)).alias(ahead),
    )
    return cut.filter(~border).drop(_ROW).unionByName(joined)


def with_last_known(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, width: int, out: str, calm: int = CROWDED
) -> DataFrame:
    """Forward fill: last non-NULL ``value`` of the key at or before each row."""
    if calm == SPARSE:
        whole = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(whole))
    cut, parts = in_pieces(df, key, order, width, MOST, calm)
    near = Window.partitionBy(*key, *parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*key).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    known = F.col(value).isNotNull()
    carried = (
        cut.groupBy(*key, *parts)
        .agg(F.max_by(F.when(known, F.col(value)), F.when(known, F.struct(*order))).alias("_tail"))
        .withColumn("_carry", F.last("_tail", ignorenulls=True).over(earlier))
        .drop("_tail")
    )
    return (
        cut.withColumn(out, F.last(value, ignorenulls=True).over(near))
        .join(carried, [*key, *parts], "left")
        .withColumn(out, F.coalesce(F.col(out), F.col("_carry")))
        .drop("_carry", *parts)
    )


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key by ``order`` as a mergeable aggregate, no window.

    Rows are combined before the shuffle, so a hot key costs one row per task.
    """
    rest = [c for c in df.columns if c not in key]
    return (
        df.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by ``order``: first-wins deduplication, no window."""
    rest = [c for c in df.columns if c not in key]
    # An order of all columns is the row itself, which then need not be kept twice.
    first = F.min(F.struct(*order)) if set(rest) <= set(order) else F.min_by(F.struct(*rest), F.struct(*order))
    return (
        df.groupBy(*key)
        .agg(first.alias("_row"))
        .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )
