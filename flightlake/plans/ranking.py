"""Ranks and modes built from mergeable aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_rank(df: DataFrame, metric: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """SQL ``RANK() OVER ([PARTITION BY by] ORDER BY metric DESC)`` without sorting the rows.

    The rank of a row is one more than the number of rows with a larger metric.
    That number comes from the histogram of the metric. For a count metric the
    histogram has at most about sqrt(2 * total) entries, so the window over it
    stays small even when the rows do not fit one task.
    """
    larger = Window.partitionBy(*by).orderBy(F.col(metric).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        df.groupBy(*by, metric)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(out, F.lit(1) + F.coalesce(F.sum("_n").over(larger), F.lit(0)))
        .drop("_n")
    )
    return df.join(ranks, [*by, metric]).select(*df.columns, out)


def smallest_mode(value: Column, weight: Column) -> Column:
    """Aggregate: value with the largest weight, the smallest value on a tie, NULLs ignored.

    Expects one row per value with its total weight.
    """
    known = value.isNotNull() & (weight > 0)
    return F.min_by(F.when(known, value), F.when(known, F.struct((-weight).alias("w"), value.alias("v"))))
