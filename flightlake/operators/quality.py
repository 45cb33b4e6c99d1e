"""Row rules: check sets, ranges, required columns, text limits, keys and references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightlake import schema

Rules = Mapping[str, Column]


def required(*columns: str) -> dict[str, Column]:
    return {f"{c} is missing": F.col(c).isNotNull() for c in columns}


def one_of(column: str, values: Sequence[str]) -> dict[str, Column]:
    """Unknown values pass only as NULL, as in a SQL CHECK."""
    return {f"{column} is not an allowed value": F.col(column).isNull() | F.col(column).isin(*values)}


def within(column: str, low, high) -> dict[str, Column]:
    return {f"{column} is out of range": F.col(column).isNull() | F.col(column).between(low, high)}


def at_most(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"{c} is longer than {n}": F.col(c).isNull() | (F.length(c) <= n) for c, n in limits.items()}


def airport_rules() -> dict[str, Column]:
    return {**required("ident"), **at_most(schema.TEXT_LIMITS["airport"])}


def crossing_rules() -> dict[str, Column]:
    return {
        **required("icao24", "territory_type", "territory_id", "crossing_role", "flight_status", "entered_at"),
        **one_of("crossing_role", schema.CROSSING_ROLES),
        **one_of("flight_status", schema.FLIGHT_STATUSES),
        **one_of("territory_type", schema.TERRITORY_TYPES),
    }


def prediction_rules() -> dict[str, Column]:
    return {
        **one_of("predicted_delay_class", schema.DELAY_CLASSES),
        **within("delay_probability", 0, 1),
        **within("departure_hour", 0, 23),
        **within("departure_day_of_week", 1, 7),
    }


def event_rules() -> dict[str, Column]:
    return {
        **required("icao24", "event_type", "event_timestamp", "event_date"),
        **one_of("event_type", schema.EVENT_TYPES),
        **at_most(schema.TEXT_LIMITS["event"]),
    }


def with_reasons(df: DataFrame, rules: Rules, out: str = "reasons") -> DataFrame:
    """Rows with the names of the rules they break."""
    broken = [F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]
    return df.withColumn(out, F.array_compact(F.array(*broken)))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the rest with their reasons."""
    judged = with_reasons(df, rules)
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)


def load_checked(df: DataFrame, rules: Rules, path: str, load: str) -> DataFrame:
    """Write rows and their verdict below ``path`` in one pass, and enter the counts into the ledger there; returns the load's entry.

    Rows that keep every rule lie under ``rows/rejected=false``, the others with their ``reasons`` under ``rows/rejected=true``. The
    counts are taken while the rows are written, so the input is read once. A load of the same name replaces what it left before.
    """
    spark = df.sparkSession
    seen = Observation()
    judged = with_reasons(df, rules).withColumn("rejected", F.size("reasons") > 0)
    metrics = [F.count(F.lit(1)).alias("total"), F.count_if("rejected").alias("rejects")]
    metrics += [F.count_if(F.array_contains("reasons", name)).alias(f"rule_{i}") for i, name in enumerate(rules)]
    judged.observe(seen, *metrics).write.mode("overwrite").partitionBy("rejected").parquet(f"{path}/rows/load={load}")
    counts = seen.get
    broken = {name: counts[f"rule_{i}"] for i, name in enumerate(rules) if counts[f"rule_{i}"]}
    entry = spark.createDataFrame([(counts["total"], counts["rejects"], broken)], "total long, rejects long, broken map<string,long>")
    entry.write.mode("overwrite").parquet(f"{path}/ledger/load={load}")
    return entry


def loaded(spark: SparkSession, path: str, schema_of_rows: str, rejected: bool) -> DataFrame:
    """Accepted or rejected rows of all loads below ``path``, with the load's name."""
    rows = spark.read.schema(f"{schema_of_rows}, reasons array<string>, load string, rejected boolean").option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    chosen = rows.filter(F.col("rejected") == rejected).drop("rejected")
    return chosen if rejected else chosen.drop("reasons")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``load, total, rejects, broken`` of every load below ``path``."""
    return spark.read.schema("total long, rejects long, broken map<string,long>, load string").option("basePath", f"{path}/ledger").parquet(f"{path}/ledger")


def first_offenders(df: DataFrame, rules: Rules, key: str) -> DataFrame:
    """Per broken rule: how many rows break it, and the one with the smallest key."""
    return (
        with_reasons(df, rules)
        .select(key, F.explode("reasons").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first_key"))
    )


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that should be unique but are not."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def broken_references(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference is set but not in the parent table."""
    known = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(*df.columns)
