"""File readers. Every schema is explicit; texts are typed afterwards by expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake import schema

# Column names of the source files, in file order.
AIRPORT_FILE = (
    "id", "ident", "type", "name", "latitude_deg", "longitude_deg", "elevation_ft", "continent", "iso_country", "iso_region",
    "municipality", "scheduled_service", "icao_code", "iata_code", "gps_code", "local_code", "home_link", "wikipedia_link", "keywords",
)
REGION_FILE = ("id", "code", "local_code", "name", "continent", "iso_country", "wikipedia_link", "keywords")
PREFIX_FILE = ("Prefix", "CountryISO2")
COUNTRY_NAME_FILE = ("ISO", "Name")
# What a header may hold besides its names.
_UNNAMED = r'["\s\ufeff]'


def texts(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_texts(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, position: bool = False) -> DataFrame:
    """CSV with a header, every column text, header names trimmed and lower-cased.

    Empty cells are NULL, 'NA' stays text, undecodable bytes are replaced and
    short or long rows are kept. With ``columns`` the header is not read and the file must have that layout.
    Compressed files cannot be split: each is one read task.
    ``position`` adds the place of a row in the input, for first-wins rules.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("nullValue", "").option("escape", '"').option("multiLine", False)
    if columns is not None:
        df = reader.schema(texts(columns)).option("enforceSchema", True).csv(path)
    else:
        df = reader.option("inferSchema", False).csv(path)
        df = df.toDF(*[c.strip().lower() for c in df.columns])
    if position:
        df = df.withColumn("position", F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
        ))
    return df


def named_rows(lines: DataFrame, columns: Sequence[str] = schema.FLIGHT_LIST_COLUMNS) -> DataFrame:
    """Rows of CSV lines ``value, file``, every column a text, bound by the names in the header of their file.

    Names are trimmed and lower-cased; columns beyond ``columns`` are not read. A file whose header
    lacks one of them, or has none, stops the load and is named. Files with the same header are read together.
    """
    bare = F.lower(F.regexp_replace("value", _UNNAMED, ""))
    # One search tells nearly every row of data from a header; only what passes is taken apart.
    named = F.col("value").rlike("(?iu)" + f"{_UNNAMED}*".join(re.escape(x) for x in columns[0]))
    is_header = named & F.forall(F.array(*[F.lit(c) for c in columns[:3]]), lambda c: F.array_contains(F.split(bare, ","), c))
    marked = lines.filter(F.trim("value") != "").select("file", "value", is_header.alias("_header"))
    heads = marked.groupBy("file").agg(F.min(F.when(F.col("_header"), bare)).alias("header")).collect()  # one row for each file
    by_header: dict[str, list[str]] = {}
    for r in heads:
        missing = [c for c in columns if c not in (r["header"] or "").split(",")]
        if missing:
            raise ValueError(f"{r['file']}: the header lacks {', '.join(missing)}")
        by_header.setdefault(r["header"], []).append(r["file"])
    out = None
    for header, names in by_header.items():
        fields = ", ".join(f"`{c or i}` string" for i, c in enumerate(header.split(",")))
        row = F.from_csv("value", fields, {"mode": "PERMISSIVE", "escape": '"'})
        # As a generator the parse stays below every filter on its columns and runs once for each line.
        rows = marked.filter(F.col("file").isin(names) & ~F.col("_header")).select("file", F.inline(F.array(F.struct(row.alias("r")))))
        part = rows.select(*[F.nullif(F.col(f"r.`{c}`"), F.lit("")).alias(c) for c in columns], "file")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else lines.sparkSession.createDataFrame([], texts([*columns, "file"]))


def with_aircraft(rows: DataFrame) -> DataFrame:
    """Rows with an aircraft id that is not blank."""
    return rows.filter(F.trim("icao24") != "")


def flight_lists(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Monthly flight lists with the file they came from; rows without an aircraft id are dropped."""
    return with_aircraft(named_rows(spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))))


def flight_list_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The lines of flight lists as a stream of files, for ``named_rows``: each file is read once, however often the load is restarted."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select("value", F.col("_metadata.file_name").alias("file"))


def load_summary(typed: DataFrame) -> DataFrame:
    """Per file: rows, events they give and rows skipped."""
    return typed.groupBy("file").agg(
        F.count(F.lit(1)).alias("total_rows"),
        (2 * F.count_if("accepted")).alias("events_inserted"),
        F.count_if(~F.col("accepted")).alias("rows_skipped"),
    )


def aircraft_file(spark: SparkSession, path: str) -> DataFrame:
    return read_texts(spark, path, position=True)


def airport_file(spark: SparkSession, path: str) -> DataFrame:
    return read_texts(spark, path, position=True)


def lookup_file(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Small lookup CSV in file layout ``columns``; 'NA' is a code, not a missing value."""
    return read_texts(spark, path, columns)


def boundary_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Boundary attributes with their outline as WKT, from Parquet."""
    return spark.read.parquet(path).select(*columns)
