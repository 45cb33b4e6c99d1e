"""Declared source tables, and sinks that keep the natural keys unique."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake import schema
from flightlake.plans import bloom
from flightlake.plans.sequence import first_per_key
from flightlake.session import cut_lineage


#: A partition is read without asking its filter if the batch has at least ``PROBED`` keys of it, and one for each ``READ_PER_KEY`` it may hold.
PROBED, READ_PER_KEY = 4096, 16


@dataclass(frozen=True)
class Source:
    schema: T.StructType
    description: str
    partition: str | None = None


# The eight tables queries may read.
SOURCES = {
    "hist_flight_events": Source(schema.HIST_EVENT, "Flight events of past days", "event_date"),
    "hist_territory_crossings": Source(schema.HIST_CROSSING, "Territory crossings of past days", "entered_date"),
    "daily_flight_events": Source(schema.DAILY_EVENT, "Flight events of the current day", "event_date"),
    "daily_territory_crossings": Source(schema.DAILY_CROSSING, "Territory crossings of the current day", "entered_date"),
    "dim_aircraft": Source(schema.AIRCRAFT, "Aircraft master data"),
    "dim_airport": Source(schema.AIRPORT, "Airports with coordinates"),
    "dim_country": Source(schema.COUNTRY, "Countries with boundaries"),
    "dim_state": Source(schema.STATE, "States and provinces with boundaries"),
}


def by_date(rows: DataFrame, partition: str) -> DataFrame:
    """Rows arranged for a write partitioned by date: few files per date, a large date in several."""
    return rows.hint("rebalance", partition)


class TableRegistry:
    """Named Parquet tables below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name].schema).parquet(self.path(name))

    def register(self) -> list[str]:
        """Temporary views of all tables that exist; returns their names."""
        made = []
        for name in SOURCES:
            try:
                self.read(name).createOrReplaceTempView(name)
                made.append(name)
            except Exception as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        return made

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _filters(self, name: str, key: tuple[str, ...]) -> DataFrame:
        """Filters of the keys of each partition; made from the whole table where it has none."""
        part, place = SOURCES[name].partition, f"{self.root}/_keys/{name}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            bloom.filters(self.read(name).select(*key, part), part, key).write.mode("overwrite").parquet(place)
        return self.spark.read.schema(f"{part} date, slots bigint, slot bigint, bits binary").parquet(place)

    def _candidates(self, name: str, keys: DataFrame, key: tuple[str, ...]) -> list:
        """Partitions that may have one of the keys; those that many are asked of, as measured by what they hold, are not probed: reading them is no more work."""
        part, made = SOURCES[name].partition, self._filters(name, key)
        asked = keys.groupBy(part).agg(F.count(F.lit(1)).alias("n")).join(bloom.most_keys(made, part), part).collect()  # one row for each date
        full = [r[part] for r in asked if r["n"] >= PROBED and r["n"] * READ_PER_KEY >= r["keys"]]
        few = [r[part] for r in asked if r[part] not in full]
        return full + ([r[0] for r in bloom.candidates(keys.filter(F.col(part).isin(few)), made, part, key).collect()] if few else [])

    def _extend_filters(self, name: str, keys: DataFrame, key: tuple[str, ...]) -> None:
        """Enter keys into the filters before their rows: a load that ends in between leaves a filter that knows too much, never too little."""
        if self._exists(name):
            self._filters(name, key)
        bloom.filters(keys, SOURCES[name].partition, key).write.mode("append").parquet(f"{self.root}/_keys/{name}")

    def append_new(self, name: str, rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...] = ()) -> DataFrame:
        """Append the rows whose key the table lacks, and return them.

        Of rows with the same key the first by ``order`` and then by all other columns
        is kept. Values a column cannot hold become NULL; rows without a required
        value are left out. Only the partitions whose filter may hold a key of the batch are compared:
        a filter of the keys of each date lies beside the table, and is extended before rows are added.
        """
        part, struct = SOURCES[name].partition, SOURCES[name].schema
        shaped = rows.select(*[F.col(f.name).try_cast(f.dataType) for f in struct])
        shaped = shaped.dropna(subset=[f.name for f in struct if not f.nullable])
        rest = [c for c in shaped.columns if c not in key and c not in order]
        new = shaped = cut_lineage(first_per_key(shaped, list(key), [*order, *rest]))
        if self._exists(name):
            have = self.read(name)
            if part:
                dates = self._candidates(name, shaped.select(*key, part), key)
                have = have.filter(F.col(part).isin(dates))
            new = cut_lineage(shaped.join(have.select(*key), list(key), "left_anti").select(*shaped.columns))
        if part:
            self._extend_filters(name, new.select(*key, part), key)
            by_date(new, part).write.mode("append").partitionBy(part).parquet(self.path(name))
        else:
            new.write.mode("append").parquet(self.path(name))
        return new


def create_catalog_tables(spark: SparkSession, names: tuple[str, ...] = tuple(SOURCES), database: str | None = None) -> None:
    """Empty catalog tables with the declared schemas and partitioning."""
    for name in names:
        source = SOURCES[name]
        empty = spark.createDataFrame([], source.schema)
        writer = empty.write.mode("ignore").format("parquet")
        (writer.partitionBy(source.partition) if source.partition else writer).saveAsTable(f"{database}.{name}" if database else name)


def pending_files(spark: SparkSession, pattern: str, ledger: str) -> list[str]:
    """Files not yet in the ledger: a text folder with one file name per line."""
    files = spark.read.format("binaryFile").load(pattern).select("path").withColumn("file", F.element_at(F.split("path", "/"), -1))
    try:
        done = spark.read.schema("value string").text(ledger).select(F.trim("value").alias("file"))
        files = files.join(done, "file", "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return [r["path"] for r in files.select("path").orderBy("path").toLocalIterator()]


def mark_loaded(spark: SparkSession, ledger: str, names: list[str]) -> None:
    """Add file names to the ledger after their load succeeded."""
    spark.createDataFrame([(n.rsplit("/", 1)[-1],) for n in names], "value string").coalesce(1).write.mode("append").text(ledger)
