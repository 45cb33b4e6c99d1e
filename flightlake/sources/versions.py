"""Replacing partitions of a catalog table, without a gap and whatever the session's overwrite mode is.

The new rows are written to a version folder of their own beside the old ones. Then each partition's location is set to its new
folder, one catalog operation that a reader sees wholly or not at all. Until that moment the table is as it was: a job that is lost while it
writes leaves a folder behind that nothing refers to. Partitions that are not named are never touched. Replaced folders stay for readers that
are still at work and go with the next replacement; ``vacuum`` removes what lost jobs left. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from flightlake.session import delete

_VERSIONS, _SUPERSEDED = "_versions", "_superseded"


def location(spark: SparkSession, table: str, partition: str | None = None, value: object = None) -> str | None:
    """Where a table or one of its partitions lies; None for a partition it does not have."""
    spec = "" if partition is None else f" PARTITION ({partition}='{value}')"
    if partition is not None and not spark.sql(f"SHOW PARTITIONS {table}{spec}").take(1):
        return None
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}{spec}").filter("col_name = 'Location'").first()["data_type"]


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def swap(spark: SparkSession, table: str, partition: str, value: object, folder: str) -> None:
    """Let one partition lie in ``folder``."""
    spec = f"PARTITION ({partition}='{value}')"
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").take(1):
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION '{folder}'")


def replace(spark: SparkSession, table: str, rows: DataFrame, partition: str, values: Iterable[object]) -> None:
    """Replace the partitions ``values`` by ``rows``, which may be read from the table itself; a partition without rows becomes empty.

    ``rows`` has the table's columns and no others of that partition column than ``values``.
    """
    values = sorted(set(values), key=str)
    if not values:
        return
    place = location(spark, table)
    spark.catalog.refreshTable(table)
    _forget(spark, place)
    new = f"{place}/{_VERSIONS}/{uuid.uuid4().hex}"
    rows.select(*spark.table(table).columns).hint("rebalance", partition).write.partitionBy(partition).parquet(new)
    old = []
    for value in values:
        folder = f"{new}/{partition}={value}"
        fs, path = _folder(spark, folder)
        fs.mkdirs(path)
        before = location(spark, table, partition, value)
        swap(spark, table, partition, value, folder)
        old += [before] if before else []
    if old:
        spark.createDataFrame([(p,) for p in old], "value string").coalesce(1).write.mode("append").text(f"{place}/{_SUPERSEDED}")
    spark.catalog.refreshTable(table)


def _forget(spark: SparkSession, place: str) -> None:
    """Delete the folders that the replacement before this one took out of the table."""
    ledger = f"{place}/{_SUPERSEDED}"
    fs, path = _folder(spark, ledger)
    if fs.exists(path):
        for row in spark.read.text(ledger).collect():
            delete(spark, row["value"])
        delete(spark, ledger)


def vacuum(spark: SparkSession, table: str, partition: str) -> int:
    """Delete partition folders that the table does not refer to, and their number; not to be run beside a writer."""
    place = location(spark, table)
    spark.catalog.refreshTable(table)
    name = lambda p: p.replace("file:///", "file:/").rstrip("/")
    live = {name(f.rsplit("/", 1)[0]) for f in spark.table(table).inputFiles()}
    gone = 0
    for pattern in (f"{place}/{partition}=*", f"{place}/{_VERSIONS}/*/{partition}=*"):
        fs, path = _folder(spark, pattern.replace("*", "%2A"))
        for status in fs.globStatus(path) or []:
            folder = status.getPath().toString()
            if name(folder) not in live:
                delete(spark, folder)
                gone += 1
    return gone
