"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build(app: str = "flightlake", master: str | None = None, shuffle_partitions: int | None = None, work: str | None = None) -> SparkSession:
    """A session with the settings the plans in this package are written for.

    Adaptive execution picks partition counts, turns small shuffled sides into
    broadcasts once their size is known, and splits skewed join partitions. Reference
    tables of up to 64 MB, by Spark's own measure, are broadcast. ``work`` names the shared folder
    for staged tables, where the cluster's settings do not.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if work:
        builder = builder.config("spark.checkpoint.dir", f"{work}/work").config("spark.sql.warehouse.dir", f"{work}/warehouse")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the one setting results depend on: timestamps are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def workdir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for files that must outlive an executor.

    It lies under ``spark.checkpoint.dir``, the shared folder the cluster
    names. Only where that is unset (local tests) is a temporary folder used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = os.path.join(tempfile.gettempdir(), "flightlake-work")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of this package's own, wherever Spark keeps it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path)) if "://" in path or "%" in path else spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``cut_lineage`` stages inside is deleted at the end; only results written elsewhere outlive it."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            delete(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder and read it back.

    Used where a result feeds several later steps and recomputing it, after a
    lost executor or in a second action, would cost a full scan again. Inside
    ``scratch`` the copy goes with its scope.
    """
    spark = df.sparkSession
    path = workdir(spark, "stage")
    if (paths := _SCRATCH.get()) is not None:
        paths.append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage_sized(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` with the bytes the written files take."""
    spark = df.sparkSession
    path = workdir(spark, "stage")
    df.write.mode("errorifexists").parquet(path)
    size = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.sum("length").alias("n")).first()["n"]
    return spark.read.schema(df.schema).parquet(path), int(size or 0)
