"""Two sinks that end equal: rows for the second sink wait in an outbox until it has them.

A micro-batch is written to the table first, by its number, so a retry replaces it. What is meant for the topic is
then put into the outbox, a folder per micro-batch in shared storage, and sent from there. A send that fails leaves the folder where
it is; the next micro-batch, the next start or ``flush`` sends it, oldest first, so the topic's order stays that of the batches. A ledger
of sent numbers keeps a retried micro-batch from being sent again. A sink that can replace a batch by its number gets every
row once; one that only appends can get a batch twice if the job ends between the send and the ledger.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flightlake.session import delete

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outbox:
    """Folder of the waiting batches, and what sends one: a function of its rows and number."""

    base: str
    send: Callable[[DataFrame, int], None]

    def _numbers(self, spark: SparkSession, part: str) -> list[int]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{part}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))

    def waiting(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches that the sink does not have yet."""
        sent = set(self._numbers(spark, "sent"))
        return [n for n in self._numbers(spark, "rows") if n not in sent]

    def put(self, rows: DataFrame, number: int) -> None:
        """Let a batch wait; one that was sent before is not put again."""
        if number not in self._numbers(rows.sparkSession, "sent"):
            rows.write.mode("overwrite").parquet(f"{self.base}/rows/batch={number}")

    def flush(self, spark: SparkSession) -> int:
        """Send what waits, oldest first, up to the first failure; the number of batches sent."""
        done = 0
        for number in self.waiting(spark):
            try:
                self.send(spark.read.parquet(f"{self.base}/rows/batch={number}"), number)
            except Exception as e:
                log.warning("send of batch %s failed, it stays in the outbox: %s", number, e)
                break
            mark = spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/sent/batch={number}")
            mark.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(mark)
            delete(spark, f"{self.base}/rows/batch={number}")
            done += 1
        # A stream retries its newest batch only; older marks are of no more use.
        for number in self._numbers(spark, "sent")[:-2]:
            delete(spark, f"{self.base}/sent/batch={number}")
        return done


def outbox_write(write_table: Callable[[DataFrame, int], DataFrame | None], outbox: Outbox, accepted_only: bool = False):
    """Batch function for ``jobs.start``: the table, then the outbox, then whatever waits there.

    ``write_table`` replaces what it wrote for the same number and returns the accepted rows. All rows go to the outbox unless ``accepted_only``.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                accepted = write_table(batch, number)
                outbox.put(accepted if accepted_only and accepted is not None else batch, number)
            outbox.flush(batch.sparkSession)
        finally:
            batch.unpersist()

    return each
