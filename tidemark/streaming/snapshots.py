"""A log of what each batch of a running query has seen: its rows, their newest time, and rows left out as late.

The numbers are collected by the batch itself (``observe``), so nothing is read twice. A listener writes them as one
small file for each batch, named by its number: a batch that is attempted again replaces its own, and a
restarted query goes on where it stopped.
"""

from __future__ import annotations

import json
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVED = "tidemark_batch"
SCHEMA = "batch_id bigint, taken_at timestamp, num_ratings bigint, newest_event timestamp, late_rows bigint, watermark timestamp"


def observed(events: DataFrame) -> DataFrame:
    """The stream with its batches' numbers observed: ratings, and the newest event time. No pass of its own."""
    return events.observe(OBSERVED, F.count("rating").alias("num_ratings"), F.max("event_time").alias("newest_event"))


class SnapshotLog(StreamingQueryListener):
    """Writes the log of one query, known by its name, below ``path``.

    ``late_rows`` are the rows that a stateful operator left out as behind the watermark: for windowed statistics,
    groups of a window and a key that were closed already. Batches without new data are logged with 0 ratings.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self._spark, self._path, self._name = spark, path, name
        self._batches: dict[str, int] = {}  # newest batch seen of each run
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self._name:
            return
        seen = (progress.observedMetrics or {}).get(OBSERVED)
        newest = seen["newest_event"] if seen else None
        row = {
            "batch_id": progress.batchId,
            "taken_at": progress.timestamp,
            "num_ratings": seen["num_ratings"] if seen else 0,
            "newest_event": newest.isoformat() if isinstance(newest, datetime) else newest,
            "late_rows": sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators),
            "watermark": (progress.eventTime or {}).get("watermark"),
        }
        self._write(progress.batchId, json.dumps(row))
        self._batches[str(progress.runId)] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.runId))

    def _write(self, batch_id: int, line: str) -> None:
        """A file appears whole or not at all: it is written under another name first."""
        jvm = self._spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self._path}/batch={batch_id:012d}.json")
        part = jvm.org.apache.hadoop.fs.Path(f"{self._path}/_batch={batch_id:012d}.part")
        fs = target.getFileSystem(self._spark._jsc.hadoopConfiguration())
        out = fs.create(part, True)
        try:
            out.write(bytearray(line.encode()))
        finally:
            out.close()
        fs.delete(target, False)
        fs.rename(part, target)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the log of an ended query is complete: reports arrive a little later than the query ends."""
        deadline = time.monotonic() + seconds
        while str(query.runId) not in self._ended:
            if time.monotonic() > deadline:
                raise TimeoutError(f"no report of the end of {self._name}")
            time.sleep(0.05)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch so far."""
    return spark.read.schema(SCHEMA).option("pathGlobFilter", "batch=*.json").json(path)


def running_totals(log: DataFrame, last: int = 10, at: str = "newest_event") -> DataFrame:
    """(taken_at, total) after each of the last batches that had data, for ``snapshot_deltas``.

    ``at`` is the time a snapshot stands for: the newest event so far, or ``taken_at`` for the clock. What came
    before is one sum, so only ``last`` rows are ever ordered.
    """
    full = log.filter(F.col("num_ratings") > 0)
    tail = full.orderBy(F.desc("batch_id")).limit(last)
    before = full.filter(F.col("batch_id") < tail.agg(F.min("batch_id")).scalar()).agg(F.coalesce(F.sum("num_ratings"), F.lit(0)))
    so_far = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("num_ratings").over(so_far) + before.scalar()
    return tail.select(F.max(at).over(so_far).alias("taken_at"), total.alias("total"))


def late_total(log: DataFrame) -> DataFrame:
    """One row: batches, ratings, rows left out as late, and the last watermark."""
    return log.agg(
        F.count_if(F.col("num_ratings") > 0).alias("batches"),
        F.sum("num_ratings").alias("num_ratings"),
        F.sum("late_rows").alias("late_rows"),
        F.max("watermark").alias("watermark"),
    )
