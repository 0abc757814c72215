"""Starting, bounding and watching streaming queries, and their sinks."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemark.operators.windows import SIZE, SLIDE, window_category_trends
from tidemark.sources.files import stream_folder
from tidemark.streaming.tables import newest_result, store_batch, store_result, stored_rows

MODES = ("append", "update", "complete")


def stream_writer(
    df: DataFrame,
    mode: str = "append",
    trigger: str | None = None,
    checkpoint: str | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """A stream writer with output mode, trigger, checkpoint and name.

    ``trigger`` is a processing interval, ``available_now`` to work off what is there and stop, or
    None to start each batch when the one before is done. Every query needs a checkpoint of its own.
    """
    if mode not in MODES:
        raise ValueError(f"unknown output mode: {mode}")
    writer = df.writeStream.outputMode(mode)
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.queryName(name) if name else writer


def to_console(df: DataFrame, mode: str = "append", rows: int = 10, **spec) -> StreamingQuery:
    """Print the first rows of every batch in full width."""
    return stream_writer(df, mode, **spec).format("console").option("truncate", False).option("numRows", rows).start()


def to_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "30 seconds",
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet folder with Spark's file sink: its commit log makes each batch count once."""
    writer = stream_writer(df, "append", trigger, checkpoint, name).format("parquet").option("path", path)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def to_sink_pair(
    events: DataFrame,
    raw_path: str,
    trends_path: str,
    checkpoint: str,
    size: str = SIZE,
    slide: str = SLIDE,
    watermark: str = "30 seconds",
    trigger: str | None = "30 seconds",
) -> Iterator[StreamingQuery]:
    """Store the events, and the closed category windows of the stored events.

    The second query reads what the first has committed, so both folders hold the same events with
    the same time stamps, and the topic is read and decoded once. The queries start one after the
    other as they are taken from the iterator.
    """
    yield to_parquet(events, raw_path, f"{checkpoint}/raw", trigger)
    stored = stream_folder(events.sparkSession, raw_path, events.schema)
    trends = window_category_trends(stored, size, slide, watermark)
    yield to_parquet(trends, trends_path, f"{checkpoint}/trends", trigger)


def to_memory(
    df: DataFrame, name: str, mode: str = "complete", trigger: str | None = None, checkpoint: str | None = None
) -> StreamingQuery:
    """Keep the result as a table on the driver: only for results known to be small."""
    return stream_writer(df, mode, trigger, checkpoint, name).format("memory").start()


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row per key; rows are combined per task before the shuffle."""
    values = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "__stored_in").alias("__newest"))
    return newest.select(*keys, *[F.col(f"__newest.{c}").alias(c) for c in values])


def to_upserts(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
    every: int = 50,
) -> StreamingQuery:
    """Store the changed rows of every batch of an update-mode query, for ``read_upserts``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("__stored_in", F.lit(batch_id).cast("bigint"))
        store_batch(rows, path, batch_id, lambda all_rows: _newest(all_rows, keys), every)

    return stream_writer(df, "update", trigger, checkpoint, name).foreachBatch(store).start()


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current row of every key."""
    return _newest(stored_rows(spark, path), keys).drop("__stored_in")


def to_snapshots(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Store the whole result of a complete-mode query, executors writing in parallel.

    For results of a bounded size, such as statistics per category: every batch writes all of it. Keys
    without bound, and windows, belong into ``to_upserts`` or the live tables.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        store_result(batch, path, batch_id)

    return stream_writer(df, "complete", trigger, checkpoint, name).foreachBatch(store).start()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest result whose writing has finished."""
    return newest_result(spark, path)


def run_stream(df: DataFrame, sink: str, mode: str = "append", **spec) -> StreamingQuery:
    """Start a query by the name of its sink; ``spec`` holds what that sink takes."""
    if sink == "console":
        return to_console(df, mode, **spec)
    if sink == "memory":
        return to_memory(df, mode=mode, **spec)
    writers = {
        ("parquet", "append"): to_parquet,
        ("table", "update"): to_upserts,
        ("table", "complete"): to_snapshots,
    }
    if (sink, mode) not in writers:
        raise ValueError(f"no {sink} sink for {mode} mode")
    return writers[sink, mode](df, **spec)


def live_total(spark: SparkSession, table: str) -> DataFrame:
    """Running total of a live result table; no row while the table is empty."""
    return spark.table(table).agg(F.sum("num_ratings").alias("total")).filter(F.col("total").isNotNull())


def run_for(queries: Iterable[StreamingQuery], seconds: float) -> None:
    """Let queries run for a time, then stop them all; one that fails ends the run with its error."""
    queries = list(queries)
    deadline = time.monotonic() + seconds
    try:
        while (left := deadline - time.monotonic()) > 0 and any(query.isActive for query in queries):
            for query in queries:
                if not query.isActive:
                    query.awaitTermination()  # raises the error of one that failed
            time.sleep(min(0.2, left))
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Wait until any query of the session ends."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


class LateRows(StreamingQueryListener):
    """Rows that were behind the watermark and left out, added up per query from its start on.

    ``spark.streams.addListener(late)`` before the queries start; progress reports that Spark forgets
    later on have been counted by then. A restarted query goes on from its earlier count.
    """

    def __init__(self) -> None:
        self._rows: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self._rows[str(event.progress.id)] += dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        """The rows of a query, as far as its reports have arrived."""
        return self._rows[str(query.id)]
