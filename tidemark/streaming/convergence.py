"""Convergence kept up as windows close: a batch adds its own windows to stored totals and never reads older ones.

Append mode gives windows in the order in which they close, so those of a batch come after all before. What is
known of these is one row per category: that is all a batch reads besides its own windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import milli
from tidemark.operators.windows import cumulative, running_sums
from tidemark.sources.files import MissingInput
from tidemark.streaming.run import stream_writer
from tidemark.streaming.tables import finished_batches, store_batch, stored_rows

TOTALS = ("weight", "n", "windows")


def _add_up(totals: DataFrame) -> DataFrame:
    return totals.groupBy("category").agg(*[F.sum(c).alias(c) for c in TOTALS], F.max("last_end").alias("last_end"))


def _batch_totals(closed: DataFrame) -> DataFrame:
    return closed.groupBy("category").agg(
        F.sum(milli(F.col("avg_rating")) * F.col("rating_count")).alias("weight"),
        F.sum("rating_count").alias("n"),
        F.count("*").alias("windows"),
        F.max("window_end").alias("last_end"),
    )


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    try:
        return _add_up(stored_rows(spark, f"{path}/totals", before=batch_id, batches_before=batch_id))
    except MissingInput:
        return None


def store_closed(closed: DataFrame, path: str, batch_id: int, every: int = 50) -> None:
    """Write the running values of a batch's windows, then its totals. A repeated batch replaces its own."""
    spark = closed.sparkSession
    closed.write.mode("overwrite").parquet(f"{path}/closed/batch_id={batch_id}")  # the state is read once
    closed = spark.read.parquet(f"{path}/closed/batch_id={batch_id}")
    rows, before = running_sums(closed), _before(spark, path, batch_id)
    if before is not None:
        earlier = before.select("category", *[F.col(c).alias(f"{c}_before") for c in TOTALS])
        sums = {c: F.col(c) + F.coalesce(f"{c}_before", F.lit(0)) for c in TOTALS}
        rows = rows.join(earlier, "category", "left").withColumns(sums).select(rows.columns)
    cumulative(rows).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
    store_batch(_batch_totals(closed), f"{path}/totals", batch_id, _add_up, every)


def to_convergence(
    trends: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds", name: str | None = None, every: int = 50
) -> StreamingQuery:
    """Keep the convergence of a stream of category windows (``window_category_trends`` with a watermark)."""
    return stream_writer(trends, "append", trigger, checkpoint, name).foreachBatch(
        lambda closed, batch_id: store_closed(closed, path, batch_id, every)
    ).start()


def read_convergence(spark: SparkSession, path: str) -> DataFrame:
    """All running values so far, as ``convergence`` gives them for the closed windows."""
    numbers = finished_batches(spark, f"{path}/rows")
    if not numbers:
        raise MissingInput(f"nothing stored under {path}")
    return spark.read.parquet(*[f"{path}/rows/batch_id={n}" for n in numbers])


def read_final(spark: SparkSession, path: str) -> DataFrame:
    """Where each category stands: its newest closed window, number of windows, cumulative average and count."""
    totals = _add_up(stored_rows(spark, f"{path}/totals"))
    return totals.select(
        "category",
        F.col("last_end").alias("last_window_end"),
        F.col("windows").alias("num_windows"),
        (F.try_divide("weight", "n") / 1000).alias("cumulative_avg"),
        F.col("n").alias("cumulative_count"),
    )
