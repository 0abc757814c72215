"""Several live tables from one read of the stream.

Running statistics are sums and counts, which add up. So each batch stores its own sums, once per
table, and a reader adds the batches. The topic is read once for all tables, no state is kept in
the query, and keys may grow without bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import flatten_window, round3, seconds
from tidemark.operators.windows import SIZE, SLIDE
from tidemark.sources.events import explode_categories
from tidemark.streaming.run import stream_writer
from tidemark.streaming.tables import store_batch, stored_rows


@dataclass(frozen=True)
class LiveTable:
    """Statistics per key; with a window, per sliding window and key."""

    keys: tuple[str, ...]
    window: tuple[str, str] | None = None

    def sums(self, batch: DataFrame) -> DataFrame:
        rows = explode_categories(batch) if "category" in self.keys else batch
        groups = [F.window("event_time", *self.window).alias("window")] if self.window else []
        sums = rows.groupBy(*groups, *self.keys).agg(F.sum("rating").alias("total"), F.count("rating").alias("n"))
        return flatten_window(sums) if self.window else sums

    def add_up(self, sums: DataFrame) -> DataFrame:
        return sums.groupBy(*self.columns).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))

    @property
    def columns(self) -> Sequence[str]:
        return (("window_start", "window_end") if self.window else ()) + self.keys


LIVE_TABLES = {
    "item_stats": LiveTable(("item_id", "title")),
    "category_stats": LiveTable(("category",)),
    "user_stats": LiveTable(("user_id",)),
    "window_item_stats": LiveTable(("item_id", "title"), (SIZE, SLIDE)),
}


def publish_live_tables(
    events: DataFrame,
    path: str,
    checkpoint: str,
    tables: dict[str, LiveTable] = LIVE_TABLES,
    trigger: str | None = "10 seconds",
    name: str | None = None,
    every: int = 50,
) -> StreamingQuery:
    """Keep all live tables up to date from one stream of events."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for table, spec in tables.items():
                store_batch(spec.sums(batch), f"{path}/{table}", batch_id, spec.add_up, every)
        finally:
            batch.unpersist()

    return stream_writer(events, "append", trigger, checkpoint, name).foreachBatch(store).start()


def live_table(
    spark: SparkSession, path: str, table: str, tables: dict[str, LiveTable] = LIVE_TABLES
) -> DataFrame:
    """The current statistics of a live table."""
    spec = tables[table]
    return spec.add_up(stored_rows(spark, f"{path}/{table}")).select(
        *spec.columns,
        round3(F.try_divide("total", "n")).alias("avg_rating"),
        F.col("n").alias("num_ratings"),
    )


def overlap(size: str = SIZE, slide: str = SLIDE) -> float:
    """In how many windows each event is counted."""
    return seconds(size) / seconds(slide)
