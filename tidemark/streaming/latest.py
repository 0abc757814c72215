"""Item statistics of a stream in which a user's later rating of an item replaces the earlier one.

The rating that counts is stored per (user, item). A batch is brought to one row per pair, joined with the stored
pairs it names, and only what replaces or adds a rating is written. A rating that replaces another gives two changes
for its item, one that takes the old one away and one that adds the new one; changes add up like any other sums, so
they are stored with the batch and read as a live table. Late and repeated ratings change nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.dedup import PAIR
from tidemark.sources.files import MissingInput
from tidemark.streaming.live import LiveTable, live_table
from tidemark.streaming.run import stream_writer
from tidemark.streaming.tables import store_batch, stored_rows

TABLES = {"latest_item_stats": LiveTable(("item_id", "title"))}
PAIRS = "latest_pairs"
_VALUE = ("at", "rating", "title")


def _latest(rows: DataFrame) -> DataFrame:
    """The row of each pair that counts: the latest, then the highest rating; NULL comes before all others."""
    newest = rows.groupBy(*PAIR).agg(F.max(F.struct(*_VALUE)).alias("__newest"))
    return newest.select(*PAIR, "__newest.*")


def _same_pair(a: str, b: str) -> Column:
    return reduce(Column.__and__, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in PAIR))


def changed_pairs(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """The rows, one per pair, that replace or add a rating, with the one they replace as a struct ``old``."""
    if known is None:
        return rows.withColumn("old", F.lit(None).cast(rows.select(F.struct(*_VALUE)).schema[0].dataType))
    named = _latest(known.alias("k").join(rows.alias("r"), _same_pair("k", "r"), "left_semi"))
    before = named.select(*PAIR, F.struct(*_VALUE).alias("old"))
    both = rows.alias("r").join(before.alias("b"), _same_pair("r", "b"), "left").select("r.*", "b.old")
    later = F.struct("at", "rating") > F.struct("old.at", "old.rating")
    return both.filter(F.col("old").isNull() | later)


def changes(changed: DataFrame) -> DataFrame:
    """(item_id, title, total, n) to be added up: what the changed pairs change in the statistics of their items."""

    def counted(value: str, sign: int) -> DataFrame:
        rating = F.col(f"{value}rating")
        return changed.filter(F.lit(sign > 0) | F.col("old").isNotNull()).select(
            "item_id",
            F.col(f"{value}title").alias("title"),
            (F.coalesce(rating, F.lit(0.0)) * sign).alias("total"),
            (rating.isNotNull().cast("bigint") * sign).alias("n"),
        )

    return counted("", 1).unionByName(counted("old.", -1))


def _known(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The pairs stored before a batch."""
    try:
        return stored_rows(spark, f"{path}/{PAIRS}", before=batch_id, batches_before=batch_id)
    except MissingInput:
        return None


def store_latest(batch: DataFrame, path: str, batch_id: int, every: int) -> None:
    """Store what a batch changes; a batch that is attempted again replaces its own rows.

    Its pairs are written first, so that Spark knows their size: the stored pairs are scanned once, and
    shuffled only for a batch that is too large to be broadcast.
    """
    spark, spec = batch.sparkSession, TABLES["latest_item_stats"]
    _latest(batch).write.mode("overwrite").parquet(f"{path}/incoming")
    changed = changed_pairs(spark.read.parquet(f"{path}/incoming"), _known(spark, path, batch_id))
    changed = changed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store_batch(spec.add_up(changes(changed)), f"{path}/latest_item_stats", batch_id, spec.add_up, every)
        store_batch(changed.select(*PAIR, *_VALUE), f"{path}/{PAIRS}", batch_id, _latest, every)
    finally:
        changed.unpersist()


def publish_latest(
    events: DataFrame, path: str, checkpoint: str, trigger: str | None = "10 seconds", name: str | None = None, every: int = 50
) -> StreamingQuery:
    """Keep the statistics of latest ratings; no pair is ever forgotten, so the table of pairs grows with their number."""
    rows = events.select(*PAIR, F.unix_micros(F.col("event_time").cast("timestamp")).alias("at"), "rating", "title")

    def store(batch: DataFrame, batch_id: int) -> None:
        store_latest(batch, path, batch_id, every)

    return stream_writer(rows, "append", trigger, checkpoint, name).foreachBatch(store).start()


def latest_item_stats(spark: SparkSession, path: str, min_count: int = 2) -> DataFrame:
    """``item_stats_dedup`` of all events so far, from stored changes alone."""
    return live_table(spark, path, "latest_item_stats", TABLES).filter(F.col("num_ratings") >= min_count)
