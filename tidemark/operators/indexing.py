"""Dense numbering of rows, spread over the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written


def number_rows(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, ... in the given order, which must not leave ties.

    The rows are range-partitioned and sorted, then numbered inside their partition; the partition
    sizes, one row each, give the offset. The numbered rows are written first, as both steps must
    see the same partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__inside", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "numbered",
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("__part")
        .agg(F.count("*").alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    )
    # One row per partition: bounded by spark.sql.shuffle.partitions.
    return (
        rows.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__inside") + F.col("__offset"))
        .drop("__part", "__inside", "__offset")
    )


def id_index(events: DataFrame, column: str) -> DataFrame:
    """Number the ids of a column from 0 by falling frequency, equal ones by name (of numbers: their digits).

    The labels stay in a table; they are never gathered on the driver.
    """
    counts = events.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("frequency"))
    return number_rows(counts, F.desc("frequency"), F.asc(F.col(column).cast("string")), name="idx").select(
        column, F.col("idx").cast("int").alias("idx"), "frequency"
    )


def index_ids(events: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``user_index`` and ``item_index`` from two id tables; events in buckets of items are moved to their users alone."""
    by_user = users.select("user_id", F.col("idx").alias("user_index"))
    by_item = items.select("item_id", F.col("idx").alias("item_index"))
    return events.join(by_item, "item_id").join(by_user, "user_id")


def seeded_order(keys: Sequence[str], seed: int = 42) -> Column:
    """A random-looking place for every row, the same wherever the row lies; ``keys`` tell rows apart."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def replay_order(
    ratings: DataFrame, *chronological: str, seed: int = 42, keys: Sequence[str] = ("user_id", "item_id", "event_time")
) -> DataFrame:
    """Ratings by the given columns, or in a random order that depends on the seed and their keys alone."""
    return ratings.orderBy(*chronological) if chronological else ratings.orderBy(seeded_order(keys, seed), *keys)
