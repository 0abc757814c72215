"""Joins on keys that may be very uneven.

No broadcast is forced: Spark broadcasts a side whose size it has checked against
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, and splits a skewed partition of a
shuffled join at run time (``spark.sql.adaptive.skewJoin``, on in the library settings). Streams have
no such split; for them there is a salted form. Tables of many rows in small files are merged or hashed by
shares (``merged``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BROADCAST_ROWS = 100_000  # a joined table with more rows than this is never copied to every task


def merged(rows: DataFrame, larger: DataFrame | None = None) -> DataFrame:
    """A stored table with few rows per key to join with: not copied to every task above ``BROADCAST_ROWS`` rows.

    Spark's own check goes by the bytes of the files, which say little of a table in memory where they are
    encoded by dictionaries: 1.2 million parts in files of 5 MB took some 268 MB in every task
    (the difference between measured runs with one and four copies of each part, by three).

    Both sides are sorted and merged, unless ``larger``, the stored rows it is joined with, are twice as many or
    more. Those are not sorted then: a task hashes its share of the table and lets them pass. Narrow lines
    compress to 11 bytes, so Spark's 64 MB of shuffled rows were 5.6 million to sort in one task.
    """
    size = rows.count()
    if size <= BROADCAST_ROWS:
        return rows
    return rows.hint("shuffle_hash" if larger is not None and larger.count() >= 2 * size else "merge")


def enrich(ratings: DataFrame, items: DataFrame, salts: int = 1) -> DataFrame:
    """Add item metadata to ratings (table or stream); ratings of unknown items are dropped.

    ``salts`` > 1 spreads every item over that many partitions, for streams, where nothing is split
    at run time, with an item table too large to broadcast.
    """
    return ratings.join(items, "item_id") if salts == 1 else salted_join(ratings, items, "item_id", salts)


def salted_join(rows: DataFrame, table: DataFrame, key: str, salts: int) -> DataFrame:
    """Inner join with each key of ``table`` repeated ``salts`` times.

    The salt of a row comes from its values, so a task that runs again sends every row to the same
    place. The other rows of a hot key differ in some column; exact copies share a salt.
    """
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns if c != "categories"]), F.lit(salts)).cast("int")
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("__salt", spread).join(copies, [key, "__salt"]).drop("__salt")
