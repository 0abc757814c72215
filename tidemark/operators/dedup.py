"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAIR = ("user_id", "item_id")


def dedup_ratings(
    events: DataFrame, keys: Sequence[str] = PAIR, order_by: Sequence[str] = ("event_time",)
) -> DataFrame:
    """The latest row per key: the largest ``order_by`` values, then the highest rating.

    Spark keeps only the first row per key in every task before the shuffle (a partial group
    limit), so copies of one key never meet in one task.
    """
    order = [F.desc(c) for c in (*order_by, "rating")]
    ranked = events.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")
