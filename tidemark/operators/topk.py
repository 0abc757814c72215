"""Top-k reports. Ties are broken by key, so a report is the same on every run.

``orderBy().limit()`` keeps k rows per task and merges them; nothing is sorted globally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_items(stats: DataFrame, n: int = 15, by: str = "avg_rating") -> DataFrame:
    return stats.orderBy(F.desc(by), "item_id", "title").limit(n)


def top_categories(df: DataFrame, n: int, by: str = "num_ratings") -> DataFrame:
    """The largest categories by a column of ``df``; ``sum_count`` sums the window counts first."""
    if by == "sum_count":
        df = df.groupBy("category").agg(F.sum("rating_count").alias("sum_count"))
    return df.orderBy(F.desc(by), "category").limit(n)


def best_category(df: DataFrame, by: str = "avg_rating") -> DataFrame:
    return top_categories(df, 1, by)


def restrict_to(df: DataFrame, top: DataFrame, key: str = "category") -> DataFrame:
    """The rows whose key is in a top list."""
    return df.join(top.select(key), key, "left_semi")
