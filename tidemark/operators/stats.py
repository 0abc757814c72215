"""Running and one-shot statistics, summaries and histograms.

Everything here is ``groupBy().agg()`` over mergeable aggregates: each task combines its rows
before the shuffle, so a key holding any share of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import milli, round3, weighted_mean
from tidemark.operators.dedup import PAIR, dedup_ratings
from tidemark.sources.events import explode_categories


def rating_stats(events: DataFrame, *keys: str, min_count: int = 0) -> DataFrame:
    """Average and number of ratings per key; works on tables and on streams."""
    stats = events.groupBy(*keys).agg(
        round3(F.avg("rating")).alias("avg_rating"), F.count("rating").alias("num_ratings")
    )
    return stats.filter(F.col("num_ratings") >= min_count) if min_count else stats


def item_stats(events: DataFrame, min_count: int = 0) -> DataFrame:
    """Per item; an item whose title changed counts as two groups."""
    return rating_stats(events, "item_id", "title", min_count=min_count)


def user_stats(events: DataFrame) -> DataFrame:
    return rating_stats(events, "user_id")


def category_stats(events: DataFrame) -> DataFrame:
    """Per category; events are exploded and summed in the same pass, ahead of the only shuffle."""
    return rating_stats(explode_categories(events.select("categories", "rating")), "category")


def batch_category_stats(events: DataFrame) -> DataFrame:
    """The one-shot answer per category: unrounded mean and count, blank categories left out."""
    rows = explode_categories(events.select("categories", "rating"), drop_blank=True)
    return rows.groupBy("category").agg(F.avg("rating").alias("batch_avg"), F.count("rating").alias("batch_count"))


def category_volume(events: DataFrame) -> DataFrame:
    rows = explode_categories(events.select("categories", "rating"))
    return rows.groupBy("category").agg(F.count("rating").alias("num_ratings"))


def item_stats_dedup(
    events: DataFrame,
    keys: Sequence[str] = PAIR,
    min_count: int = 2,
    order_by: Sequence[str] = ("event_time",),
) -> DataFrame:
    """Item statistics with one rating per (user, item)."""
    return item_stats(dedup_ratings(events, keys, order_by), min_count)


def dataset_summary(events: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: volume, distinct items and users, mean, sample deviation and time span.

    Distinct counts are exact, each by a grouping of its own column (several in one aggregate would
    copy every row); ``approximate`` swaps in sketches where that is enough.
    """

    def distinct(name: str) -> Column:
        if approximate:
            return F.approx_count_distinct(name)
        return events.select(name).distinct().agg(F.count(name)).scalar()

    return events.agg(
        F.count("*").alias("ratings"),
        distinct("item_id").alias("items"),
        distinct("user_id").alias("users"),
        F.avg("rating").alias("avg_rating"),
        F.stddev_samp("rating").alias("std_rating"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def trend_summary(trends: DataFrame) -> DataFrame:
    """One row: window rows, distinct windows and the span they cover."""
    return trends.agg(
        F.count("*").alias("trend_rows"),
        F.count_distinct("window_end").alias("windows"),
        F.min("window_start").alias("first_start"),
        F.max("window_end").alias("last_end"),
    )


def trend_category_unweighted(trends: DataFrame) -> DataFrame:
    """Plain mean over the window averages of a category, and how many windows it appears in."""
    return trends.groupBy("category").agg(
        round3(F.avg(milli(F.col("avg_rating"))) / 1000).alias("streaming_avg"), F.count("rating_count").alias("num_windows")
    )


def trend_category_weighted(trends: DataFrame) -> DataFrame:
    """Count-weighted mean over all windows. Windows overlap, so each event counts size/slide times."""
    return trends.groupBy("category").agg(
        weighted_mean(F.col("avg_rating"), F.col("rating_count")).alias("stream_avg"),
        F.sum("rating_count").alias("stream_count"),
    )


def rating_histogram(events: DataFrame, lo: float = 0.5, width: float = 0.5) -> DataFrame:
    """All ratings per bin of fixed width, closed on the left; below ``lo`` bins are negative, NULL is one."""
    return _histogram(events, "rating", lo, width)


def item_avg_histogram(stats: DataFrame, lo: float = 0.5, hi: float = 5.5, width: float = 1.0) -> DataFrame:
    """Items per bin of their average rating; averages outside ``[lo, hi)`` are not counted."""
    inside = (F.col("avg_rating") >= lo) & (F.col("avg_rating") < hi)
    return _histogram(stats.filter(inside), "avg_rating", lo, width)


def _histogram(df: DataFrame, column: str, lo: float, width: float) -> DataFrame:
    position = F.floor((F.col(column) - lo) / width)
    return (
        df.groupBy(position.alias("bin"))
        .agg(F.count("*").alias("num"))
        .select(
            "bin",
            (F.col("bin") * width + lo).alias("bin_start"),
            ((F.col("bin") + 1) * width + lo).alias("bin_end"),
            "num",
        )
    )
