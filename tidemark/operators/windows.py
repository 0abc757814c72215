"""Event-time windows and what is derived from their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import flatten_window, in_panes, interval, milli, round3, seconds, weighted_mean
from tidemark.sources.events import explode_categories

SIZE, SLIDE = "10 minutes", "2 minutes"


def with_watermark(events: DataFrame, delay: str | None) -> DataFrame:
    return events.withWatermark("event_time", delay) if delay else events


def _sliding(events: DataFrame, keys: Sequence[str], size: str, slide: str, count: str) -> DataFrame:
    """Every event is copied into each window that covers it, then grouped: one stateful operator."""
    stats = events.groupBy(F.window("event_time", size, slide).alias("window"), *keys).agg(
        round3(F.avg("rating")).alias("avg_rating"), F.count("rating").alias(count)
    )
    return flatten_window(stats)


def pane_trends(
    events: DataFrame, key: str | Sequence[str], size: str = SIZE, slide: str = SLIDE, count: str = "rating_count"
) -> DataFrame:
    """The same sliding windows from slide-long panes.

    Events are summed once per pane and key; only the pane rows are copied into the windows they
    belong to. The shuffle carries panes instead of size/slide copies of the events. Needs a size
    that is a multiple of the slide.
    """
    keys = [key] if isinstance(key, str) else list(key)
    step, length = seconds(slide), seconds(size)
    if not in_panes(size, slide):
        raise ValueError("panes need a window size that is a multiple of the slide")
    panes = events.groupBy(F.window("event_time", slide).alias("pane"), *keys).agg(
        F.sum("rating").alias("total"), F.count("rating").alias("n")
    )
    starts = F.array(*[F.col("pane.start") - interval(i * step) for i in range(length // step)])
    return (
        panes.select(F.explode(starts).alias("window_start"), *keys, "total", "n")
        .groupBy("window_start", *keys)
        .agg(
            round3(F.try_divide(F.sum("total"), F.sum("n"))).alias("avg_rating"),
            F.sum("n").alias(count),
        )
        .select(
            "window_start", (F.col("window_start") + interval(length)).alias("window_end"), *keys, "avg_rating", count
        )
    )


def _trends(events: DataFrame, keys: Sequence[str], size: str, slide: str, count: str, panes: bool) -> DataFrame:
    """Panes unless unwanted, where they apply: on tables, with a size that is a multiple of the slide."""
    if panes and not events.isStreaming and in_panes(size, slide):
        return pane_trends(events, keys, size, slide, count)
    return _sliding(events, keys, size, slide, count)


def window_category_trends(
    events: DataFrame, size: str = SIZE, slide: str = SLIDE, watermark: str | None = None, panes: bool = True
) -> DataFrame:
    """Average and number of ratings per sliding window and category."""
    timed = with_watermark(events.select("event_time", "categories", "rating"), watermark)
    return _trends(explode_categories(timed), ["category"], size, slide, "rating_count", panes)


def window_item_trends(
    events: DataFrame, size: str = SIZE, slide: str = SLIDE, watermark: str | None = None, panes: bool = True
) -> DataFrame:
    """Average and number of ratings per sliding window and item.

    Where an item is rated at most once per slide, panes do not reduce anything and cost a second
    shuffle: turn them off there.
    """
    timed = with_watermark(events.select("event_time", "item_id", "title", "rating"), watermark)
    return _trends(timed, ["item_id", "title"], size, slide, "num_ratings", panes)


def event_rate(events: DataFrame, size: str = "30 seconds") -> DataFrame:
    """Events per tumbling bucket, unrated ones included; buckets without events have no row."""
    return (
        events.groupBy(F.window("event_time", size).alias("bucket"))
        .agg(F.count("*").alias("num_events"))
        .select(
            F.col("bucket.start").alias("bucket_start"), F.col("bucket.end").alias("bucket_end"), "num_events"
        )
    )


def interval_arrivals(events: DataFrame, size: str = "10 seconds", last: int = 9) -> DataFrame:
    """Ratings in each of the last buckets; a quiet bucket shows 0.

    Only the time column is read to find the last bucket. The count then reads the few buckets that
    are shown, whatever the length of the history.
    """
    step = seconds(size)
    bucket = F.window("event_time", size).getField("start")
    ends = events.filter(F.col("event_time").isNotNull()).agg(
        F.min("event_time").alias("event_time"), F.max("event_time").alias("newest")
    )
    newest = F.window("newest", size).getField("start")
    spine = (
        ends.select("*", bucket.alias("first"))
        .select(newest.alias("last"), "first")
        .select(
            F.explode(
                F.sequence(
                    F.greatest(F.col("first"), F.col("last") - interval((last - 1) * step)),
                    F.col("last"),
                    interval(step),
                )
            ).alias("bucket_start")
        )
    )
    recent = events.filter(F.col("event_time") >= spine.agg(F.min("bucket_start")).scalar())
    counts = recent.groupBy(bucket.alias("bucket_start")).agg(F.count("rating").alias("n"))
    return spine.join(counts, "bucket_start", "left").select(
        "bucket_start",
        (F.col("bucket_start") + interval(step)).alias("bucket_end"),
        F.coalesce("n", F.lit(0)).alias("arrivals"),
    )


def snapshot_deltas(snapshots: DataFrame, last: int = 9) -> DataFrame:
    """Growth between successive snapshots ``(taken_at, total)`` of a running total.

    Only the last snapshots are needed, one more than is shown; a total that shrank counts as 0.
    """
    tail = snapshots.filter(F.col("total").isNotNull()).orderBy(F.desc("taken_at")).limit(last + 1)
    order = Window.orderBy("taken_at")
    growth = F.greatest(F.col("total") - F.lag("total", 1, 0).over(order), F.lit(0))
    newest = Window.orderBy(F.desc("taken_at"))
    return (
        tail.select("taken_at", growth.alias("arrivals"), F.row_number().over(newest).alias("rank"))
        .filter(F.col("rank") <= last)
        .drop("rank")
    )


def recent_events(events: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """The events of the two newest of several overlapping windows, found by the time column alone.

    For what is said of the newest windows only, so that the history is neither summed nor stored.
    """
    reach = seconds(size) + 2 * seconds(slide)
    return events.filter(F.col("event_time") >= events.agg(F.max("event_time") - interval(reach)).scalar())


def latest_trends(trends: DataFrame) -> DataFrame:
    """The rows of the newest window."""
    return trends.filter(F.col("window_end") == trends.agg(F.max("window_end")).scalar())


def stable_end(trends: DataFrame) -> DataFrame:
    """The second-newest window end, or the only one there is."""
    newest = trends.select("window_end").distinct().orderBy(F.desc("window_end")).limit(2)
    return newest.agg(F.min("window_end").alias("window_end"))


def recent_top_items(trends: DataFrame, n: int = 10, min_count: int = 2) -> DataFrame:
    """The best rated items of the newest window that no longer changes."""
    stable = trends.filter(
        (F.col("window_end") == stable_end(trends).scalar()) & (F.col("num_ratings") >= min_count)
    )
    return stable.orderBy(F.desc("avg_rating"), "item_id", "title").limit(n)


def running_sums(trends: DataFrame, block: str = "1 day") -> DataFrame:
    """Per category, window after window: the weight, ratings and windows so far.

    A running sum over a category would put its whole history into one task. The time axis is cut
    into blocks instead: rows are accumulated inside a block, and the totals of the blocks before
    are added. A block holds one row per window and category, so block length over slide bounds
    every group, and the block totals are a small table.
    """
    length = seconds(block)
    position = F.floor(F.unix_seconds(F.col("window_end").cast("timestamp")) / length)
    weight = milli(F.col("avg_rating")) * F.col("rating_count")
    rows = trends.select(
        "category", "window_end", position.alias("block"), weight.alias("weight"), F.col("rating_count").alias("n")
    )
    before = Window.partitionBy("category").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("category", "block")
        .agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"), F.count("*").alias("windows"))
        .select(
            "category",
            "block",
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("weight", "n", "windows")],
        )
    )
    inside = (
        Window.partitionBy("category", "block")
        .orderBy("window_end")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = rows.select(
        "category",
        "block",
        "window_end",
        F.sum("weight").over(inside).alias("weight"),
        F.sum("n").over(inside).alias("n"),
        F.count("*").over(inside).alias("windows"),
    )
    totals = [(F.col(c) + F.col(f"{c}_before")).alias(c) for c in ("weight", "n", "windows")]
    return running.join(blocks, ["category", "block"]).select("category", "window_end", *totals)


def cumulative(sums: DataFrame) -> DataFrame:
    """Running sums as cumulative average, count and number of windows."""
    return sums.select(
        "category",
        "window_end",
        (F.try_divide("weight", "n") / 1000).alias("cumulative_avg"),
        F.col("n").alias("cumulative_count"),
        F.col("windows").alias("window_number"),
    )


def convergence(trends: DataFrame, block: str = "1 day") -> DataFrame:
    """Cumulative weighted average and count per category, window after window."""
    return cumulative(running_sums(trends, block))


def convergence_final(trends: DataFrame, batch: DataFrame) -> DataFrame:
    """Where each category's cumulative average ends, and how far that is from the batch answer.

    The last cumulative value is the weighted mean over all windows, so no running sum is needed.
    """
    last = trends.groupBy("category").agg(
        F.max("window_end").alias("last_window_end"),
        F.count("*").alias("num_windows"),
        weighted_mean(F.col("avg_rating"), F.col("rating_count")).alias("cumulative_avg"),
        F.sum("rating_count").alias("cumulative_count"),
    )
    return last.join(batch.select("category", "batch_avg"), "category").withColumn(
        "final_gap", F.abs(F.col("cumulative_avg") - F.col("batch_avg"))
    )
