"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import wrap_label
from tidemark.operators import dedup, indexing, models, recommend, stats, topk, windows
from tidemark.operators.joins import enrich
from tidemark.plans import reports
from tidemark.schema import ITEM_CSV_COLUMNS, RATING_CSV_COLUMNS
from tidemark.session import dealt, new_folder, shared_dir, use_utc, written, written_by
from tidemark.sources import events as wire
from tidemark.sources import bucketed, daily, files
from tidemark.sources.tables import (
    event_ratings,
    event_stream,
    joined_table,
    line_ids,
    line_ratings,
    line_ratings_raw,
    named,
    packed_lines,
    part_items,
    table,
    unpacked,
)
from tidemark.streaming import convergence as kept_convergence
from tidemark.streaming import guard, latest, live, run, sketches, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LONG_SIZE, LONG_SLIDE = "10 hours", "2 hours"
LINE_ORDER = ("event_time", "l_orderkey", "l_linenumber")
SPLIT_KEY = "l_orderkey * 3163 + l_linenumber * 617"  # its last four digits are spread evenly


def query(fn: Query) -> Query:
    """Register under the function's name. Windows and times of day are in UTC, whatever the session's zone."""

    @wraps(fn)
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = in_utc
    return in_utc


def as_text(df: DataFrame) -> DataFrame:
    """Category lists as one string, zoned times as plain ones: types every engine compares alike."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            df = df.withColumn(field.name, F.array_join(field.name, "|"))
        elif isinstance(field.dataType, T.TimestampType):
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp_ntz"))
    return df


# -- decoding and enrichment ------------------------------------------------------------------


@query
def parse_events(spark, sf_dir):
    messages = wire.encode_events(line_ratings(spark, sf_dir))
    return as_text(wire.parse_events(messages, event_time="source"))


@query
def parse_malformed(spark, sf_dir):
    """Messages of type ``error`` are cut in half: they form a group of NULLs without ratings."""
    rows = event_ratings(spark, sf_dir)
    text = wire.encode_events(rows.filter(F.col("categories")[0] != "error"))
    half = wire.encode_events(rows.filter(F.col("categories")[0] == "error")).select(
        F.substring("value", 1, 20).alias("value")
    )
    return stats.item_stats(wire.parse_events(text.unionByName(half)))


@query
def dead_letters(spark, sf_dir):
    rows = event_ratings(spark, sf_dir)
    text = wire.encode_events(rows).select(
        F.when(F.col("value").contains('"error"'), F.substring("value", 1, 20)).otherwise(F.col("value")).alias("value")
    )
    return wire.dead_letters(text).groupBy("value").agg(F.count("*").alias("num_messages"))


@query
def sample_topic(spark, sf_dir):
    """The first 20 messages in line order."""
    at = ["l_orderkey", "l_linenumber", "item_id", "rating", "event_time"]
    return as_text(wire.sample_topic(wire.encode_events(line_ratings(spark, sf_dir), keep=at), order_by=at))


@query
def enrich_ratings(spark, sf_dir):
    return as_text(enrich(line_ratings_raw(spark, sf_dir), part_items(spark, sf_dir)))


@query
def enrich_salted(spark, sf_dir):
    return as_text(enrich(line_ratings_raw(spark, sf_dir), part_items(spark, sf_dir), salts=4))


@query
def csv_sources(spark, sf_dir):
    """Items and ratings written as CSV, read back and joined."""
    items, ratings = new_folder(spark, "items"), new_folder(spark, "ratings")
    item = [F.col("item_id"), F.col("title"), F.array_join("categories", "|")]
    part_items(spark, sf_dir).select(
        *[c.alias(name) for c, name in zip(item, ITEM_CSV_COLUMNS)]
    ).write.csv(items, header=True, escape='"')
    rating = [F.col("user_id"), F.col("item_id"), F.col("rating"), F.unix_seconds(F.col("event_time").cast("timestamp"))]
    line_ratings_raw(spark, sf_dir).select(
        *[c.alias(name) for c, name in zip(rating, RATING_CSV_COLUMNS)]
    ).write.csv(ratings, header=True, escape='"')
    return as_text(enrich(files.read_ratings(spark, ratings), files.read_items(spark, items)))


# -- statistics -------------------------------------------------------------------------------


@query
def item_stats(spark, sf_dir):
    return stats.item_stats(line_ratings(spark, sf_dir), min_count=3)


@query
def category_stats(spark, sf_dir):
    return stats.category_stats(line_ratings(spark, sf_dir))


@query
def user_stats(spark, sf_dir):
    return stats.user_stats(line_ratings_raw(spark, sf_dir))


@query
def category_volume(spark, sf_dir):
    return stats.category_volume(line_ratings(spark, sf_dir))


@query
def dedup_ratings(spark, sf_dir):
    """One bare rating per pair; only what is left is joined with the items."""
    pairs = dedup.dedup_ratings(line_ratings_raw(spark, sf_dir), order_by=LINE_ORDER)
    return as_text(enrich(pairs, part_items(spark, sf_dir)))


@query
def item_stats_dedup(spark, sf_dir):
    pairs = dedup.dedup_ratings(line_ratings_raw(spark, sf_dir), order_by=LINE_ORDER)
    return stats.item_stats(enrich(pairs, part_items(spark, sf_dir)), min_count=2)


@query
def batch_category_stats(spark, sf_dir):
    return stats.batch_category_stats(event_ratings(spark, sf_dir))


def _narrow(spark, sf_dir):
    """Order lines as bare ratings, joined once and stored, for reports that look at them several times."""
    return written(line_ratings_raw(spark, sf_dir).select("user_id", "item_id", "rating", "event_time"), "narrow")


@query
def dataset_summary(spark, sf_dir):
    summary = stats.dataset_summary(_narrow(spark, sf_dir))
    return summary.withColumns({c: F.round(c, 6) for c in ("avg_rating", "std_rating")})


@query
def trend_summary(spark, sf_dir):
    return stats.trend_summary(windows.window_category_trends(event_ratings(spark, sf_dir)))


@query
def rating_histogram(spark, sf_dir):
    return stats.rating_histogram(line_ratings_raw(spark, sf_dir))


@query
def item_avg_histogram(spark, sf_dir):
    return stats.item_avg_histogram(stats.item_stats(line_ratings(spark, sf_dir)))


@query
def kpis(spark, sf_dir):
    rows = written(line_ratings(spark, sf_dir).select("user_id", "item_id", "title", "rating"), "narrow")
    return reports.kpis(stats.item_stats(rows), stats.user_stats(rows))


# -- windows ----------------------------------------------------------------------------------


@query
def window_category_trends(spark, sf_dir):
    return windows.window_category_trends(event_ratings(spark, sf_dir))


@query
def window_item_trends(spark, sf_dir):
    return windows.window_item_trends(event_ratings(spark, sf_dir), LONG_SIZE, LONG_SLIDE)


@query
def window_uneven_trends(spark, sf_dir):
    """A size that is not a multiple of the slide: every event goes to each of its windows."""
    return windows.window_category_trends(event_ratings(spark, sf_dir), "9 hours", LONG_SLIDE)


@query
def pane_trends(spark, sf_dir):
    rows = wire.explode_categories(event_ratings(spark, sf_dir).select("event_time", "categories", "rating"))
    return windows.pane_trends(rows, "category", LONG_SIZE, LONG_SLIDE)


@query
def event_rate(spark, sf_dir):
    return windows.event_rate(event_ratings(spark, sf_dir))


@query
def interval_arrivals(spark, sf_dir):
    return windows.interval_arrivals(event_ratings(spark, sf_dir), "30 minutes")


def _trends(spark, sf_dir, size=windows.SIZE, slide=windows.SLIDE):
    return windows.window_category_trends(event_ratings(spark, sf_dir), size, slide)


def _stored_trends(spark, sf_dir, size=windows.SIZE, slide=windows.SLIDE):
    """The trend rows as a stored table, as jobs find them after the stream has written them."""
    return written(_trends(spark, sf_dir, size, slide), "trends")


@query
def trend_category_unweighted(spark, sf_dir):
    return stats.trend_category_unweighted(_trends(spark, sf_dir))


@query
def trend_category_weighted(spark, sf_dir):
    return stats.trend_category_weighted(_trends(spark, sf_dir))


@query
def latest_trends(spark, sf_dir):
    """The newest window, of the events that can be in it."""
    recent = windows.recent_events(event_ratings(spark, sf_dir), LONG_SIZE, LONG_SLIDE)
    return windows.latest_trends(windows.window_category_trends(recent, LONG_SIZE, LONG_SLIDE))


@query
def recent_top_items(spark, sf_dir):
    recent = windows.recent_events(event_ratings(spark, sf_dir), LONG_SIZE, LONG_SLIDE)
    return windows.recent_top_items(windows.window_item_trends(recent, LONG_SIZE, LONG_SLIDE))


@query
def convergence(spark, sf_dir):
    return windows.convergence(_stored_trends(spark, sf_dir))


@query
def convergence_final(spark, sf_dir):
    batch = stats.batch_category_stats(event_ratings(spark, sf_dir))
    return windows.convergence_final(_trends(spark, sf_dir), batch)


@query
def snapshot_deltas(spark, sf_dir):
    """Daily growth of the running number of ratings, for the last nine days; days are summed up first."""
    day = F.window("event_time", "1 day").getField("end").alias("taken_at")
    days = event_ratings(spark, sf_dir).groupBy(day).agg(F.count("*").alias("n"))
    so_far = Window.orderBy("taken_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return windows.snapshot_deltas(days.select("taken_at", F.sum("n").over(so_far).alias("total")))


@query
def replay_order(spark, sf_dir):
    """Ratings numbered in chronological order."""
    rows = event_ratings(spark, sf_dir).select("event_id", "user_id", "item_id", "rating", "event_time")
    return indexing.number_rows(rows, F.asc("event_time"), F.asc("event_id"))


@query
def replay_order_seeded(spark, sf_dir):
    """Ratings numbered in a random order that the seed and their ids decide."""
    rows = event_ratings(spark, sf_dir).select("event_id", "user_id", "item_id", "rating", "event_time")
    return indexing.number_rows(rows, indexing.seeded_order(["event_id"]), F.asc("event_id"))


# -- stored layouts ---------------------------------------------------------------------------


@query
def enrich_bucketed(spark, sf_dir):
    """Ratings and items in buckets, the ratings in two portions; the join moves no rating."""
    store = bucketed.BucketedRatings(spark, new_folder(spark, "bucketed"), 8)
    rows = line_ratings_raw(spark, sf_dir)
    store.create(rows.filter("l_linenumber <= 4"), part_items(spark, sf_dir))
    store.append(rows.filter("l_linenumber > 4"))
    return as_text(store.enriched())


def _daily_sink(spark, sf_dir):
    """The event stream stored by day; a file in a later day's folder that nobody committed is not looked at."""
    rows = event_stream(spark, sf_dir).drop("event_id")
    path = _finish(lambda **spec: daily.to_daily(rows, **spec), spark, "daily")
    later = spark.read.parquet(path).limit(5).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 40 DAYS"))
    later.drop(daily.DAY).write.parquet(f"{path}/{daily.DAY}=2099-01-01")
    return path


@query
def latest_trends_daily(spark, sf_dir):
    """The newest window, from the folders of the last days alone."""
    recent = daily.recent_daily(spark, _daily_sink(spark, sf_dir), LONG_SIZE, LONG_SLIDE)
    return as_text(windows.latest_trends(windows.window_category_trends(recent, LONG_SIZE, LONG_SLIDE)))


@query
def recent_top_items_daily(spark, sf_dir):
    recent = daily.recent_daily(spark, _daily_sink(spark, sf_dir), LONG_SIZE, LONG_SLIDE)
    return as_text(windows.recent_top_items(windows.window_item_trends(recent, LONG_SIZE, LONG_SLIDE)))


@query
def interval_arrivals_daily(spark, sf_dir):
    """Arrivals of the last nine half hours, the buckets before cut off by the scan."""
    recent = daily.recent_daily(spark, _daily_sink(spark, sf_dir), "5 hours", "30 minutes")
    return as_text(windows.interval_arrivals(recent, "30 minutes"))


# -- top-k ------------------------------------------------------------------------------------


@query
def top_items(spark, sf_dir):
    return topk.top_items(stats.item_stats(line_ratings(spark, sf_dir), min_count=3), 15)


@query
def top_categories(spark, sf_dir):
    return topk.top_categories(stats.category_stats(line_ratings(spark, sf_dir)), 12)


@query
def top_trend_categories(spark, sf_dir):
    return topk.top_categories(_trends(spark, sf_dir), 8, by="sum_count")


@query
def top_category_series(spark, sf_dir):
    """The window rows of the six largest categories."""
    trends = _stored_trends(spark, sf_dir)
    return topk.restrict_to(trends, topk.top_categories(trends, 6, by="sum_count"))


@query
def latest_top_series(spark, sf_dir):
    """The window rows of the six categories with the most ratings in the newest window."""
    events = event_ratings(spark, sf_dir)
    recent = windows.recent_events(events, LONG_SIZE, LONG_SLIDE)
    latest = windows.latest_trends(windows.window_category_trends(recent, LONG_SIZE, LONG_SLIDE))
    trends = windows.window_category_trends(events, LONG_SIZE, LONG_SLIDE)
    return topk.restrict_to(trends, topk.top_categories(latest, 6, by="rating_count"))


@query
def convergence_top(spark, sf_dir):
    """Convergence of the six categories with the most ratings."""
    batch = stats.batch_category_stats(event_ratings(spark, sf_dir))
    top = topk.top_categories(batch, 6, by="batch_count")
    return windows.convergence(topk.restrict_to(_stored_trends(spark, sf_dir), top))


@query
def best_category(spark, sf_dir):
    return topk.best_category(stats.category_stats(line_ratings(spark, sf_dir)))


@query
def wrapped_labels(spark, sf_dir):
    """Labels of the ten best items, broken at 12 characters."""
    best = topk.top_items(stats.item_stats(line_ratings(spark, sf_dir), min_count=3), 10)
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("text"),
    )
    return best.join(parts, "item_id").select("item_id", "text", wrap_label(F.col("text"), 12).alias("label"))


# -- comparisons ------------------------------------------------------------------------------


@query
def batch_vs_stream(spark, sf_dir):
    comparison = reports.batch_vs_stream(event_ratings(spark, sf_dir), _trends(spark, sf_dir))
    return reports.with_agreement(comparison)


@query
def agreement(spark, sf_dir):
    comparison = reports.batch_vs_stream(event_ratings(spark, sf_dir), _trends(spark, sf_dir))
    row = reports.agreement(comparison, "batch_avg", "stream_avg")
    return row.withColumns({c: F.round(c, 6) for c in ("correlation", "max_diff", "mean_diff")})


@query
def batch_vs_stream_summary(spark, sf_dir):
    return reports.batch_vs_stream_summary(event_ratings(spark, sf_dir), _stored_trends(spark, sf_dir))


@query
def dataset_report(spark, sf_dir):
    return reports.dataset_report(_narrow(spark, sf_dir))


@query
def trend_report(spark, sf_dir):
    return reports.trend_report(_trends(spark, sf_dir))


@query
def category_report(spark, sf_dir):
    return reports.category_report(line_ratings(spark, sf_dir))


# -- streams ----------------------------------------------------------------------------------


def _finish(start, spark, name):
    """Run a query over all that is there, in folders of its own; returns its output folder."""
    path, checkpoint = new_folder(spark, name), new_folder(spark, f"{name}-checkpoint")
    start(path=path, checkpoint=checkpoint, trigger="available_now").awaitTermination()
    return path


def _complete(spark, df, name):
    path = _finish(lambda **spec: run.to_snapshots(df, **spec), spark, name)
    return as_text(run.read_snapshot(spark, path))


def _current(spark, df, keys, name):
    """The whole result of a running query with keys without bound: a batch stores the rows it has changed."""
    path = _finish(lambda **spec: run.to_upserts(df, keys=keys, **spec), spark, name)
    return as_text(run.read_upserts(spark, path, keys))


@query
def stream_item_complete(spark, sf_dir):
    items = stats.item_stats(event_stream(spark, sf_dir), min_count=3)
    return _current(spark, items, ["item_id", "title"], "items")


@query
def stream_category_complete(spark, sf_dir):
    return _complete(spark, stats.category_stats(event_stream(spark, sf_dir)), "categories")


@query
def stream_user_complete(spark, sf_dir):
    return _current(spark, stats.user_stats(event_stream(spark, sf_dir)), ["user_id"], "users")


@query
def stream_window_items_complete(spark, sf_dir):
    trends = windows.window_item_trends(event_stream(spark, sf_dir), LONG_SIZE, LONG_SLIDE, "3 minutes")
    return _current(spark, trends, ["window_start", "window_end", "item_id", "title"], "window-items")


@query
def stream_trends_update(spark, sf_dir):
    trends = windows.window_category_trends(event_stream(spark, sf_dir), watermark="5 minutes")
    return _current(spark, trends, ["window_start", "window_end", "category"], "trends")


@query
def stream_trends_append(spark, sf_dir):
    trends = windows.window_category_trends(event_stream(spark, sf_dir), watermark="30 seconds")
    path = _finish(lambda **spec: run.to_parquet(trends, **spec), spark, "trends")
    return as_text(files.read_trends(spark, path))


LAST = 1 << 40  # number of a slice that comes after all others


def _in_slices(spark, sf_dir, slices=5):
    """The events as a table of equal spans of time: folders ``slice=0``, ``slice=1``, ..., each of as many files as it takes."""
    rows, path = event_ratings(spark, sf_dir).drop("event_id"), new_folder(spark, "slices")
    at = F.unix_micros(F.col("event_time").cast("timestamp"))
    low, high = rows.agg(F.min(at), F.max(at)).first()
    place = F.floor((at - low) * slices / (high - low + 1))
    rows.withColumn("slice", place.cast("bigint")).write.partitionBy("slice").parquet(path)
    return path


def _slices_of(spark, path):
    """The slices of such a table, oldest first."""
    return [n for (n,) in sorted(map(tuple, spark.read.parquet(path).select("slice").distinct().collect()))]


def _sliced_stream(spark, path):
    """The slices as one stream, for results that do not depend on what a batch holds."""
    schema = spark.read.parquet(path).drop("slice").schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{path}/slice=*")
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp"))


def _by_slices(spark, path, start):
    """One run of a query for each slice: it is put into the folder that the query watches, and worked off.

    ``start`` takes the stream and gives the started query, which goes on from the same checkpoint each time.
    """
    watched = new_folder(spark, "watched")
    schema = spark.read.parquet(path).drop("slice").schema
    for number in _slices_of(spark, path):
        spark.read.schema(schema).parquet(f"{path}/slice={number}").write.mode("append").parquet(watched)
        rows = files.stream_folder(spark, watched, schema)
        start(rows.withColumn("event_time", F.col("event_time").cast("timestamp"))).awaitTermination()


def _updated(spark, path, watermark):
    out, checkpoint, keys = new_folder(spark, "trends"), new_folder(spark, "checkpoint"), ["window_start", "window_end", "category"]

    def start(rows):
        trends = windows.window_category_trends(rows, watermark=watermark)
        return run.to_upserts(trends, out, keys, checkpoint, "available_now", every=2)

    _by_slices(spark, path, start)
    return as_text(run.read_upserts(spark, out, keys))


@query
def stream_trends_update_batches(spark, sf_dir):
    """Windows updated over several batches and restarts, combined after every second one."""
    return _updated(spark, _in_slices(spark, sf_dir), "5 minutes")


@query
def stream_trends_append_batches(spark, sf_dir):
    """Closed windows of several batches, with a restart from the checkpoint before each."""
    out, checkpoint = new_folder(spark, "trends"), new_folder(spark, "checkpoint")

    def start(rows):
        trends = windows.window_category_trends(rows, watermark="30 seconds")
        return run.to_parquet(trends, out, checkpoint, trigger="available_now")

    _by_slices(spark, _in_slices(spark, sf_dir, 2), start)
    return as_text(files.read_trends(spark, out))


def _with_late_slice(spark, sf_dir, slices=5):
    """The first day's events once more, after all others."""
    path = _in_slices(spark, sf_dir, slices)
    rows = spark.read.parquet(path).drop("slice")
    start = rows.agg(F.min("event_time")).first()[0]
    late = rows.filter(F.col("event_time") < F.lit(start) + F.expr("INTERVAL 1 DAY"))
    late.withColumn("slice", F.lit(LAST)).write.mode("append").partitionBy("slice").parquet(path)
    return path


@query
def stream_late_rows(spark, sf_dir):
    """The first events come once more after all others: they are behind the watermark and change nothing."""
    return _updated(spark, _with_late_slice(spark, sf_dir), "5 minutes")


def _kept_convergence(spark, sf_dir):
    """Convergence added to as windows close, over four runs, totals combined after every second batch."""
    path, checkpoint = new_folder(spark, "convergence"), new_folder(spark, "checkpoint")

    def start(rows):
        trends = windows.window_category_trends(rows, watermark="30 seconds")
        return kept_convergence.to_convergence(trends, path, checkpoint, "available_now", every=2)

    _by_slices(spark, _in_slices(spark, sf_dir, 4), start)
    return path


@query
def stream_convergence(spark, sf_dir):
    return as_text(kept_convergence.read_convergence(spark, _kept_convergence(spark, sf_dir)))


@query
def stream_convergence_final(spark, sf_dir):
    return as_text(kept_convergence.read_final(spark, _kept_convergence(spark, sf_dir)))


@query
def stream_item_stats_dedup(spark, sf_dir):
    """Statistics of latest ratings, kept by changes over several runs."""
    path, checkpoint = new_folder(spark, "latest"), new_folder(spark, "checkpoint")
    start = lambda rows: latest.publish_latest(rows, path, checkpoint, "available_now", every=2)
    _by_slices(spark, _in_slices(spark, sf_dir, 3), start)
    return latest.latest_item_stats(spark, path)


@query
def live_agreement(spark, sf_dir):
    """Agreement of both answers while the stream runs, from stored sums."""
    comparison = sketches.live_comparison(spark, _published(spark, sf_dir, sketches.AGREEMENT_TABLES))
    row = reports.agreement(comparison, "batch_avg", "stream_avg")
    return row.withColumns({c: F.round(c, 6) for c in ("correlation", "max_diff", "mean_diff")})


def _logged(spark, path, name):
    """Window statistics worked off slice by slice, each a run of its own, and the log of their batches."""
    out, checkpoint, log = (new_folder(spark, x) for x in ("trends", "checkpoint", "log"))
    name = f"{name}-{uuid.uuid4().hex[:8]}"
    listener = snapshots.SnapshotLog(spark, log, name)
    keys = ["window_start", "window_end", "category"]
    spark.streams.addListener(listener)
    try:
        started = []

        def start(rows):
            trends = windows.window_category_trends(snapshots.observed(rows), watermark="5 minutes")
            started.append(run.to_upserts(trends, out, keys, checkpoint, "available_now", name))
            return started[-1]

        _by_slices(spark, path, start)
        for one in started:
            listener.wait_for(one)
    finally:
        spark.streams.removeListener(listener)
    return snapshots.read_log(spark, log)


@query
def stream_snapshot_deltas(spark, sf_dir):
    """Growth between the batches of a running query, from the log it keeps, over five runs."""
    log = _logged(spark, _in_slices(spark, sf_dir), "snapshots")
    return as_text(windows.snapshot_deltas(snapshots.running_totals(log)))


@query
def stream_held_windows(spark, sf_dir):
    """Windows of a query that was stopped and started again: evicted ones from its sink, open ones from its state."""
    out, checkpoint = new_folder(spark, "trends"), new_folder(spark, "checkpoint")

    def start(rows):
        trends = guard.guarded(windows.window_category_trends(rows, LONG_SIZE, LONG_SLIDE, "30 seconds"), checkpoint)
        return run.to_parquet(trends, out, checkpoint, trigger="available_now")

    _by_slices(spark, _in_slices(spark, sf_dir, 3), start)
    keys = ["window_start", "window_end", "category"]
    closed = files.read_trends(spark, out).select(*keys, F.lit("closed").alias("state"))
    held = guard.held_windows(spark, checkpoint, ["category"]).select(*keys, F.lit("open").alias("state"))
    return as_text(closed.unionByName(held))


@query
def stream_late_numbers(spark, sf_dir):
    """How many groups of a late batch were left out, and where the watermark was."""
    return as_text(snapshots.late_total(_logged(spark, _with_late_slice(spark, sf_dir, 3), "late")))


@query
def stream_bounded_run(spark, sf_dir):
    """Two queries of one session in a bounded run that ends when both are done: the rows each has committed."""
    rows, place = event_stream(spark, sf_dir).drop("event_id"), new_folder(spark, "bounded")
    parts = {"raw": rows, "ratings": rows.filter(F.col("rating") >= 3).select("user_id", "item_id", "rating", "event_time")}
    started = [run.to_parquet(df, f"{place}/{name}", f"{place}/{name}-checkpoint", "available_now") for name, df in parts.items()]
    run.run_for(started, 3_600)
    counts = [files.read_sink(spark, f"{place}/{name}").agg(F.lit(name).alias("sink"), F.count("*").alias("num_rows"), F.sum("rating").alias("total")) for name in parts]
    return counts[0].unionByName(counts[1])


@query
def missing_input_guard(spark, sf_dir):
    """A folder without any file: window rows are an empty table, events are refused; a filled one is read."""
    empty_folder, filled = new_folder(spark, "absent"), _raw_sink(spark, sf_dir)
    try:
        files.read_raw(spark, empty_folder)
        refused = False
    except files.MissingInput:
        refused = True
    absent = files.read_trends(spark, empty_folder).agg(F.lit("absent").alias("folder"), F.count("*").alias("num_rows"))
    there = files.read_raw(spark, filled).agg(F.lit("filled").alias("folder"), F.count("*").alias("num_rows"))
    return absent.withColumn("refused", F.lit(refused)).unionByName(there.withColumn("refused", F.lit(False)))


@query
def arrival_stamp(spark, sf_dir):
    """Messages without a time of their own get the moment at which they are read."""
    began = spark.sql("select current_timestamp()").first()[0]
    messages = wire.encode_events(event_ratings(spark, sf_dir))
    rows = written(wire.parse_events(messages, event_time="arrival"), "arrived")
    inside = (F.col("event_time") >= F.lit(began)) & (F.col("event_time") <= F.current_timestamp())
    return rows.agg(F.count("*").alias("num_rows"), F.count("rating").alias("num_ratings"), F.bool_and(inside).alias("stamped"))


@query
def bounded_collect(spark, sf_dir):
    """The first rows of a report as the driver gets them, never more than asked for."""
    top = topk.top_categories(stats.category_stats(line_ratings(spark, sf_dir)), 12)
    return spark.createDataFrame(reports.collect_bounded(top, 5))


def _raw_sink(spark, sf_dir):
    rows = event_stream(spark, sf_dir)
    return _finish(lambda **spec: run.to_parquet(rows, **spec), spark, "raw")


@query
def stream_raw_sink(spark, sf_dir):
    return as_text(files.read_raw(spark, _raw_sink(spark, sf_dir)))


@query
def sink_file_read(spark, sf_dir):
    """The same folder read file by file, without its commit log."""
    return as_text(files.read_raw(spark, _raw_sink(spark, sf_dir), committed_only=False))


@query
def sink_committed_read(spark, sf_dir):
    """A file nobody committed lies in the folder and is not read."""
    path = _raw_sink(spark, sf_dir)
    rows = spark.read.parquet(path)
    rows.write.mode("append").parquet(path)
    return stats.item_stats(files.read_raw(spark, path))


@query
def sink_partitioned_read(spark, sf_dir):
    """A sink partitioned by a column, read file by file without its log."""
    rows = event_stream(spark, sf_dir).withColumn("kind", F.col("categories")[0])
    path = _finish(lambda **spec: run.to_parquet(rows, partition_by=["kind"], **spec), spark, "raw")
    return as_text(files.read_raw(spark, path, committed_only=False))


@query
def sink_pattern_read(spark, sf_dir):
    """Two sinks by one pattern, each read by its own log: what nobody committed is not read."""
    place = new_folder(spark, "sinks")
    for number in (1, 2):
        start = run.to_parquet(event_stream(spark, sf_dir), f"{place}/s{number}", f"{place}/c{number}", "available_now")
        start.awaitTermination()
        spark.read.parquet(f"{place}/s{number}").write.mode("append").parquet(f"{place}/s{number}")
    return stats.item_stats(files.read_sink(spark, f"{place}/s*"))


@query
def csv_blank_categories(spark, sf_dir):
    """Items without any category text have one blank category, until blanks are dropped."""
    path = new_folder(spark, "items")
    text = F.when(F.col("item_id").cast("int") % 2 == 0, F.array_join("categories", "|")).otherwise("")
    item = [F.col("item_id"), F.col("title"), text]
    part_items(spark, sf_dir).select(*[c.alias(n) for c, n in zip(item, ITEM_CSV_COLUMNS)]).write.csv(path, header=True)
    rows = enrich(line_ratings_raw(spark, sf_dir), files.read_items(spark, path))
    both = [wire.explode_categories(rows, drop_blank=drop).groupBy("category").agg(F.count("*").alias("n")) for drop in (False, True)]
    return both[0].join(both[1].withColumnRenamed("n", "kept"), "category", "left")


def _sink_pair(spark, sf_dir):
    path = new_folder(spark, "pair")
    places = {"raw_path": f"{path}/raw", "trends_path": f"{path}/trends", "checkpoint": f"{path}/checkpoint"}
    for started in run.to_sink_pair(event_stream(spark, sf_dir), trigger="available_now", **places):
        started.awaitTermination()
    return path


@query
def stream_sink_pair(spark, sf_dir):
    """Raw events and their closed windows in two folders: the report over both."""
    path = _sink_pair(spark, sf_dir)
    raw, trends = files.read_raw(spark, f"{path}/raw"), files.read_trends(spark, f"{path}/trends")
    return reports.batch_vs_stream(raw, trends)


@query
def live_total(spark, sf_dir):
    """The running total over a live table of categories, of which there are few."""
    name = f"live_{uuid.uuid4().hex[:12]}"
    counts = stats.category_stats(event_stream(spark, sf_dir))
    run.to_memory(counts, name, trigger="available_now").awaitTermination()
    return run.live_total(spark, name)


@query
def stream_json_category(spark, sf_dir):
    """The wire format end to end: JSON text in a folder, decoded and counted as a stream."""
    path = new_folder(spark, "messages")
    wire.encode_events(event_ratings(spark, sf_dir)).write.text(path)
    rows = wire.parse_events(files.stream_text(spark, path), columns=("categories", "rating"))
    return _complete(spark, stats.category_stats(rows), "categories")


def _live(spark, sf_dir, name, tables=live.LIVE_TABLES):
    rows = event_stream(spark, sf_dir).drop("event_id")
    path = _finish(lambda **spec: live.publish_live_tables(rows, tables=tables, **spec), spark, "live")
    return as_text(live.live_table(spark, path, name, tables))


@query
def live_item_stats(spark, sf_dir):
    return _live(spark, sf_dir, "item_stats")


@query
def live_category_stats(spark, sf_dir):
    return _live(spark, sf_dir, "category_stats")


@query
def live_user_stats(spark, sf_dir):
    return _live(spark, sf_dir, "user_stats")


@query
def live_window_items(spark, sf_dir):
    tables = {"window_item_stats": live.LiveTable(("item_id", "title"), (LONG_SIZE, LONG_SLIDE))}
    return _live(spark, sf_dir, "window_item_stats", tables)


def _published(spark, sf_dir, tables, slices=3):
    """Live tables filled by several batches, combined after every second one."""
    rows = _sliced_stream(spark, _in_slices(spark, sf_dir, slices))
    return _finish(lambda **spec: live.publish_live_tables(rows, tables=tables, every=2, **spec), spark, "live")


@query
def live_kpis(spark, sf_dir):
    """Headline numbers of a stream from stored sums, without its events."""
    return sketches.live_kpis(spark, _published(spark, sf_dir, sketches.KPI_TABLES))


@query
def live_dataset_summary(spark, sf_dir):
    row = sketches.live_dataset_summary(spark, _published(spark, sf_dir, sketches.KPI_TABLES))
    return as_text(row.withColumns({c: F.round(c, 6) for c in ("avg_rating", "std_rating")}))


@query
def live_distinct_users(spark, sf_dir):
    """Users per category: exact from stored keys, and whether the sketch is within three standard errors."""
    sketch = sketches.LiveSketch(("category",), ("user_id",))
    path = _published(spark, sf_dir, {"pairs": live.LiveTable(("category", "user_id")), "sketches": sketch})
    exact = live.live_table(spark, path, "pairs", {"pairs": live.LiveTable(("category", "user_id"))})
    counts = exact.groupBy("category").agg(F.count("*").alias("users"), F.sum("num_ratings").alias("num_ratings"))
    estimates = sketches.live_estimates(spark, path, "sketches", sketch).select("category", "events", "user_id_estimate")
    off = F.abs(F.col("user_id_estimate") - F.col("users"))
    within = off <= 1 + 3 * sketch.standard_error * F.col("users")
    return counts.join(estimates, "category").select("category", "users", "num_ratings", "events", within.alias("within"))


@query
def live_trend_summary(spark, sf_dir):
    tables = {"trends": live.LiveTable(("category",), (LONG_SIZE, LONG_SLIDE))}
    return as_text(sketches.live_trend_summary(spark, _published(spark, sf_dir, tables), "trends", tables))


# -- recommender ------------------------------------------------------------------------------


@query
def id_index(spark, sf_dir):
    return indexing.id_index(line_ratings_raw(spark, sf_dir), "item_id")


@query
def rating_matrix(spark, sf_dir):
    matrix = recommend.rating_matrix(written(line_ratings(spark, sf_dir), "events"))
    return matrix.groupBy("user_index", "item_index").agg(
        F.sum(F.col("rating").cast("double")).alias("total"), F.count("*").alias("n")
    )


@query
def als_split(spark, sf_dir):
    test = _held_out()
    rows = line_ratings_raw(spark, sf_dir).drop("event_time")
    return rows.withColumn("part", F.when(test, "test").otherwise("train"))


LINE_KEY = ("l_orderkey", "l_linenumber")
BLOCK_LINES = 20_000_000  # training lines in a factor block: the ten blocks of the plain ALS settings up to 200 million


def _held_out():
    return recommend.is_test(F.expr(SPLIT_KEY), ())


def _parts(spark, sf_dir, *columns, larger=None):
    """The parts with their ids as numbers, for lines that lie in buckets of them."""
    return joined_table(spark, sf_dir, "part", larger).select(F.col("p_partkey").alias("item_id"), *columns)


def _packed(spark, sf_dir):
    """Packed lines whose part is known, dealt to buckets of parts.

    The join is no semi-join: Spark would do that before the rows are dealt, and move them twice.
    """
    return dealt(packed_lines(spark, sf_dir), "item_id").join(_parts(spark, sf_dir).distinct(), "item_id")


def _latest_lines(packed, keep=(), also=()):
    """The latest rating per user and part of packed lines, with ids as numbers, and whether it is held out."""
    latest = dedup.dedup_ratings(unpacked(packed, *also), order_by=LINE_ORDER)
    return latest.select("user_id", "item_id", "rating", _held_out().alias("held_out"), *keep, *also)


def _known(spark, sf_dir, dedup_pairs=True, keep=()):
    """Bare ratings of the lines whose part is known, dealt to buckets of parts, with ids as numbers.

    They are moved to their parts once and deduplicated there.
    """
    if dedup_pairs:
        return _latest_lines(_packed(spark, sf_dir), keep)
    rating, lines = F.col("rating").cast("float").alias("rating"), unpacked(packed_lines(spark, sf_dir))
    rows = lines.select("user_id", "item_id", rating, _held_out().alias("held_out"), *keep)
    return dealt(rows, "item_id").join(_parts(spark, sf_dir).distinct(), "item_id")


def _known_lines(spark, sf_dir, dedup_pairs=True, keep=()):
    """The lines of ``_known`` stored in their buckets: the counts of items and the parts' names need no further shuffle.

    Time and keys of the lines are stored only as far as the caller keeps them.
    """
    return written_by(_known(spark, sf_dir, dedup_pairs, keep), "lines", "item_id", dealt_before=True)


def _marked_pairs(spark, sf_dir):
    """The latest ratings of all lines: stored in buckets of parts, and whether the part is known; and those without a part.

    Lines without a part are ranked apart, as they would lie in one bucket.
    """
    parts = _parts(spark, sf_dir).distinct().withColumn("is_part", F.lit(True))
    lines = packed_lines(spark, sf_dir).filter(F.col("item_id").isNotNull())
    marked = dealt(lines, "item_id").join(parts, "item_id", "left").withColumn("known", F.col("is_part").isNotNull())
    stored = written_by(_latest_lines(marked, also=("known",)), "marked", "item_id", dealt_before=True)
    without = dedup.dedup_ratings(line_ids(spark, sf_dir).filter(F.col("item_id").isNull()), order_by=LINE_ORDER)
    return stored, without.withColumn("held_out", _held_out())


def _fitted(spark, sf_dir, dedup_pairs=True, lines=None):
    """Known lines, predictions for the held-out ones in numbers alone (not stored), and the table of items.

    The model is fitted once and then loaded by every query. ``lines`` are those of ``_known_lines`` if the caller has them.
    """
    lines = _known_lines(spark, sf_dir, dedup_pairs) if lines is None else lines
    matrix, _, items = recommend.numbered(lines, keep=("held_out",))
    train = matrix.filter(~F.col("held_out") & F.col("rating").isNotNull())
    model = models.stored_als(train, _models(spark), block_ratings=BLOCK_LINES)
    test = matrix.filter("held_out").select("user_index", "item_index", "rating")
    return lines, recommend.predict(model, test), items


def _models(spark):
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/models"


def _with_items(predictions, items):
    """Predictions, or their sums by item, with the id of their item as text."""
    return named(predictions.join(items.select("item_id", F.col("idx").alias("item_index")), "item_index"))


def _predicted(spark, sf_dir, dedup_pairs=True):
    """Bare predictions for the held-out lines."""
    _, predictions, items = _fitted(spark, sf_dir, dedup_pairs)
    return _with_items(written(predictions, "predictions"), items)


def _described(spark, sf_dir, predictions):
    """Predictions, or their sums by item, with the title and categories of their item: of the held-out lines alone."""
    return enrich(predictions, part_items(spark, sf_dir))


def _described_sums(spark, sf_dir, predictions, items):
    """Predictions summed where the model's factors of an item meet them: only a row per item moves to its names."""
    return _described(spark, sf_dir, _with_items(recommend.item_sums(predictions), items))


def _latest_pairs(lines):
    """The latest rating per user and part and whether it is held out, stored for the steps that read it."""
    pairs = dedup.dedup_ratings(lines, order_by=LINE_ORDER)
    return written(pairs.select("user_id", "item_id", "rating", _held_out().alias("held_out")), "pairs")


def _baseline(spark, sf_dir, pairs=None):
    """The user's mean rating of the training part as prediction, for users that have one.

    In steps of 1/1024, so that sums of predictions are exact in any order.
    """
    pairs = _latest_pairs(line_ids(spark, sf_dir)) if pairs is None else pairs
    means = pairs.filter(~F.col("held_out")).groupBy("user_id").agg((F.round(F.avg("rating") * 1024) / 1024).alias("prediction"))
    known = pairs.filter("held_out").join(means, "user_id").withColumn("item_index", F.col("item_id").cast("int"))
    return _described(spark, sf_dir, named(known))


def _line_trends(spark, sf_dir, lines=None):
    """Monthly windows sliding by a week over the order lines."""
    rows = line_ratings(spark, sf_dir) if lines is None else _described(spark, sf_dir, named(lines))
    return _monthly(rows)


def _monthly(rows):
    return windows.window_category_trends(rows, "28 days", "7 days")


def _bucket_trends(spark, sf_dir, lines):
    """The windows of ``_line_trends`` from lines stored in buckets of parts, which meet the categories where they lie."""
    categories = F.split("p_name", " ").alias("categories")
    rows = lines.select("item_id", F.col("rating").cast("double").alias("rating"), "event_time")
    return _monthly(enrich(rows, _parts(spark, sf_dir, categories, larger="lineitem")))


@query
def als_rmse(spark, sf_dir):
    return recommend.rmse(_fitted(spark, sf_dir)[1])


@query
def als_rmse_all_events(spark, sf_dir):
    """Trained on all events: repeated ratings weigh more."""
    return recommend.rmse(_fitted(spark, sf_dir, dedup_pairs=False)[1])


@query
def als_item_profile(spark, sf_dir):
    return recommend.als_item_profile(_described_sums(spark, sf_dir, *_fitted(spark, sf_dir)[1:]))


@query
def als_category_profile(spark, sf_dir):
    return recommend.als_category_profile(_described_sums(spark, sf_dir, *_fitted(spark, sf_dir)[1:]))


def _named_pairs(spark, sf_dir, lines):
    """Latest ratings with the title of their item."""
    parts = _parts(spark, sf_dir, F.col("p_name").alias("title"))
    return named(lines.select("item_id", "rating").join(parts, "item_id"))


def _pairs_and_predictions(spark, sf_dir):
    """Latest ratings and summed predictions with the title and categories of their item."""
    lines, predictions, items = _fitted(spark, sf_dir)
    return _named_pairs(spark, sf_dir, lines), _described_sums(spark, sf_dir, predictions, items)


@query
def als_item_comparison(spark, sf_dir):
    return reports.compare_items(*_pairs_and_predictions(spark, sf_dir))


@query
def als_title_comparison(spark, sf_dir):
    return reports.compare_items(*_pairs_and_predictions(spark, sf_dir), by="title")


@query
def als_category_comparison(spark, sf_dir):
    packed = written_by(_packed(spark, sf_dir), "packed", "item_id", dealt_before=True)
    fitted = _fitted(spark, sf_dir, lines=_latest_lines(packed))
    profile = recommend.als_category_profile(_described_sums(spark, sf_dir, *fitted[1:]))
    return reports.compare_categories(_bucket_trends(spark, sf_dir, unpacked(packed)), profile)


@query
def als_latest_comparison(spark, sf_dir):
    lines = _known_lines(spark, sf_dir, dedup_pairs=False, keep=("event_time",))
    fitted = _fitted(spark, sf_dir, lines=lines)
    profile = recommend.als_category_profile(_described_sums(spark, sf_dir, *fitted[1:]))
    return reports.compare_latest(written(_bucket_trends(spark, sf_dir, lines), "trends"), profile)


@query
def als_vs_stream_summary(spark, sf_dir):
    predictions = _predicted(spark, sf_dir, dedup_pairs=False)
    profile = recommend.als_category_profile(_described(spark, sf_dir, predictions))
    trends = written(_line_trends(spark, sf_dir), "trends")
    return reports.als_vs_stream_summary(line_ratings_raw(spark, sf_dir), trends, predictions, profile)


@query
def als_coverage(spark, sf_dir):
    """Lines trained on, held out, predicted, and held out without a prediction."""
    marked, without = _marked_pairs(spark, sf_dir)
    pairs = marked.select("held_out").unionByName(without.select("held_out"))
    counts = pairs.agg(F.count_if(~F.col("held_out")).alias("trained"), F.count_if("held_out").alias("held_out"))
    lines = marked.filter("known").drop("known")
    predicted = _fitted(spark, sf_dir, lines=lines)[1].agg(F.count("prediction")).scalar()
    return counts.withColumn("predicted", predicted).withColumn("dropped", F.col("held_out") - F.col("predicted"))


@query
def baseline_rmse(spark, sf_dir):
    return recommend.rmse(_baseline(spark, sf_dir)).withColumn("rmse", F.round("rmse", 6))


@query
def baseline_item_profile(spark, sf_dir):
    return recommend.als_item_profile(_baseline(spark, sf_dir))


@query
def baseline_category_profile(spark, sf_dir):
    return recommend.als_category_profile(_baseline(spark, sf_dir))


def _compared_items(spark, sf_dir, by):
    pairs = _latest_pairs(line_ids(spark, sf_dir))
    return reports.compare_items(_described(spark, sf_dir, named(pairs)), _baseline(spark, sf_dir, pairs), by=by)


@query
def baseline_item_comparison(spark, sf_dir):
    return _compared_items(spark, sf_dir, "item")


@query
def baseline_title_comparison(spark, sf_dir):
    return _compared_items(spark, sf_dir, "title")


def _lines_and_pairs(spark, sf_dir):
    """The lines joined with their orders once, for windows and latest ratings."""
    lines = written(line_ids(spark, sf_dir), "lines")
    return lines, _latest_pairs(lines)


@query
def baseline_category_comparison(spark, sf_dir):
    lines, pairs = _lines_and_pairs(spark, sf_dir)
    profile = recommend.als_category_profile(_baseline(spark, sf_dir, pairs))
    return reports.compare_categories(_line_trends(spark, sf_dir, lines), profile)


@query
def baseline_latest_comparison(spark, sf_dir):
    lines, pairs = _lines_and_pairs(spark, sf_dir)
    profile = recommend.als_category_profile(_baseline(spark, sf_dir, pairs))
    return reports.compare_latest(_line_trends(spark, sf_dir, lines), profile)


@query
def baseline_summary(spark, sf_dir):
    lines, pairs = _lines_and_pairs(spark, sf_dir)
    predictions = written(_baseline(spark, sf_dir, pairs), "predictions")
    profile = recommend.als_category_profile(predictions)
    trends = written(_line_trends(spark, sf_dir, lines), "trends")
    known = _described(spark, sf_dir, named(pairs.select("item_id")))
    return reports.als_vs_stream_summary(known, trends, predictions, profile)


@query
def als_properties(spark, sf_dir):
    """What must hold of the model's predictions and reports, whatever its factors are."""
    lines, predictions, numbers = _fitted(spark, sf_dir)
    predictions = written(predictions, "predictions")
    sums = written(_described_sums(spark, sf_dir, predictions, numbers), "described")
    items = written(reports.compare_items(_named_pairs(spark, sf_dir, lines), sums), "items")
    categories = recommend.als_category_profile(sums)
    facts = predictions.agg(
        F.count("prediction").alias("predicted"),
        F.count_distinct("item_index").alias("items"),
        F.sum("rating").alias("ratings"),
        (F.max(F.abs("prediction")) < 100).alias("finite"),
        (F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)) < 4 * F.var_pop("rating")).alias("fits"),
    )
    compared = items.agg(F.count("*").alias("compared_items"), F.sum("num_ratings").alias("compared_ratings"))
    summed = categories.agg(F.count("*").alias("categories"), F.sum("als_prediction_count").alias("category_predictions"))
    columns = {c: df.select(c).scalar() for df in (compared, summed) for c in df.columns}
    return facts.select("*", *[value.alias(name) for name, value in columns.items()])


@query
def als_stream_scores(spark, sf_dir):
    """A stored model scores the events of a stream; those of users or items it has not seen are left out."""
    lines = _known_lines(spark, sf_dir, keep=("event_time", *LINE_KEY))
    matrix, users, items = recommend.numbered(lines.filter(~F.col("held_out")))
    model = models.stored_als(matrix, _models(spark), block_ratings=BLOCK_LINES)
    test = lines.filter("held_out").drop("held_out")
    source = new_folder(spark, "test")
    named(test).withColumn("event_time", F.col("event_time").cast("timestamp")).write.parquet(source)
    stream = files.stream_folder(spark, source, spark.read.parquet(source).schema)
    path = _finish(lambda **spec: run.to_parquet(models.score(model, stream, named(users), named(items)), **spec), spark, "scores")
    scores = files.read_sink(spark, path)
    # Beside the scores the batch needs no names: its rows lie in buckets of parts and move as numbers.
    plain = model.transform(indexing.index_ids(test.select("user_id", "item_id"), users, items))
    plain = plain.select("user_index", "item_index", F.col("prediction").alias("batch"))
    same = F.abs(F.col("prediction") - F.col("batch")) < 1e-4
    return scores.join(plain, ["user_index", "item_index"]).select("user_id", "item_id", "rating", *LINE_KEY, same.alias("same"))
