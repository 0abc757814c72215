"""Results that batches add to, against the same over all events so far, after every batch."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set, events
from tidemark.operators import stats, windows
from tidemark.plans import reports
from tidemark.sources import files
from tidemark.streaming import convergence, latest, live, sketches

START = datetime(2024, 1, 1, 10)


def rated(spark, rows):
    """Rows of (user, item, minute, rating, categories)."""
    return events(spark, [(u, i, f"title {i}", list(c), r, None if m is None else START + timedelta(minutes=m)) for u, i, m, r, c in rows])


def batches(spark, tmp_path, frames, start):
    seen = None
    for frame in frames:
        frame.write.mode("append").parquet(f"{tmp_path}/in")
        start(files.stream_folder(spark, f"{tmp_path}/in")).awaitTermination()
        seen = frame if seen is None else seen.unionByName(frame)
        yield seen


@pytest.mark.parametrize("every", [50, 2])
def test_convergence_after_every_batch(spark, tmp_path, every):
    frames = [rated(spark, [("u", str(k), m, 0.5 + (k * 7 + m) % 10 / 2, ("a", "b" if k % 2 else "c")) for k, m in enumerate(range(s, s + 40, 3))]) for s in (0, 40, 700, 740, 2_900)]
    path, delay = f"{tmp_path}/out", timedelta(minutes=1)
    start = lambda rows: convergence.to_convergence(windows.window_category_trends(rows, watermark="1 minute"), path, f"{tmp_path}/ckpt", "available_now", every=every)
    columns = ["category", "window_end", "cumulative_avg", "cumulative_count", "window_number"]
    for seen in batches(spark, tmp_path, frames, start):
        end = seen.agg(F.max("event_time")).first()[0] - delay
        closed = windows.window_category_trends(seen).filter(F.col("window_end") <= F.lit(end))
        assert as_set(convergence.read_convergence(spark, path), *columns) == as_set(windows.convergence(closed), *columns)
        last = ["category", "last_window_end", "num_windows", "cumulative_avg", "cumulative_count"]
        final = windows.convergence_final(closed, stats.batch_category_stats(seen))
        assert as_set(convergence.read_final(spark, path), *last) == as_set(final, *last)


def test_a_repeated_batch_and_what_it_reads(spark, tmp_path):
    path = f"{tmp_path}/out"
    frames = [rated(spark, [("u", "1", m, 4.0, ("a",)), ("u", "2", m + 1, 2.0, ("a",))]) for m in (0, 100, 200, 300)]
    for n, frame in enumerate(frames):
        for _ in range(2):  # a failed batch is attempted again, its folders may be there already
            convergence.store_closed(windows.window_category_trends(frame), path, n, every=2)
    columns = ["category", "window_end", "cumulative_avg", "cumulative_count", "window_number"]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    assert as_set(convergence.read_convergence(spark, path), *columns) == as_set(windows.convergence(windows.window_category_trends(whole)), *columns)
    read = convergence._before(spark, path, 3).inputFiles()
    assert read and all("/totals/" in f for f in read)  # no window and no running value of an earlier batch
    assert convergence._before(spark, path, 0) is None


def test_latest_ratings_after_every_batch(spark, tmp_path):
    frames = [
        rated(spark, [("u1", "1", 0, 1.0, ("a",)), ("u2", "1", 0, 2.0, ("a",)), ("u1", "2", 5, 3.0, ("a",)), ("u2", "2", 1, None, ("a",))]),
        rated(spark, [("u1", "1", 10, 5.0, ("a",)), ("u2", "1", -5, 4.5, ("a",)), ("u2", "2", 20, 0.5, ("a",))]),  # replaced, too late, rated now
        rated(spark, [("u1", "1", 10, 5.0, ("a",)), ("u1", "1", 10, 4.0, ("a",)), ("u1", "2", 30, None, ("a",)), ("u3", "1", None, 2.0, ("a",)), (None, "1", 1, 1.0, ("a",))]),
        rated(spark, [("u3", "1", 0, 3.5, ("a",)), (None, "1", 2, 1.5, ("a",)), ("u4", "2", 0, 2.5, ("a",)), ("u4", None, 0, 2.5, ("a",))]),
    ]
    path = f"{tmp_path}/out"
    start = lambda rows: latest.publish_latest(rows, path, f"{tmp_path}/ckpt", "available_now", every=2)
    columns = ["item_id", "title", "avg_rating", "num_ratings"]
    for seen in batches(spark, tmp_path, frames, start):
        expected = as_set(stats.item_stats_dedup(seen, min_count=1), *columns)
        assert as_set(latest.latest_item_stats(spark, path, min_count=1), *columns) == expected and expected


def test_a_changed_title_moves_the_rating(spark, tmp_path):
    first, second = rated(spark, [("u", "1", 0, 1.0, ("a",))]), rated(spark, [("u", "1", 9, 2.0, ("a",))]).withColumn("title", F.lit("new"))
    start = lambda rows: latest.publish_latest(rows, f"{tmp_path}/out", f"{tmp_path}/ckpt", "available_now")
    list(batches(spark, tmp_path, [first, second], start))
    rows = latest.latest_item_stats(spark, f"{tmp_path}/out", min_count=1).collect()
    assert [(r.title, r.avg_rating, r.num_ratings) for r in rows] == [("new", 2.0, 1)]


def test_many_pairs_are_worked_off_together(spark, tmp_path):
    """Thousands of pairs in a batch, half of them rated again in the next: no state and no call of Python for each."""
    pairs = [spark.range(start, start + 4_000).select(
        (F.col("id") % 500).cast("string").alias("user_id"), (F.col("id") / 500).cast("int").cast("string").alias("item_id"),
        F.lit("t").alias("title"), F.array(F.lit("a")).alias("categories"), (F.col("id") * 7 % 10 / 2).alias("rating"),
        (F.lit(START) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 97)).alias("event_time"),
    ) for start in (0, 2_000, 1_000)]
    pairs[1] = pairs[1].withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 2 DAYS"))
    path, done = f"{tmp_path}/out", []

    def start(rows):
        done.append(latest.publish_latest(rows, path, f"{tmp_path}/ckpt", "available_now", every=2))
        return done[-1]

    columns = ["item_id", "title", "avg_rating", "num_ratings"]
    for seen in batches(spark, tmp_path, pairs, start):
        assert as_set(latest.latest_item_stats(spark, path, min_count=1), *columns) == as_set(stats.item_stats_dedup(seen, min_count=1), *columns)
    assert all(not progress["stateOperators"] for query in done for progress in query.recentProgress)


def test_a_repeated_batch_of_latest_ratings_changes_nothing(spark, tmp_path):
    def batch(*ratings):
        rows = rated(spark, [("u", str(i), m, r, ("a",)) for i, m, r in ratings])
        return rows.select("user_id", "item_id", F.unix_micros(F.col("event_time").cast("timestamp")).alias("at"), "rating", "title")

    path = f"{tmp_path}/out"
    for n, rows in enumerate([batch((1, 0, 1.0), (2, 0, 2.0)), batch((1, 5, 4.0)), batch((2, 5, 5.0)), batch((1, 9, 3.0), (2, 1, 0.5))]):
        for _ in range(2):
            latest.store_latest(rows, path, n, every=2)
    assert as_set(latest.latest_item_stats(spark, path, min_count=1), "item_id", "avg_rating", "num_ratings") == {("1", 3.0, 1), ("2", 5.0, 1)}


def test_agreement_after_every_batch(spark, tmp_path):
    frames = [rated(spark, [("u", str(k), s + k, 0.5 + (k * 13 + s) % 10 / 2, ("a", f"c{k % 4}", "")) for k in range(30)]) for s in (0, 15, 400)]
    start = lambda rows: live.publish_live_tables(rows, f"{tmp_path}/out", f"{tmp_path}/ckpt", sketches.AGREEMENT_TABLES, "available_now", every=2)
    for seen in batches(spark, tmp_path, frames, start):
        expected = reports.batch_vs_stream(seen, windows.window_category_trends(seen))
        got = sketches.live_comparison(spark, f"{tmp_path}/out")
        assert as_set(got, *got.columns) == as_set(expected, *expected.columns)
        both = [reports.agreement(x, "batch_avg", "stream_avg").first() for x in (got, expected)]
        assert both[0].correlation == pytest.approx(both[1].correlation, rel=1e-9) and both[0].max_diff == both[1].max_diff
