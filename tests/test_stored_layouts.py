"""Ratings in buckets and events by day: what the plans leave out, and results that don't change."""

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set, at, events
from tidemark.operators import windows
from tidemark.operators.joins import enrich
from tidemark.sources import daily
from tidemark.sources.bucketed import BucketedRatings
from tidemark.sources.files import MissingInput, stream_folder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ratings(spark, start, stop, hot=3):
    """A third of the ratings are of one item."""
    return spark.range(start, stop).select(
        F.when(F.col("id") % hot == 0, "hot").otherwise(F.concat(F.lit("i"), F.col("id") % 500)).alias("item_id"),
        F.concat(F.lit("u"), F.col("id")).alias("user_id"),
        (F.col("id") % 10 / 2.0).alias("rating"),
    )


def items(spark):
    named = spark.range(400).select(F.concat(F.lit("i"), F.col("id")).alias("item_id"), F.concat(F.lit("t"), F.col("id")).alias("title"))
    return named.unionByName(spark.createDataFrame([("hot", "the hot one")], "item_id string, title string"))


def test_no_rating_is_moved(spark, tmp_path, no_broadcast):
    store = BucketedRatings(spark, str(tmp_path / "store"), 8)
    store.create(ratings(spark, 0, 6_000), items(spark))
    store.append(ratings(spark, 6_000, 9_000))
    joined = store.enriched()
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    every = ratings(spark, 0, 9_000)
    columns = ["user_id", "item_id", "rating", "title"]
    assert sorted(map(tuple, joined.select(columns).collect())) == sorted(map(tuple, enrich(every, items(spark)).select(columns).collect()))
    assert store.ratings().count() == 9_000
    # the same folder opened by another name for it, as a later session would
    again = BucketedRatings(spark, str(tmp_path / "store"), 8)
    assert again.enriched(F.col("rating") >= 4).count() == joined.filter("rating >= 4").count()
    assert "PushedFilters: [IsNotNull(rating), GreaterThanOrEqual(rating,4.0)" in plan(again.enriched(F.col("rating") >= 4))


def test_a_hot_item_is_in_many_buckets(spark, tmp_path):
    """No bucket holds much more than its share, though a third of all ratings are of one item."""
    store = BucketedRatings(spark, str(tmp_path / "store"), 8)
    store.create(ratings(spark, 0, 9_000), items(spark))
    files = spark.read.parquet(f"{tmp_path}/store/ratings").select("item_id", F.input_file_name().alias("f"))
    bucket = F.regexp_extract("f", r"_(\d+)\.c000", 1)
    sizes = files.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.count_if(F.col("item_id") == "hot").alias("hot")).collect()
    assert sum(r.n for r in sizes) == 9_000 and max(r.n for r in sizes) < 3 * 9_000 / 8
    assert sum(r.hot > 0 for r in sizes) >= 2 and max(r.hot for r in sizes) < 3_000
    assert [(r.item_id, r.parts) for r in store._hot().collect()] == [("hot", 3)]


def test_items_without_ratings_and_ratings_without_items(spark, tmp_path):
    store = BucketedRatings(spark, str(tmp_path / "store"), 4)
    rows = spark.createDataFrame([("a", 1.0), (None, 2.0), ("x", None), ("a", 1.0)], "item_id string, rating double")
    store.create(rows, spark.createDataFrame([("a", "A"), ("b", "B")], "item_id string, title string"))
    assert sorted(map(tuple, store.enriched().select("item_id", "rating", "title").collect())) == [("a", 1.0, "A")] * 2
    assert store.ratings().count() == 4
    empty = BucketedRatings(spark, str(tmp_path / "empty"), 4)
    empty.create(rows.limit(0), spark.createDataFrame([("a", "A")], "item_id string, title string"))
    assert empty.enriched().count() == 0
    empty.append(rows)
    assert empty.enriched().count() == 2


def by_days(spark, n=20):
    return events(spark, [("u", str(k % 3), f"t{k % 3}", ["a", f"b{k % 2}"], 1.0 + k % 4, at("10:00:00") + timedelta(hours=7 * k)) for k in range(n * 3)])


def read_files(df):
    """Files that a run of the scan opens, from its metrics."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().get("numFiles").get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_only_the_last_days_are_opened(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = by_days(spark)
    daily.write_daily(rows, path)
    assert len(daily.days(spark, path)) == 18
    assert daily.newest_event(spark, path) == rows.agg(F.max("event_time")).first()[0]
    recent = daily.recent_daily(spark, path, "10 hours", "2 hours")
    assert re.search(r"PartitionFilters: \[[^\]]*event_day[^\]]*>=", plan(recent))
    got = windows.latest_trends(windows.window_category_trends(recent, "10 hours", "2 hours"))
    expected = windows.latest_trends(windows.window_category_trends(rows, "10 hours", "2 hours"))
    columns = ["window_start", "window_end", "category", "avg_rating", "rating_count"]
    assert as_set(got, *columns) == as_set(expected, *columns)
    every = read_files(daily.read_daily(spark, path))
    assert every >= 18 and read_files(recent) <= 8 * 2 < every


def test_daily_stream_with_restart_late_rows_and_rows_without_time(spark, tmp_path):
    path, checkpoint, source = (str(tmp_path / x) for x in ("daily", "checkpoint", "in"))
    late = events(spark, [("u", "9", "late", ["z"], 5.0, at("11:00:00")), ("u", "9", "never", ["z"], 5.0, None)])
    for part in (by_days(spark, 10), late):
        part.write.mode("append").parquet(source)
        daily.to_daily(stream_folder(spark, source), path, checkpoint, "available_now").awaitTermination()
    assert daily.read_daily(spark, path).count() == 32
    newest = by_days(spark, 10).agg(F.max("event_time")).first()[0]
    assert daily.newest_event(spark, path) == newest
    # what nobody committed is not there, not even as the newest day
    by_days(spark, 1).write.parquet(f"{path}/{daily.DAY}=2031-01-01")
    assert daily.days(spark, path)[-1].year == 2031 and daily.newest_event(spark, path) == newest
    assert daily.read_daily(spark, path, newest).count() == 1


def test_no_event_with_a_time(spark, tmp_path):
    path = str(tmp_path / "daily")
    daily.write_daily(events(spark, [("u", "1", "t", ["a"], 1.0, None)]), path)
    with pytest.raises(MissingInput):
        daily.newest_event(spark, path)
