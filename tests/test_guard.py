"""A checkpoint is refused to a query with another state; what is held and evicted can be looked at."""

import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set, at, events
from tidemark.operators import windows
from tidemark.sources import files
from tidemark.streaming import guard, run


def stream(spark, tmp_path, *times):
    rows = [("u", "1", "t", ["a"], 4.0, at(t)) for t in times]
    if rows:
        events(spark, rows).write.mode("append").parquet(f"{tmp_path}/in")
    return files.stream_folder(spark, f"{tmp_path}/in")


def go(spark, tmp_path, trends, mode="append"):
    ckpt = f"{tmp_path}/ckpt"
    run.to_parquet(guard.guarded(trends, ckpt, mode), f"{tmp_path}/out", ckpt, "available_now").awaitTermination()


def trends(rows, size="10 minutes", slide="2 minutes", watermark="30 seconds"):
    return windows.window_category_trends(rows, size, slide, watermark)


def test_the_same_query_goes_on(spark, tmp_path):
    go(spark, tmp_path, trends(stream(spark, tmp_path, "10:00:00")))
    # another filter, another source option, another session's numbers: the state is the same
    later = stream(spark, tmp_path, "10:30:00", "10:31:00").filter(F.col("rating") > 0)
    go(spark, tmp_path, trends(later))
    assert files.read_trends(spark, f"{tmp_path}/out").count() == 5


CHANGES = {
    "another size": lambda rows: trends(rows, "20 minutes"),
    "another delay": lambda rows: trends(rows, watermark="2 minutes"),
    "another key": lambda rows: windows.window_item_trends(rows, watermark="30 seconds"),
    "another type": lambda rows: trends(rows.withColumn("rating", F.col("rating").cast("float"))),
    "another aggregate": lambda rows: windows.with_watermark(rows, "30 seconds").groupBy(F.window("event_time", "10 minutes")).agg(F.max("rating")),
    "a duplicate filter": lambda rows: trends(rows.withWatermark("event_time", "1 hour").dropDuplicates(["user_id", "event_time"])),
}


@pytest.mark.parametrize("change", list(CHANGES))
def test_a_changed_query_is_refused(spark, tmp_path, change):
    rows = stream(spark, tmp_path, "10:00:00")
    guard.guarded(trends(rows), f"{tmp_path}/ckpt")
    with pytest.raises(guard.ChangedPlan, match="(?s)holds the state of another query.*\n[+-]"):
        guard.guarded(CHANGES[change](rows), f"{tmp_path}/ckpt")
    with pytest.raises(guard.ChangedPlan, match="mode update"):
        guard.guarded(trends(rows), f"{tmp_path}/ckpt", "update")
    assert guard.guarded(trends(rows), f"{tmp_path}/ckpt").isStreaming
    assert not os.path.exists(f"{tmp_path}/ckpt")  # the guard lies beside it


def test_stateless_streams_have_only_a_mode(spark, tmp_path):
    rows = stream(spark, tmp_path, "10:00:00")
    assert guard.state_plan(rows.filter("rating > 1").select("user_id"), "append") == ["mode append"]


def test_held_and_evicted_windows(spark, tmp_path):
    go(spark, tmp_path, trends(stream(spark, tmp_path, "10:00:00", "10:05:00")))
    held = lambda **spec: as_set(guard.held_windows(spark, f"{tmp_path}/ckpt", ["category"], **spec), "window_end", "category")
    first = held()
    go(spark, tmp_path, trends(stream(spark, tmp_path, "10:20:00")))
    closed = as_set(files.read_trends(spark, f"{tmp_path}/out"), "window_end", "category")
    watermark = at("10:19:30")
    assert all(end <= watermark for end, _ in closed) and all(end > watermark for end, _ in held())
    assert len(closed | held()) == len(closed) + len(held()) and {e for e in first if e[0] <= watermark} <= closed
    assert held(batch=0) >= first - closed
    assert set(guard.state_rows(spark, f"{tmp_path}/ckpt").columns) >= {"key", "value", "partition_id"}
