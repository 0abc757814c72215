"""The log a running query keeps of its batches, over restarts and repeated reports."""

import json
import os

from pyspark.sql import functions as F

from tests.helpers import at, events
from tidemark.operators import windows
from tidemark.sources import files
from tidemark.streaming import run, snapshots


def rated(spark, *times, user="u"):
    return events(spark, [(user, "1", "t", ["a", "b"], 4.0, at(t) if t else None) for t in times])


def work_off(spark, tmp_path, batch, name, delay="10 minutes"):
    batch.write.mode("append").parquet(f"{tmp_path}/in")
    listener = snapshots.SnapshotLog(spark, f"{tmp_path}/log", name)
    spark.streams.addListener(listener)
    try:
        rows = snapshots.observed(files.stream_folder(spark, f"{tmp_path}/in"))
        trends = windows.window_category_trends(rows, watermark=delay)
        query = run.to_upserts(trends, f"{tmp_path}/out", ["window_start", "window_end", "category"], f"{tmp_path}/ckpt", "available_now", name)
        query.awaitTermination()
        listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)


def test_log_over_restarts(spark, tmp_path):
    work_off(spark, tmp_path, rated(spark, "10:00:00", "10:05:00", None), "log-a")
    work_off(spark, tmp_path, rated(spark, "11:00:00"), "log-a")
    work_off(spark, tmp_path, rated(spark, "10:01:00", "11:30:00", "11:31:00"), "log-a")  # one of them is late
    log = snapshots.read_log(spark, f"{tmp_path}/log")
    full = log.filter("num_ratings > 0").orderBy("batch_id").collect()
    assert [r.num_ratings for r in full] == [3, 1, 3]
    assert [r.newest_event for r in full] == [at("10:05:00"), at("11:00:00"), at("11:31:00")]
    totals = snapshots.running_totals(log).orderBy("taken_at").collect()
    assert [(r.taken_at, r.total) for r in totals] == [(at("10:05:00"), 3), (at("11:00:00"), 4), (at("11:31:00"), 7)]
    row = snapshots.late_total(log).first()
    # five windows of the late event in each of two categories, all behind the watermark of 10:50
    assert (row.batches, row.num_ratings, row.late_rows) == (3, 7, 10)
    deltas = windows.snapshot_deltas(snapshots.running_totals(log)).collect()
    assert {r.arrivals for r in deltas} == {3, 1}
    assert [r.arrivals for r in windows.snapshot_deltas(snapshots.running_totals(log), last=1).collect()] == [3]


def test_only_the_last_batches_are_ordered(spark, tmp_path):
    os.makedirs(f"{tmp_path}/log")
    for k in range(30):
        with open(f"{tmp_path}/log/batch={k:012d}.json", "w") as f:
            json.dump({"batch_id": k, "taken_at": f"2024-01-01T10:{k:02d}:00.000Z", "num_ratings": k % 4, "newest_event": f"2024-01-01T09:{k:02d}:00", "late_rows": 0}, f)
    with open(f"{tmp_path}/log/_batch=000000000099.part", "w") as f:
        f.write('{"batch_id": 99, "num_ra')  # being written
    log = snapshots.read_log(spark, f"{tmp_path}/log")
    totals = snapshots.running_totals(log, last=4, at="taken_at").orderBy("taken_at").collect()
    kept = [k for k in range(30) if k % 4]
    assert [r.total for r in totals] == [sum(x % 4 for x in kept if x <= k) for k in kept[-4:]]
    assert [r.taken_at for r in totals] == [at(f"10:{k:02d}:00") for k in kept[-4:]]


def test_a_repeated_report_replaces_its_batch(spark, tmp_path):
    listener = snapshots.SnapshotLog(spark, f"{tmp_path}/log", "x")
    for n in (5, 7):
        listener._write(3, json.dumps({"batch_id": 3, "num_ratings": n}))
    assert [r.num_ratings for r in snapshots.read_log(spark, f"{tmp_path}/log").collect()] == [7]


def test_other_queries_are_not_logged(spark, tmp_path):
    listener = snapshots.SnapshotLog(spark, f"{tmp_path}/log", "mine")
    spark.streams.addListener(listener)
    try:
        rated(spark, "10:00:00").write.parquet(f"{tmp_path}/in")
        rows = snapshots.observed(files.stream_folder(spark, f"{tmp_path}/in"))
        query = run.to_memory(rows.groupBy().agg(F.count("*")), "theirs", trigger="available_now", checkpoint=f"{tmp_path}/ckpt")
        query.awaitTermination()
        listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    assert not os.path.exists(f"{tmp_path}/log")
