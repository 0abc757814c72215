"""Numbers of a running stream from stored rows: exact ones, and sketches within their error."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, events
from tidemark.operators.stats import dataset_summary, item_stats, user_stats
from tidemark.plans.reports import kpis
from tidemark.sources import files
from tidemark.streaming import live, sketches


def publish(spark, tmp_path, frames, tables, every=50):
    """One batch for each frame; what readers see after each of them."""
    path, checkpoint, source = (str(tmp_path / x) for x in ("live", "checkpoint", "in"))
    for frame in frames:
        frame.write.mode("append").parquet(source)
        rows = files.stream_folder(spark, source)
        live.publish_live_tables(rows, path, checkpoint, tables, "available_now", every=every).awaitTermination()
        yield path


def some(spark, start, stop):
    rows = spark.range(start, stop).select(
        F.concat(F.lit("u"), F.col("id") % 9001).alias("user_id"),
        F.concat(F.lit("i"), F.col("id") % 5003).alias("item_id"),
        F.concat(F.lit("t"), F.col("id") % 5003).alias("title"),
        F.array(F.concat(F.lit("c"), F.col("id") % 3), F.lit("all")).alias("categories"),
        F.when(F.col("id") % 17 > 0, (F.col("id") % 10 + 1) / 2.0).alias("rating"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("event_time"),
    )
    return rows


@pytest.mark.parametrize("every", [50, 2])
def test_numbers_after_every_batch(spark, tmp_path, every):
    frames = [some(spark, 0, 4_000), some(spark, 3_000, 12_000), some(spark, 11_000, 20_000)]
    seen = None
    for frame, path in zip(frames, publish(spark, tmp_path, frames, sketches.KPI_TABLES, every)):
        seen = frame if seen is None else seen.unionByName(frame)
        assert sketches.live_kpis(spark, path).collect() == kpis(item_stats(seen), user_stats(seen)).collect()
        got, exact = sketches.live_dataset_summary(spark, path).first(), dataset_summary(seen).first()
        for name in exact.asDict():
            assert got[name] == (pytest.approx(exact[name], rel=1e-9) if isinstance(exact[name], float) else exact[name])
        error = sketches.KPI_TABLES["summary"].standard_error
        about = sketches.live_estimates(spark, path).first()
        assert about.events == exact.ratings and about.num_ratings == seen.agg(F.count("rating")).first()[0]
        assert about.item_id_estimate == pytest.approx(exact.items, rel=3 * error)
        assert about.user_id_estimate == pytest.approx(exact.users, rel=3 * error)
        assert sketches.live_dataset_summary(spark, path, approximate=True).first().users == about.user_id_estimate


def test_error_of_united_sketches(spark):
    """Values spread over 20 sketches, most of them in several: the stated error holds for the union."""
    for lg_k, column in ((10, "a"), (12, "a"), (14, "a")):
        spec = sketches.LiveSketch((), (column,), lg_k)
        batches = [spec.sums(spark.range(k * 2_000, k * 2_000 + 9_000).select(F.col("id").cast("string").alias("a"), F.lit(1.0).alias("rating"), F.current_timestamp().alias("event_time"))) for k in range(20)]
        union = batches[0]
        for one in batches[1:]:
            union = union.unionByName(one)
        estimate = spec.add_up(union).select(F.hll_sketch_estimate("a_sketch")).first()[0]
        assert abs(estimate - 47_000) <= 3 * spec.standard_error * 47_000


def test_stored_rows_alone_are_read(spark, tmp_path):
    """No file of the stream's source is in the plans, and a sketch table has one row a batch."""
    frames = [some(spark, 0, 1_000), some(spark, 1_000, 2_000)]
    path = list(publish(spark, tmp_path, frames, sketches.KPI_TABLES))[-1]
    for df in (sketches.live_kpis(spark, path), sketches.live_dataset_summary(spark, path), sketches.live_estimates(spark, path)):
        assert df.inputFiles() and all(f"{tmp_path}/live/" in f for f in df.inputFiles())
    assert spark.read.parquet(f"{path}/summary/batches").count() == 2


def test_nulls_and_empty_batches(spark, tmp_path):
    none = events(spark, [(None, None, None, None, None, None)])
    first = events(spark, [("u", "i", "t", ["a"], 4.0, at("10:00:00"))])
    for number, path in enumerate(publish(spark, tmp_path, [none, first, first.limit(0)], sketches.KPI_TABLES)):
        row = sketches.live_estimates(spark, path).first()
        assert (row.item_id_estimate, row.user_id_estimate, row.num_ratings) == ((0, 0, 0) if number == 0 else (1, 1, 1))
    assert row.events == 2
    assert sketches.live_dataset_summary(spark, path).first().items == 1
