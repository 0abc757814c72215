"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, events
from tidemark.operators import stats, topk, windows
from tidemark.operators.joins import enrich
from tidemark.schema import EVENT_SCHEMA
from tidemark.sources import events as wire

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "events")
    events(spark, [("u", "1", "t", ["a"], 4.0, at("10:00:00"))]).write.parquet(path)
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def read_columns(text):
    return [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<([^\n]*)>", text)]


@pytest.mark.parametrize(
    "operator,columns",
    [
        (stats.category_stats, {"categories", "rating"}),
        (stats.user_stats, {"user_id", "rating"}),
        (stats.item_stats, {"item_id", "title", "rating"}),
        (windows.window_category_trends, {"event_time", "categories", "rating"}),
        (windows.event_rate, {"event_time"}),
    ],
)
def test_scans_read_only_what_is_needed(stored, operator, columns):
    text = plan(operator(stored))
    assert read_columns(text) == [columns]
    assert "partial_" in text


@pytest.mark.parametrize("operator", [stats.category_stats, stats.item_stats, stats.user_stats, stats.category_volume])
def test_one_shuffle(stored, operator):
    assert plan(operator(stored)).count("Exchange") == 1


def test_sliding_windows_shuffle_panes_not_events(stored):
    text = plan(windows.window_category_trends(stored))
    assert "Expand" not in text and text.count("Exchange") == 2
    assert "Expand" in plan(windows.window_category_trends(stored, "9 minutes", "2 minutes"))


def test_time_filters_reach_the_scan(stored):
    trends = windows.window_category_trends(stored)
    recent = plan(windows.interval_arrivals(stored))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(event_time", recent)
    assert read_columns(plan(trends.filter(F.col("category") == "a")))[0] == {"event_time", "categories", "rating"}


def test_json_is_decoded_once(stored):
    raw = stored.select(F.col("title").alias("value"))
    assert plan(wire.parse_events(raw)).count("from_json") == 1


def test_a_hot_item_is_split_at_run_time(spark, tmp_path):
    """Half of all ratings belong to one item, and the item table is too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ratings = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("i"), F.col("id") % 5000)).alias("item_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("user_id"),
        )
        path = str(tmp_path / "items")
        ratings.select("item_id").distinct().withColumn("title", F.upper("item_id")).write.parquet(path)
        items = spark.read.parquet(path)
        joined = enrich(ratings, items)
        rows = joined.collect()
        assert len(rows) == 200_000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_top_lists_are_not_sorted_globally(stored):
    for df in (
        topk.top_items(stats.item_stats(stored), 5),
        topk.top_categories(stats.category_stats(stored), 5),
        wire.sample_topic(wire.encode_events(stored, keep=["item_id"]), order_by=["item_id"]),
    ):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_convergence_shuffles_window_rows_once(spark, stored, tmp_path):
    path = str(tmp_path / "trends")
    windows.window_category_trends(stored).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(windows.convergence(spark.read.parquet(path)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)
    keys = [re.sub(r"#\d+L?", "", s) for s in shuffles]
    # the window rows, the block sums, their order per category, and the small side of the join
    assert sorted(keys) == ["category", "category, block", "category, block", "category, block"]


def scans(df):
    """How often each place is read by a plan, without what reuse leaves out."""
    places = re.findall(r"Location: InMemoryFileIndex[^\[]*\[([^\],]*)", df._jdf.queryExecution().executedPlan().toString())
    return {p: places.count(p) for p in places}


@pytest.mark.parametrize("name", ["kpis", "dataset_summary", "dataset_report", "batch_vs_stream_summary", "baseline_summary"])
def test_reports_read_no_table_again_and_again(spark, sf_dir, name):
    from tidemark.plans.registry import QUERIES

    found = scans(QUERIES[name](spark, sf_dir))
    base = {p: n for p, n in found.items() if sf_dir in p}
    assert found and max(found.values(), default=0) <= 6 and max(base.values(), default=0) <= 2, found


def test_a_table_of_many_rows_in_small_files_is_not_copied_to_every_task(spark, sf_dir, tmp_path):
    """The parts are 150,000 rows of few names: less than a megabyte of files, and Spark's check would broadcast them."""
    from tidemark.sources.tables import line_ratings, part_items

    parts = spark.range(150_000).select(F.col("id").alias("p_partkey"), F.concat(F.lit("blue steel "), F.col("id") % 7).alias("p_name"))
    parts.write.parquet(f"{tmp_path}/part.parquet")
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(1_000).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = line_ratings(spark, str(tmp_path))
    assert plan(rows).count("SortMergeJoin") == 1 and plan(rows).count("BroadcastHashJoin") == 1  # parts; orders are few
    salted = enrich(rows.select("item_id", "user_id"), part_items(spark, str(tmp_path)), salts=4)
    assert "SortMergeJoin [item_id" in plan(salted) and rows.count() == salted.count()


@pytest.mark.parametrize("name", ["baseline_latest_comparison", "baseline_category_comparison", "baseline_item_comparison"])
def test_lines_are_joined_with_their_orders_once(spark, sf_dir, name):
    """Windows, training part, hold-out part and observed ratings read stored rows, not the lines once more each."""
    from tidemark.plans.registry import QUERIES

    found = scans(QUERIES[name](spark, sf_dir))
    assert found and not [p for p in found if p.endswith(("lineitem.parquet", "orders.parquet"))], found
