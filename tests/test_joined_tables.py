"""Tables of many rows that lines are joined with: no line is sorted for it, and hot keys are split."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.test_oracles import rows_of
from tidemark.operators import joins
from tidemark.plans import reports
from tidemark.plans.oracles import ORACLES
from tidemark.plans.registry import QUERIES
from tidemark.sources.tables import line_ratings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def many(monkeypatch):
    """15,000 orders and 2,000 parts count as many rows."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1_000)


@pytest.mark.parametrize("name", ["parse_events", "sample_topic", "best_category", "bounded_collect", "category_report"])
def test_lines_are_joined_by_hash_and_match_sql(spark, sf_dir, many, monkeypatch, name):
    seen, collect = [], reports.collect_bounded
    monkeypatch.setattr(reports, "collect_bounded", lambda df, n: seen.append(df) or collect(df, n))
    result = QUERIES[name](spark, sf_dir)
    text = plan((seen or [result])[0])
    assert text.count("ShuffledHashJoin") == 2 and text.count("BuildRight") == 2
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    with duckdb.connect() as duck:
        for table in ("lineitem", "orders", "part"):
            duck.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
        cursor = duck.execute(ORACLES[name])
        assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall()) and got[1]


def test_a_table_with_more_rows_than_the_lines_is_not_hashed(spark, many):
    table = spark.range(3_000)
    assert "SortMergeJoin" in plan(spark.range(5_999).join(joins.merged(table, spark.range(5_999)), "id"))
    assert "ShuffledHashJoin" in plan(spark.range(6_000).join(joins.merged(table, spark.range(6_000)), "id"))
    assert "BroadcastHashJoin" in plan(spark.range(6_000).join(joins.merged(spark.range(900), spark.range(6_000)), "id"))


def test_hot_parts_and_orders_are_split_at_run_time(spark, many, tmp_path):
    """Half of the lines are of one part, a third of one order; some have none, and one part is there twice."""
    numbers = spark.range(40_000)
    numbers.select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 4_999).otherwise(7).alias("l_orderkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"),
        F.when(F.col("id") % 2 > 0, F.col("id") % 2_111).when(F.col("id") % 100 > 0, 3).alias("l_partkey"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5_000).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    parts = spark.range(2_000).unionByName(spark.range(5, 6))
    parts.select(F.col("id").alias("p_partkey"), F.concat(F.lit("blue "), F.col("id")).alias("p_name")).write.parquet(f"{tmp_path}/part.parquet")
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        rows = line_ratings(spark, str(tmp_path))
        got = rows.groupBy("item_id", "title").agg(F.count("*").alias("n"), F.sum("rating"))
        found = {(r[0], r[1]): (r[2], r[3]) for r in got.collect()}
        text = plan(got)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert text.count("ShuffledHashJoin(skew=true)") >= 2, text
    assert "SortMergeJoin" not in text
    with duckdb.connect() as duck:
        for table in ("lineitem", "orders", "part"):
            duck.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
        expected = duck.execute("""
select p_partkey::varchar, p_name, count(*), sum(0.5 + 0.5 * ((l_quantity::int - 1) % 10))::double
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by all""").fetchall()
    assert found == {(a, b): (c, d) for a, b, c, d in expected}
    assert found[("3", "blue 3")][0] > 19_000 and len(found) == 2_000
