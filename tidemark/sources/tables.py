"""Rating events derived from the sales and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import enrich, merged
from tidemark.sources.files import is_folder, stream_folder

NO_LINE = -(1 << 31) - 1  # stands for a line without a number; no integer


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_table(spark: SparkSession, sf_dir: str, name: str, larger: str | None = None) -> DataFrame:
    """A table that others (say, the rows of ``larger``) are joined with; one of many rows is not copied to every task."""
    return merged(table(spark, sf_dir, name), table(spark, sf_dir, larger) if larger else None)


def _half_stars(step: Column) -> Column:
    return F.lit(0.5) + F.lit(0.5) * F.pmod(step, F.lit(10))


def _rate_events(events: DataFrame) -> DataFrame:
    number = F.get_json_object("props", "$.k")
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        number.alias("item_id"),
        F.concat(F.lit("item "), number).alias("title"),
        F.array("event_type", F.concat(F.lit("k"), number.cast("int") % 4)).alias("categories"),
        _half_stars(F.round(F.col("value") * 100).cast("bigint")).alias("rating"),
        F.col("ts").alias("event_time"),
    )


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table read as ratings."""
    return _rate_events(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream; event time becomes a zoned timestamp, as watermarks require."""
    schema, path = table(spark, sf_dir, "events").schema, f"{sf_dir}/events.parquet"
    # A stream reads folders: a table that is one file is picked out of the folder it lies in.
    source = (path, "*.parquet") if is_folder(spark, path) else (sf_dir, "events.parquet")
    rows = _rate_events(stream_folder(spark, source[0], schema, source[1], files_per_batch))
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp"))


def _with_customers(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    orders = joined_table(spark, sf_dir, "orders", "lineitem").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as bare ratings: customer and part as numbers, rating and time."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    return _with_customers(spark, sf_dir, lines).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        _half_stars(F.col("l_quantity").cast("int") - 1).alias("rating"),
        F.col("l_shipdate").alias("event_time"),
        "l_orderkey",
        "l_linenumber",
    )


def packed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``line_ids`` for moving them all: the line's number and the step of its rating in one column."""
    number = F.coalesce(F.col("l_linenumber").cast("bigint"), F.lit(NO_LINE))
    step = F.coalesce(F.pmod(F.col("l_quantity").cast("int") - 1, F.lit(10)) + 1, F.lit(0))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_shipdate", (number * 16 + step).alias("line")
    )
    return _with_customers(spark, sf_dir, lines).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_shipdate").alias("event_time"),
        "l_orderkey",
        "line",
    )


def unpacked(lines: DataFrame, *also: str) -> DataFrame:
    """The columns of ``line_ids`` from rows of ``packed_lines``, and others that were added to them."""
    number, step = F.shiftright("line", 4), F.col("line").bitwiseAND(F.lit(15))
    return lines.select(
        "user_id",
        "item_id",
        F.when(step > 0, _half_stars(step - 1)).alias("rating"),
        "event_time",
        "l_orderkey",
        F.when(number != NO_LINE, number.cast("int")).alias("l_linenumber"),
        *also,
    )


def named(rows: DataFrame) -> DataFrame:
    """Rows of ``line_ids`` with their ids as text."""
    return rows.withColumns({c: F.col(c).cast("string") for c in ("user_id", "item_id") if c in rows.columns})


def line_ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as bare ratings: customer, part, rating and time."""
    return named(line_ids(spark, sf_dir))


def part_items(spark: SparkSession, sf_dir: str, larger: str | None = None) -> DataFrame:
    """Parts as item metadata (for joins with the rows of ``larger``); the words of the name are the categories."""
    return joined_table(spark, sf_dir, "part", larger).select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("title"),
        F.split("p_name", " ").alias("categories"),
    )


def line_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the metadata of their part."""
    return enrich(line_ratings_raw(spark, sf_dir), part_items(spark, sf_dir, "lineitem"))
