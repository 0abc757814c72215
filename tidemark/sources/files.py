"""CSV and Parquet sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import flatten_window, parse_category_list
from tidemark.schema import (
    EVENT_SCHEMA,
    ITEM_CSV_COLUMNS,
    RATING_CSV_COLUMNS,
    TREND_SCHEMA,
    csv_schema,
    neutral_names,
)


class MissingInput(Exception):
    """A folder or file the job needs is absent or holds no data file."""


def has_input(spark: SparkSession, path: str, suffix: str = "") -> bool:
    """Whether the path (or pattern) names a file, or a folder holding one with that suffix at any depth.

    Asks the file system that owns the path, and stops at the first match.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.globStatus(pattern) or []:
        if status.isFile():
            return True
        found = system.listFiles(status.getPath(), True)
        while found.hasNext():
            entry = found.next().getPath()
            hidden = entry.getName().startswith(("_", ".")) or "/_spark_metadata/" in entry.toString()
            if not hidden and entry.getName().endswith(suffix):
                return True
    return False


def is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return [status.getPath().toString() for status in found]


def require_input(spark: SparkSession, path: str, suffix: str = "") -> str:
    if not has_input(spark, path, suffix):
        raise MissingInput(f"no input under {path}")
    return path


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows, for inputs that may be absent."""
    return spark.createDataFrame([], schema)


def _read_csv(spark: SparkSession, path: str, names: list[str], multi_line: bool) -> DataFrame:
    """CSV columns as text, as the file has them: an empty one is the empty text.

    ``multi_line`` reads line breaks inside quotes; such files cannot be split between tasks.
    """
    require_input(spark, path)
    rows = spark.read.schema(csv_schema(names)).csv(
        path, header=True, escape='"', encoding="UTF-8", multiLine=multi_line
    )
    return rows.withColumns({name: F.coalesce(name, F.lit("")) for name in names})


def read_items(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Item metadata: one row per id, the last row of the file wins; an empty list is one blank category.

    ``monotonically_increasing_id`` grows with file position (splits of one file are scanned in
    order), so the latest row is the one with the largest value. ``max_by`` combines before the
    shuffle, so many copies of one id cost one row per task.
    """
    rows = _read_csv(spark, path, ITEM_CSV_COLUMNS, multi_line)
    item, title, categories = (F.col(name) for name in ITEM_CSV_COLUMNS)
    # Files are packed into partitions by size, not by position; the block offset keeps file order.
    position = F.struct(F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id())
    return (
        rows.select(item.alias("item_id"), title.alias("title"), categories.alias("list"), position.alias("at"))
        .groupBy("item_id")
        .agg(F.max_by(F.struct("title", "list"), "at").alias("last"))
        .select("item_id", F.col("last.title").alias("title"), parse_category_list(F.col("last.list")).alias("categories"))
    )


def read_ratings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Ratings with every value as the file has it; ``source_time`` holds epoch seconds."""
    user, item, rating, time = (F.col(name) for name in RATING_CSV_COLUMNS)
    rows = _read_csv(spark, path, RATING_CSV_COLUMNS, multi_line)
    return rows.select(user.alias("user_id"), item.alias("item_id"), rating.alias("rating"), time.alias("source_time"))


def read_sink(
    spark: SparkSession,
    path: str,
    committed_only: bool = True,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A Parquet folder written by a stream.

    ``committed_only`` reads what the sink's commit log lists, so files of failed attempts never
    count. A folder that was moved has stale absolute paths in its log: read it with
    ``committed_only=False``, which takes every Parquet file below the folder as it is, partition
    columns included. ``path`` may be a pattern; each folder it names is read by its own log.
    """
    require_input(spark, path, ".parquet")
    folders = matching(spark, path)
    if len(folders) > 1:
        return reduce(DataFrame.unionByName, (read_sink(spark, f, committed_only, schema) for f in folders))
    reader = spark.read if schema is None else spark.read.schema(schema)
    if committed_only:
        return neutral_names(reader.parquet(folders[0]))
    # Names with _ or . in front are not data: the log, and files still being written.
    return neutral_names(reader.option("basePath", folders[0]).parquet(f"{folders[0]}/[!_.]*"))


def read_sinks(spark: SparkSession, paths: Sequence[str], committed_only: bool = True) -> DataFrame:
    """Several folders as one table, each read by its own commit log."""
    parts = [read_sink(spark, path, committed_only) for path in paths]
    return reduce(DataFrame.unionByName, parts)


def read_raw(spark: SparkSession, path: str, committed_only: bool = True) -> DataFrame:
    """The stored events; absent data is an error."""
    return read_sink(spark, path, committed_only)


def read_trends(spark: SparkSession, path: str, committed_only: bool = True) -> DataFrame:
    """The stored window rows; no rows where no window has been written yet."""
    if not has_input(spark, path, ".parquet"):
        return empty(spark, TREND_SCHEMA)
    trends = read_sink(spark, path, committed_only)
    return flatten_window(trends) if "window" in trends.columns else trends


def stream_folder(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENT_SCHEMA,
    files: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_text(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of JSON lines as a stream with the ``value`` column of a topic."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
