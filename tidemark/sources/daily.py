"""Events stored by day, read from the newest day back.

The folders are named by day, so the days there are come from listing names, and a question about the newest
windows opens the few folders that can hold them. Only what the sink has committed is read.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import seconds
from tidemark.operators.windows import SIZE, SLIDE
from tidemark.sources.files import MissingInput, read_sink
from tidemark.streaming.run import to_parquet

DAY = "event_day"


def by_day(events: DataFrame) -> DataFrame:
    """Events with the day (UTC) they belong to; those without a time have none."""
    return events.withColumn(DAY, F.to_date("event_time"))


def to_daily(events: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds", name: str | None = None) -> StreamingQuery:
    """Append a stream of events to folders by day."""
    return to_parquet(by_day(events), path, checkpoint, trigger, [DAY], name)


def write_daily(events: DataFrame, path: str) -> None:
    """Append a table of events to folders by day, each day's rows together first, so a day has few files."""
    rows = by_day(events)
    rows.repartition(DAY, F.pmod(F.xxhash64(*[c for c in events.columns if c != "categories"]), F.lit(8))).write.mode("append").partitionBy(DAY).parquet(path)


def days(spark: SparkSession, path: str) -> list[date]:
    """The days there are folders of, oldest first: names only, no file is opened."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DAY}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = (status.getPath().getName().split("=")[1] for status in found)
    return sorted(date.fromisoformat(n) for n in names if n[:1].isdigit())


def read_daily(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The committed events, from a time on; folders of earlier days are not opened."""
    rows = read_sink(spark, path)
    if since is not None:
        rows = rows.filter((F.col(DAY) >= F.lit(since.date())) & (F.col("event_time") >= F.lit(since)))
    return rows.drop(DAY)


def newest_event(spark: SparkSession, path: str) -> datetime:
    """The time of the newest event: of the last day's folder, or the day before where nothing in it is committed."""
    rows = read_sink(spark, path)
    for day in reversed(days(spark, path)):
        newest = rows.filter(F.col(DAY) == F.lit(day)).agg(F.max("event_time")).first()[0]
        if newest is not None:
            return newest
    raise MissingInput(f"no event with a time under {path}")


def recent_daily(spark: SparkSession, path: str, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """The events of the two newest of several overlapping windows; the history's folders stay closed."""
    reach = seconds(size) + 2 * seconds(slide)
    return read_daily(spark, path, newest_event(spark, path) - timedelta(seconds=reach))
