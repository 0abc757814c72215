"""Ratings and items stored in buckets, so that enrichment moves no rating.

Both tables are bucketed and sorted by (item, part). Items with more ratings than an average bucket holds are hot: they
are cut into parts, decided when the ratings are first stored, and the item's metadata is there once per part.
A bucket then holds about its share of the ratings, however uneven the items are. There can be no more hot items than
buckets, so their list is small whatever the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class BucketedRatings:
    """A folder with ``ratings``, ``items`` and ``hot`` (item_id, parts), registered as tables of the session.

    The number of buckets is fixed when the folder is first used: about 1 GB of ratings each is a good size. A
    session that opens the folder again gives the same number.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self._name = "bucketed_" + hashlib.sha1(path.encode()).hexdigest()[:16]

    def _table(self, kind: str, like: DataFrame | None = None) -> str:
        """The name of a table, registered anew where the session does not know it."""
        name = f"{self._name}_{kind}"
        if not self.spark.catalog.tableExists(name):
            schema = (like or self.spark.read.parquet(f"{self.path}/{kind}")).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (item_id, part) SORTED BY (item_id, part) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{kind}'"
            )
        return name

    def _append(self, rows: DataFrame, kind: str) -> None:
        name = self._table(kind, rows)
        # One task per bucket and so one file; without it every task would write one for each bucket.
        rows.repartition(self.buckets, "item_id", "part").write.insertInto(name)
        self.spark.catalog.refreshTable(name)

    def create(self, ratings: DataFrame, items: DataFrame) -> None:
        """Store the first ratings and the items. Counts of items are taken once, to find the hot ones."""
        counts = ratings.filter(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.count("*").alias("n"))
        average = F.lit(max(1, -(-ratings.count() // self.buckets)))
        hot = counts.filter(F.col("n") > average).select("item_id", F.least(F.ceil(F.col("n") / average), F.lit(self.buckets)).cast("int").alias("parts"))
        hot.coalesce(1).write.parquet(f"{self.path}/hot")  # not more than there are buckets
        self.append(ratings)
        parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
        self._append(items.join(F.broadcast(self._hot()), "item_id", "left").select(*items.columns, parts.alias("part")), "items")

    def append(self, ratings: DataFrame) -> None:
        """Store more ratings, dealt to the same parts; an item that got hot later stays in one bucket."""
        told = ratings.join(F.broadcast(self._hot()), "item_id", "left")
        spread = F.pmod(F.xxhash64(*[c for c, kind in ratings.dtypes if not kind.startswith("map")]), F.coalesce("parts", F.lit(1)))
        self._append(told.select(*ratings.columns, spread.cast("int").alias("part")), "ratings")

    def _hot(self) -> DataFrame:
        return self.spark.read.schema("item_id string, parts int").parquet(f"{self.path}/hot")

    def ratings(self) -> DataFrame:
        return self.spark.table(self._table("ratings")).drop("part")

    def enriched(self, *conditions: Column) -> DataFrame:
        """The ratings with their item's metadata, by a join of buckets; ``conditions`` are on the ratings."""
        rows = self.spark.table(self._table("ratings"))
        for condition in conditions:
            rows = rows.filter(condition)
        return rows.join(self.spark.table(self._table("items")), ["item_id", "part"]).drop("part")
