"""Headline numbers of a running stream from what its batches have stored, distinct counts among them.

A batch stores one row (or one per key): sums, extremes, and a sketch of the values of each counted column. Sketches
of different batches are united, so an estimate never looks at an event again, and a row has a fixed size
however many values there are. Exact numbers come from the live tables, which have a row per key and batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import round3
from tidemark.operators.stats import trend_category_weighted, trend_summary
from tidemark.operators.windows import SIZE, SLIDE
from tidemark.plans.reports import compared_categories, kpis
from tidemark.sources.events import explode_categories
from tidemark.streaming.live import LIVE_TABLES, LiveTable, live_table
from tidemark.streaming.tables import stored_rows

LG_K = 12  # 2^12 registers, 2 to 4 KB a sketch


@dataclass(frozen=True)
class LiveSketch:
    """Sums and sketches, for the stream as a whole or per key; a table of ``publish_live_tables``.

    The standard error of a united sketch is ``1.04 / sqrt(2 ** lg_k)``: 1.6 % for 12. Ratings come in halves, so
    their sums and those of their squares are exact in any order. NULLs are not counted as values.
    """

    keys: tuple[str, ...] = ()
    counted: tuple[str, ...] = ("item_id", "user_id")
    lg_k: int = LG_K

    def sums(self, batch: DataFrame) -> DataFrame:
        rows = explode_categories(batch) if "category" in self.keys else batch
        return rows.groupBy(*self.keys).agg(
            F.count("*").alias("events"),
            F.count("rating").alias("n"),
            F.sum("rating").alias("total"),
            F.sum(F.col("rating") * F.col("rating")).alias("squares"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
            *[F.hll_sketch_agg(c, self.lg_k).alias(f"{c}_sketch") for c in self.counted],
        )

    def add_up(self, sums: DataFrame) -> DataFrame:
        return sums.groupBy(*self.keys).agg(
            *[F.sum(c).alias(c) for c in ("events", "n", "total", "squares")],
            F.min("first_event").alias("first_event"),
            F.max("last_event").alias("last_event"),
            *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in self.counted],
        )

    @property
    def columns(self) -> Sequence[str]:
        return self.keys

    @property
    def standard_error(self) -> float:
        return 1.04 / 2 ** (self.lg_k / 2)


SUMMARY = "summary"
KPI_TABLES = {name: LIVE_TABLES[name] for name in ("item_stats", "user_stats")} | {SUMMARY: LiveSketch()}


def live_estimates(spark: SparkSession, path: str, table: str = SUMMARY, spec: LiveSketch = KPI_TABLES[SUMMARY]) -> DataFrame:
    """Events, ratings, their average, and estimated numbers of distinct values, from one stored row per batch."""
    rows = spec.add_up(stored_rows(spark, f"{path}/{table}"))
    return rows.select(
        *spec.keys,
        "events",
        F.col("n").alias("num_ratings"),
        round3(F.try_divide("total", "n")).alias("avg_rating"),
        *[F.hll_sketch_estimate(f"{c}_sketch").alias(f"{c}_estimate") for c in spec.counted],
    )


def live_kpis(spark: SparkSession, path: str, tables: dict[str, LiveTable | LiveSketch] = KPI_TABLES) -> DataFrame:
    """The headline numbers, exact, from the stored item and user sums."""
    return kpis(live_table(spark, path, "item_stats", tables), live_table(spark, path, "user_stats", tables))


def live_dataset_summary(
    spark: SparkSession, path: str, tables: dict[str, LiveTable | LiveSketch] = KPI_TABLES, approximate: bool = False
) -> DataFrame:
    """Volume, distinct items and users, mean, sample deviation and time span from stored rows alone.

    Distinct counts are those of the stored keys, or with ``approximate`` of the sketches.
    """

    def distinct(column: str, table: str):
        if approximate:
            return F.hll_sketch_estimate(f"{column}_sketch")
        return stored_rows(spark, f"{path}/{table}").select(column).distinct().agg(F.count(column)).scalar()

    mean = F.try_divide("total", "n")
    variance = F.try_divide(F.col("squares") - F.col("total") * mean, F.col("n") - 1)
    return tables[SUMMARY].add_up(stored_rows(spark, f"{path}/{SUMMARY}")).select(
        F.col("events").alias("ratings"),
        distinct("item_id", "item_stats").alias("items"),
        distinct("user_id", "user_stats").alias("users"),
        mean.alias("avg_rating"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std_rating"),
        "first_event",
        "last_event",
    )


AGREEMENT_TABLES = {"category_stats": LIVE_TABLES["category_stats"], "window_category_stats": LiveTable(("category",), (SIZE, SLIDE))}


def live_comparison(spark: SparkSession, path: str, tables: dict[str, LiveTable] = AGREEMENT_TABLES) -> DataFrame:
    """Per category: what all ratings give and what the windows add up to, both from stored sums.

    The sums of a category add up over batches on either side, so nothing is read twice and no event is kept:
    correlation and differences (``agreement``) are taken over the few rows of this table.
    """
    sums = tables["category_stats"].add_up(stored_rows(spark, f"{path}/category_stats"))
    named = sums.filter(F.col("category").isNotNull() & (F.col("category") != ""))
    batch = named.select("category", F.try_divide("total", "n").alias("batch_avg"), F.col("n").alias("batch_count"))
    trends = live_table(spark, path, "window_category_stats", tables).withColumnRenamed("num_ratings", "rating_count")
    return compared_categories(batch, trend_category_weighted(trends))


def live_trend_summary(spark: SparkSession, path: str, table: str, tables: dict[str, LiveTable]) -> DataFrame:
    """Window rows, distinct windows and their span, of a stored window table."""
    return trend_summary(live_table(spark, path, table, tables))
