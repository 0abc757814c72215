"""The event model shared by every source, operator and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("rating", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

TREND_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("rating_count", T.LongType()),
    ]
)

# Fixed values of the data formats: names and markers as they stand in the CSV files, in the
# JSON messages and in the Parquet folders written before.
ITEM_CSV_COLUMNS = ["movieId", "title", "genres"]
RATING_CSV_COLUMNS = ["userId", "movieId", "rating", "timestamp"]
WIRE_USER, WIRE_ITEM, WIRE_RATING, WIRE_TIME = "userId", "movie", "rating", "timestamp"
WIRE_ITEM_ID, WIRE_TITLE, WIRE_CATEGORIES = "movieId", "title", "genres"
NO_CATEGORIES = "(no genres listed)"
CATEGORY_SEPARATOR = "|"
STORED_NAMES = {"userId": "user_id", "movieId": "item_id", "genres": "categories", "genre": "category"}


def csv_schema(names: list[str]) -> T.StructType:
    """All CSV columns are read as strings; casts happen later and never fail the scan."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def neutral_names(df: DataFrame) -> DataFrame:
    """Map the stored column names to the names used in this library."""
    return df.withColumnsRenamed({old: new for old, new in STORED_NAMES.items() if old in df.columns})
