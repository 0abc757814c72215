"""Decoding and encoding of rating events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import (
    WIRE_CATEGORIES,
    WIRE_ITEM,
    WIRE_ITEM_ID,
    WIRE_RATING,
    WIRE_TIME,
    WIRE_TITLE,
    WIRE_USER,
)

EVENT_COLUMNS = ("user_id", "item_id", "title", "categories", "rating", "event_time")
_ITEM_FIELDS = {"item_id": WIRE_ITEM_ID, "title": WIRE_TITLE, "categories": WIRE_CATEGORIES}


def wire_schema(columns: Sequence[str] = EVENT_COLUMNS + ("source_time",)) -> T.StructType:
    """The JSON schema holding only the fields those columns need.

    The JSON reader skips a field that is not in its schema, and the optimizer does not narrow the
    schema itself when several fields of one struct are used.
    """
    schema = T.StructType()
    if "user_id" in columns:
        schema.add(WIRE_USER, T.StringType())
    inner = [name for name in _ITEM_FIELDS if name in columns]
    if inner:
        item = T.StructType()
        for name in inner:
            item.add(_ITEM_FIELDS[name], T.ArrayType(T.StringType()) if name == "categories" else T.StringType())
        schema.add(WIRE_ITEM, item)
    if "rating" in columns:
        schema.add(WIRE_RATING, T.StringType())
    if "source_time" in columns:
        schema.add(WIRE_TIME, T.StringType())
    return schema


def parse_events(
    raw: DataFrame,
    event_time: str = "arrival",
    columns: Sequence[str] = EVENT_COLUMNS,
    drop_malformed: bool = False,
) -> DataFrame:
    """Events of a ``value`` column holding JSON.

    ``event_time`` is the moment of processing (``arrival``) or the time in the message
    (``source``). ``columns`` may also name ``source_time``, the epoch seconds of the message. Text
    that is not JSON gives a row of NULLs, a number that cannot be read gives NULL;
    ``drop_malformed`` leaves out the former (see ``dead_letters``).
    """
    if event_time not in ("arrival", "source"):
        raise ValueError(f"unknown event time: {event_time}")
    needed = set(columns)
    if event_time == "source" and "event_time" in needed:
        needed.add("source_time")
    raw = raw.filter(~_malformed()) if drop_malformed else raw
    decoded = raw.select(F.from_json(F.col("value").cast("string"), wire_schema(tuple(needed))).alias("r"))
    stamp = F.col(f"r.{WIRE_TIME}").try_cast("bigint") if "source_time" in needed else None
    expressions: dict[str, Column] = {
        "user_id": F.col(f"r.{WIRE_USER}"),
        "rating": F.col(f"r.{WIRE_RATING}").try_cast("double"),
        "source_time": stamp,
        "event_time": F.current_timestamp() if event_time == "arrival" else F.timestamp_seconds(stamp),
    } | {name: F.col(f"r.{WIRE_ITEM}.{field}") for name, field in _ITEM_FIELDS.items()}
    return decoded.select(*[expressions[name].alias(name) for name in columns])


def _malformed() -> Column:
    return F.json_object_keys(F.col("value").cast("string")).isNull()


def dead_letters(raw: DataFrame) -> DataFrame:
    """The messages that hold no JSON object."""
    return raw.filter(_malformed())


def encode_events(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON message per row, every leaf a string, next to the columns to ``keep``.

    The message time is ``source_time`` where the rows have it, else the epoch second of
    ``event_time``.
    """
    if "source_time" in df.columns:
        stamp = F.col("source_time").cast("string")
    else:
        stamp = F.unix_seconds(F.col("event_time").cast("timestamp")).cast("string")
    item = F.struct(*[F.col(name).alias(field) for name, field in _ITEM_FIELDS.items()])
    message = F.struct(
        F.col("user_id").alias(WIRE_USER),
        item.alias(WIRE_ITEM),
        F.col("rating").cast("string").alias(WIRE_RATING),
        stamp.alias(WIRE_TIME),
    )
    return df.select(*keep, F.to_json(message, {"ignoreNullFields": "false"}).alias("value"))


def sample_topic(messages: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """A few messages of a topic, decoded: a check that events arrive and can be read.

    Without an order the scan stops as soon as it has them; with one (say ``partition`` and
    ``offset``) they are the first of the whole topic.
    """
    # coalesce keeps the decoding above the limit; below it, the whole topic would be sorted
    first = messages.orderBy(*order_by).limit(n).coalesce(1) if order_by else messages.limit(n)
    return parse_events(first, columns=("user_id", "title", "rating", "categories"))


def explode_categories(df: DataFrame, drop_blank: bool = False) -> DataFrame:
    """One row per event and category; events without categories leave no row."""
    others = [c for c in df.columns if c != "categories"]
    rows = df.select(F.explode("categories").alias("category"), *others)
    return rows.filter(F.col("category").isNotNull() & (F.col("category") != "")) if drop_blank else rows
