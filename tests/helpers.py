"""Literal rows for the tests."""

from datetime import datetime

from tidemark.schema import EVENT_SCHEMA


def at(text):
    return datetime.fromisoformat(f"2024-01-01 {text}")


def events(spark, rows):
    """Rows of (user, item, title, categories, rating, time)."""
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def rated(spark, *ratings, time="10:00:00"):
    """One event per (item, rating)."""
    return events(spark, [(f"u{i}", item, f"title {item}", ["a"], r, at(time)) for i, (item, r) in enumerate(ratings)])


def as_set(df, *columns):
    return {tuple(row[c] for c in columns) for row in df.collect()}
