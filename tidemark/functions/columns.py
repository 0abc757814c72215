"""Column expressions. All of them are built-in functions and stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import CATEGORY_SEPARATOR, NO_CATEGORIES

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def seconds(duration: str) -> int | float:
    """Length of a duration such as ``10 minutes`` or ``1 hour 30 minutes`` in seconds."""
    words = duration.lower().removeprefix("interval ").split()
    units = [unit.rstrip("s") for unit in words[1::2]]
    if not words or len(words) % 2 or not set(units) <= set(_UNIT_MICROS):
        raise ValueError(f"not a duration of a fixed length: {duration}")
    micros = sum(int(amount) * _UNIT_MICROS[unit] for amount, unit in zip(words[::2], units, strict=True))
    return micros // 1_000_000 if micros % 1_000_000 == 0 else micros / 1_000_000


def in_panes(size: str, slide: str) -> bool:
    """Whether windows of that size are made up of whole slides of whole seconds."""
    length, step = seconds(size), seconds(slide)
    return isinstance(length, int) and isinstance(step, int) and length % step == 0


def interval(length: int) -> Column:
    """A day-time interval of ``length`` seconds."""
    return F.expr(f"INTERVAL '{length}' SECOND")


def round3(value: Column) -> Column:
    """Half-up rounding to three decimals, the precision of every published average."""
    return F.round(value, 3)


def milli(value: Column) -> Column:
    """A three-decimal average as an exact integer number of thousandths."""
    return F.round(value * 1000).cast("bigint")


def weighted_mean(average: Column, count: Column) -> Column:
    """Aggregate: count-weighted mean of three-decimal averages.

    Summed as integers, so the result does not depend on the order in which partitions arrive.
    """
    return F.try_divide(F.sum(milli(average) * count), F.sum(count)) / 1000


def parse_category_list(text: Column) -> Column:
    """Category list of a metadata row; the marker for "none" becomes an empty array."""
    none = F.array().cast("array<string>")
    return F.when(text == NO_CATEGORIES, none).otherwise(F.split(text, re.escape(CATEGORY_SEPARATOR)))


def clock(time: Column, with_seconds: bool = True) -> Column:
    return F.date_format(time, "HH:mm:ss" if with_seconds else "HH:mm")


def wrap_label(text: Column, width: int = 35, separator: str = "<br>") -> Column:
    """Break text longer than ``width`` at the last blank before it, or hard at ``width``.

    One regular expression does the whole split: each match starts where the one before ended
    (``\\G``) and only if more than ``width`` characters are left, not counting trailing blanks
    after the first break. It then takes the longest piece that ends before a blank and drops the
    blanks that follow, or takes exactly ``width`` characters.
    """
    more_left = rf"(?:^(?=.{{{width + 1}}})|(?!^)\G(?=.{{{width},}}\S))"
    piece = rf"(?:(.{{0,{width - 1}}})[ ]\s*|(.{{{width}}})\s*)"
    broken = F.regexp_replace(text, rf"(?s){more_left}{piece}", f"$1$2{separator}")
    return F.when(F.length(text) <= width, text).otherwise(F.regexp_replace(broken, r"\s+\z", ""))


def flatten_window(df: DataFrame, column: str = "window") -> DataFrame:
    """Replace a window struct by ``window_start`` and ``window_end``."""
    others = [c for c in df.columns if c != column]
    return df.select(
        F.col(f"{column}.start").alias("window_start"), F.col(f"{column}.end").alias("window_end"), *others
    )
