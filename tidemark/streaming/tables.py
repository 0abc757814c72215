"""Result tables kept by a stream: folders per batch, combined now and then.

``<path>/batches/batch_id=N`` holds the rows of batch N and is replaced when N is attempted again.
Every so many batches the rows up to N are combined into ``<path>/merged/upto=N``; what that replaces is
kept for a while, for readers that have opened it, and then removed. So a reader opens one combined
folder and the few batches after it, and there are never many folders to list, however long the stream
has run. Only folders whose write has finished are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import MissingInput

Combine = Callable[[DataFrame], DataFrame]

KEPT = 2  # results and combined folders kept besides the newest


def _numbers(spark: SparkSession, folder: str, name: str, finished: bool = True) -> list[int]:
    """The numbers N of the folders ``name=N``, of finished ones unless told otherwise."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}=*" + "/_SUCCESS" * finished)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = (status.getPath().getParent() if finished else status.getPath() for status in found)
    return sorted(int(path.getName().split("=")[1]) for path in paths)


def _remove(spark: SparkSession, folder: str, name: str, numbers: Sequence[int]) -> None:
    for number in numbers:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}={number}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store_result(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a whole result; the ones before the last few are removed."""
    rows.write.mode("overwrite").parquet(f"{path}/result={batch_id}")
    spark = rows.sparkSession
    _remove(spark, path, "result", [n for n in _numbers(spark, path, "result", finished=False) if n < batch_id - KEPT])


def newest_result(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished result; results being written or removed are not looked at."""
    finished = _numbers(spark, path, "result")
    if not finished:
        raise MissingInput(f"nothing stored under {path}")
    return spark.read.parquet(f"{path}/result={finished[-1]}")


def finished_batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches whose folders below ``path`` are complete."""
    return _numbers(spark, path, "batch_id")


def stored_rows(
    spark: SparkSession, path: str, before: int | None = None, batches_before: int | None = None
) -> DataFrame:
    """The newest combined folder and the batches after it, not yet combined with each other.

    ``before`` leaves out what is combined up to that batch or later, ``batches_before`` that batch and later ones.
    """
    merged = [n for n in _numbers(spark, f"{path}/merged", "upto") if before is None or n < before]
    start = merged[-1] if merged else -1
    batches = [n for n in _numbers(spark, f"{path}/batches", "batch_id") if n > start]
    batches = [n for n in batches if batches_before is None or n < batches_before]
    parts = [spark.read.parquet(f"{path}/merged/upto={start}")] if merged else []
    if batches:
        parts.append(spark.read.parquet(*[f"{path}/batches/batch_id={n}" for n in batches]))
    if not parts:
        raise MissingInput(f"nothing stored under {path}")
    return reduce(DataFrame.unionByName, parts)


def store_batch(rows: DataFrame, path: str, batch_id: int, combine: Combine, every: int) -> None:
    """Write the rows of a batch, and combine all rows so far after every ``every`` batches.

    What the newest combined folders but ``KEPT`` hold, and the batches in them, is removed.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/batches/batch_id={batch_id}")
    if (batch_id + 1) % every == 0:
        everything = combine(stored_rows(spark, path, before=batch_id))
        everything.write.mode("overwrite").parquet(f"{path}/merged/upto={batch_id}")
        merged = _numbers(spark, f"{path}/merged", "upto")
        old = merged[: -1 - KEPT]
        _remove(spark, f"{path}/merged", "upto", old)
        done = old[-1] if old else -1
        _remove(spark, f"{path}/batches", "batch_id", [n for n in _numbers(spark, f"{path}/batches", "batch_id", finished=False) if n <= done])
