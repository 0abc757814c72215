"""A checkpoint belongs to one query: what its state depends on is stored beside it and compared at every start."""

from __future__ import annotations

import difflib
import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Nodes of a logical plan that keep state in a stream, or decide what is dropped from it.
STATEFUL = ("Aggregate", "EventTimeWatermark", "Deduplicate", "DeduplicateWithinWatermark", "Distinct", "Join", "FlatMapGroupsWithState", "TransformWithState", "GlobalLimit")
_ID = re.compile(r"#\d+")
_DEFINED = re.compile(r" AS [^\s,#]+(#\d+)")


class ChangedPlan(ValueError):
    """The query's state is not what its checkpoint holds."""


def _shown(text: str) -> str:
    """An expression without the numbers that differ between sessions."""
    return re.sub(r"#\d+L?|plan_id=\d+|-T[0-9.]+ms|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}, ", "", text)


def state_plan(df: DataFrame, mode: str) -> list[str]:
    """The output mode and, from the top, every stateful operator with its expressions and the types it gives.

    With it come the steps below that define what it groups or sums by, such as the windows. Other filters,
    projections and sources may change without harm to the state, so they are not in it.
    """
    lines = [f"mode {mode}"]

    def walk(node, used: set[str]) -> None:
        told, name = node.simpleString(100_000), node.nodeName()
        if name in STATEFUL and node.isStreaming():
            used = used | set(_ID.findall(told))
            kinds = ", ".join(str(f.dataType().simpleString()) for f in node.schema().fields())
            lines.append(_shown(told) if name == "EventTimeWatermark" else f"{_shown(told)} -> {kinds}")
        elif used & (set(_given(node)) if name in ("Expand", "Generate") else set(_DEFINED.findall(told))):
            used = used | set(_ID.findall(told))
            lines.append(_shown(told))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), used)

    walk(df._jdf.queryExecution().analyzed(), set())
    return lines


def _given(node) -> list[str]:
    output = node.output()
    return [f"#{output.apply(i).exprId().id()}" for i in range(output.size())]


def _guard_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}.plan.json"


def guarded(df: DataFrame, checkpoint: str, mode: str = "append") -> DataFrame:
    """The stream, if its checkpoint is new or was written by a query with the same state; else an error that says what changed.

    ``to_parquet(guarded(trends, checkpoint), path, checkpoint)``. The number of shuffle partitions is fixed by
    the checkpoint itself and not compared. A checkpoint that was begun without the guard is taken as it is.
    """
    spark = df.sparkSession
    lines = state_plan(df, mode)
    path = spark._jvm.org.apache.hadoop.fs.Path(_guard_path(checkpoint))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        known = json.loads(spark.read.text(path.toString(), wholetext=True).first()[0])["plan"]
        if known != lines:
            diff = "\n".join(difflib.unified_diff(known, lines, "checkpoint", "query", lineterm="", n=0))
            raise ChangedPlan(f"{checkpoint} holds the state of another query; take a new one, or undo the change:\n{diff}")
        return df
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    out = fs.create(path, True)
    try:
        out.write(bytearray(json.dumps({"digest": digest, "plan": lines}).encode()))
    finally:
        out.close()
    return df


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """What a stopped query holds after a batch (the last unless given): keys and values of a stateful operator."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def held_windows(spark: SparkSession, checkpoint: str, keys: list[str], batch: int | None = None) -> DataFrame:
    """The windows that a windowed query still holds, with their keys: those that are closed have been evicted.

    The state's key is the window and then the keys, in the order of the query's grouping.
    """
    rows = state_rows(spark, checkpoint, batch=batch).select("key.*")
    window, *others = rows.columns
    named = [F.col(f"`{a}`").alias(b) for a, b in zip(others, keys, strict=True)]
    return rows.select(F.col(f"`{window}`.start").alias("window_start"), F.col(f"`{window}`.end").alias("window_end"), *named)
