"""Models fitted once: stored under a digest of what they were trained on, and loaded where that is the same."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import recommend

TRAINED_ON = ("user_index", "item_index", "rating")


def training_digest(train: DataFrame, **settings: object) -> tuple[str, int]:
    """A digest of the rows, in any order and partitioning, and of the settings; and the number of rows. One pass."""
    row = F.xxhash64(*TRAINED_ON)
    n, total, mixed = train.agg(
        F.count("*"), F.sum(row.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(row, F.lit(1)))
    ).first()
    content = json.dumps([n, str(total), mixed, settings], sort_keys=True)
    return hashlib.sha256(content.encode()).hexdigest()[:32], n


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _put_in_place(spark: SparkSession, made: str, path: str) -> None:
    """Rename a finished folder; if another job has been faster its result stays."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (made, path))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target) and fs.rename(source, target):
        return
    fs.delete(source, True)


def stored_als(
    train: DataFrame,
    path: str,
    rank: int = recommend.RANK,
    iters: int = recommend.ITERATIONS,
    reg: float = recommend.REGULARIZATION,
    seed: int = recommend.SEED,
    blocks: int | None = None,
    block_ratings: int = recommend.BLOCK_RATINGS,
) -> ALSModel:
    """The model of these rows and settings: loaded from ``path`` if it is there, else fitted and stored.

    A model appears there whole or not at all, so a job that fails leaves nothing to be loaded. ``blocks`` are
    chosen by the number of rows and ``block_ratings`` unless given, and belong to the settings.
    """
    spark = train.sparkSession
    rows = train.filter(F.col("rating").isNotNull())
    digest, n = training_digest(rows, rank=rank, iters=iters, reg=reg, seed=seed, blocks=blocks or f"by {block_ratings} rows")
    place = f"{path}/als-{digest}"
    if not _exists(spark, place):
        model = recommend.fit_als(rows, rank, iters, reg, seed, blocks or recommend.blocks_for(n, block_ratings))
        made = f"{path}/_making-{uuid.uuid4().hex}"
        model.save(made)
        _put_in_place(spark, made, place)
    return ALSModel.load(place).setColdStartStrategy("drop")


def score(model: ALSModel, events: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Predictions of a stored model for a table or a stream of events; unseen users and items are left out.

    ``users`` and ``items`` are the id tables of the training rows (``id_index``). A stream joins them as tables.
    """
    by_user = users.select("user_id", F.col("idx").alias("user_index")).join(
        model.userFactors.select(F.col("id").alias("user_index"), F.col("features").alias("__u")), "user_index"
    )
    by_item = items.select("item_id", F.col("idx").alias("item_index")).join(
        model.itemFactors.select(F.col("id").alias("item_index"), F.col("features").alias("__i")), "item_index"
    )
    # Factors meet their ids first, so that an event is moved to its user and to its item, and not to their factors again.
    rows = events.join(by_user, "user_id").join(by_item, "item_id")
    product = F.aggregate(F.zip_with("__u", "__i", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, b: a + b)
    about = [c for c in events.columns if c not in ("user_id", "item_id")]
    return rows.select("item_index", "user_index", "item_id", "user_id", *about, product.cast("float").alias("prediction"))
