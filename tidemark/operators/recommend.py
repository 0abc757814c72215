"""The recommender: split, fit, predict, evaluate, and profiles of the predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import round3
from tidemark.operators.dedup import PAIR, dedup_ratings
from tidemark.operators.indexing import id_index, index_ids
from tidemark.operators.joins import merged
from tidemark.session import use_checkpoints, written, written_by
from tidemark.sources.events import explode_categories

MATRIX = ("user_index", "item_index", "rating", "user_id", "item_id", "title", "categories")

# The model settings.
RANK, ITERATIONS, REGULARIZATION, SEED, TRAIN_PART = 10, 10, 0.1, 42, 0.8

BLOCKS = 10  # of users and of items at least; part of the model settings, as another number gives another start
BLOCK_RATINGS = 2_000_000  # ratings that a block should hold at most, on average
STEPS = 10_000  # the split is decided in so many steps


def is_test(key: Column | None, columns: Sequence[str], frac: float = TRAIN_PART, seed: int = SEED) -> Column:
    """Whether a row belongs to the hold-out part; a row without a key does not.

    Decided by the row's own key, so the split is the same for any partitioning and any number of
    attempts. ``key`` is an integer column whose last four digits are spread evenly; by default a
    hash of the columns is used.
    """
    number = F.xxhash64(F.lit(seed), *columns) if key is None else key
    return F.coalesce(F.pmod(number, F.lit(STEPS)) >= round(frac * STEPS), F.lit(False))


def split(
    df: DataFrame,
    frac: float = TRAIN_PART,
    seed: int = SEED,
    by: str = "key",
    key: Column | None = None,
    columns: Sequence[str] = PAIR,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; ``by="random"`` draws them, with a result that depends on partitions."""
    if by == "random":
        train, test = df.randomSplit([frac, 1 - frac], seed=seed)
        return train, test
    held_out = is_test(key, columns, frac, seed)
    return df.filter(~held_out), df.filter(held_out)


def rating_matrix(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Events with integer user and item numbers and single-precision ratings.

    Every row is moved twice here: events without title and categories are numbered as they are, and what is
    left of them can be joined with its items later.
    """
    extra = [c for c in keep if c not in MATRIX]
    about = [c for c in ("title", "categories") if c in events.columns]
    columns = ["user_id", "item_id", F.col("rating").cast("float").alias("rating"), *about, *extra]
    indexed = index_ids(events.select(*columns), id_index(events, "user_id"), id_index(events, "item_id"))
    return indexed.select(*[c for c in MATRIX if c in indexed.columns], *extra)


def numbered(events: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The numbers of ``rating_matrix`` without names, and the tables of users and of items (``id_index``).

    Events in buckets of items (``written_by``) are moved once, to the buckets of their users: counting items and
    numbering them happens where they lie, and so it does for users afterwards.
    """
    rows = events.select("user_id", "item_id", F.col("rating").cast("float").alias("rating"), *keep)
    items = merged(written(id_index(rows, "item_id"), "items"))
    by_item = items.select("item_id", F.col("idx").alias("item_index"))
    # A row without an item still counts for its user.
    by_user = written_by(rows.join(by_item, "item_id", "left").drop("item_id"), "by_user", "user_id")
    users = merged(written(id_index(by_user, "user_id"), "users"))
    known = by_user.filter(F.col("item_index").isNotNull())
    matrix = known.join(users.select("user_id", F.col("idx").alias("user_index")), "user_id")
    return matrix.select("user_index", "item_index", "rating", *keep), users, items


def blocks_for(ratings: int, block_ratings: int = BLOCK_RATINGS) -> int:
    """Blocks for so many ratings: ten, and more where these would hold more than ``block_ratings`` each.

    In every iteration each user's and each item's factors are sent to all blocks that hold one of its ratings, so
    more blocks move more data, up to a copy for every rating; fewer blocks need more memory each.
    """
    return max(BLOCKS, -(-ratings // block_ratings))


def fit_als(
    train: DataFrame,
    rank: int = RANK,
    iters: int = ITERATIONS,
    reg: float = REGULARIZATION,
    seed: int = SEED,
    blocks: int = BLOCKS,
) -> ALSModel:
    """Explicit-feedback factorization; unseen users and items get no prediction.

    ``blocks`` of users and of items are worked on at a time: see ``blocks_for``, and take the same number
    again to get the same model. The items' factors of every iteration are checkpointed in the shared folder, so
    the shuffles that led to them and the checkpoint before them are deleted: the disks hold an iteration, not all.
    """
    use_checkpoints(train.sparkSession)
    als = ALS(
        rank=rank,
        maxIter=iters,
        regParam=reg,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user_index",
        itemCol="item_index",
        ratingCol="rating",
        coldStartStrategy="drop",
        checkpointInterval=1,
    )
    return als.fit(train.select("user_index", "item_index", "rating"))


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """The test rows with a ``prediction``; rows of unseen users or items are gone."""
    return model.transform(test)


def recommend(
    events: DataFrame,
    dedup: bool = True,
    rank: int = RANK,
    iters: int = ITERATIONS,
    reg: float = REGULARIZATION,
    seed: int = SEED,
    by: str = "key",
    blocks: int | None = None,
    order_by: Sequence[str] = ("event_time",),
    split_by: Sequence[str] = PAIR,
    key: Column | None = None,
    models: str | None = None,
    block_ratings: int = BLOCK_RATINGS,
) -> DataFrame:
    """Predictions for the hold-out part of the events.

    The split is by a hash of ``split_by``, or by ``key``, an integer made of those columns.

    ``dedup`` trains on one rating per (user, item); without it repeated ratings weigh more, and
    ``split_by`` should name what tells the events apart. Rows that several jobs read are written to
    the shared folder once, so they survive the loss of executors and nothing upstream runs twice;
    without ``dedup`` the events should be such a table. ``blocks`` follow from the number of training rows
    and ``block_ratings`` unless given. With ``models``, a folder, a model of the same rows and settings is loaded instead of fitted again.
    """
    source = written(dedup_ratings(events, order_by=order_by), "pairs") if dedup else events
    matrix = written(rating_matrix(source, split_by), "matrix")
    train, test = split(matrix, seed=seed, by=by, key=key, columns=split_by)
    train = train.filter(F.col("rating").isNotNull())
    if models:
        from tidemark.operators.models import stored_als

        model = stored_als(train, models, rank, iters, reg, seed, blocks, block_ratings)
    else:
        model = fit_als(train, rank, iters, reg, seed, blocks or blocks_for(train.count(), block_ratings))
    return written(predict(model, test), "predictions")


def rmse(predictions: DataFrame) -> DataFrame:
    """One row: root mean squared error and the number of predictions, in one pass."""
    error = F.col("rating").cast("double") - F.col("prediction").cast("double")
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count("prediction").alias("num_predictions"))


def als_rmse(
    events: DataFrame,
    dedup: bool = True,
    rank: int = RANK,
    iters: int = ITERATIONS,
    reg: float = REGULARIZATION,
    seed: int = SEED,
) -> DataFrame:
    return rmse(recommend(events, dedup, rank, iters, reg, seed))


def item_sums(predictions: DataFrame) -> DataFrame:
    """One row per item: the sum and the number of its predictions, for profiles that need no single one."""
    return predictions.groupBy("item_index").agg(
        F.sum("prediction").alias("predicted_sum"), F.count("prediction").alias("predicted")
    )


def _average(predictions: DataFrame) -> tuple[Column, Column]:
    """Aggregates over predictions or over ``item_sums``: rounded average, and number of predictions."""
    if "predicted_sum" in predictions.columns:
        return round3(F.sum("predicted_sum") / F.sum("predicted")), F.coalesce(F.sum("predicted"), F.lit(0))
    return round3(F.avg("prediction")), F.count("prediction")


def als_item_profile(predictions: DataFrame) -> DataFrame:
    """Average prediction per item, of predictions or ``item_sums`` with their item's id and title."""
    return predictions.groupBy("item_index", "item_id", "title").agg(_average(predictions)[0].alias("als_predicted_avg"))


def als_title_profile(predictions: DataFrame) -> DataFrame:
    """Average prediction per title, of predictions or ``item_sums`` with their item's title."""
    return predictions.groupBy("title").agg(_average(predictions)[0].alias("als_predicted_avg"))


def als_category_profile(predictions: DataFrame) -> DataFrame:
    """Average prediction and number of predictions per category, of predictions or ``item_sums``."""
    mean, number = _average(predictions)
    values = [c for c in ("prediction", "predicted_sum", "predicted") if c in predictions.columns]
    return (
        explode_categories(predictions.select("categories", *values))
        .groupBy("category")
        .agg(mean.alias("als_predicted_avg"), number.alias("als_prediction_count"))
    )
