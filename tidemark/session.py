"""Session settings and the shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job of the library relies on.
#  - UTC: windows are aligned to the epoch, time-zone-free columns keep their value when cast.
#  - AQE with skew joins: a key holding a large part of the rows is split at run time. The force
#    flag keeps the split even where it costs one more shuffle.
#  - RocksDB: running statistics have unbounded keys, their state must not live on the heap. A
#    batch uploads its changes, not whole snapshots.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Windows are aligned to the epoch and times of day are UTC: results depend on this setting alone."""
    spark.conf.set("spark.sql.session.timeZone", SETTINGS["spark.sql.session.timeZone"])
    return spark


def build_session(name: str = "tidemark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the library settings; ``conf`` takes further options with ``__`` for ``.``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = apply_settings(builder.getOrCreate())
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is not set, a folder in the warehouse, which tables are shared by as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/intermediate").rstrip("/")


def remove_intermediates(spark: SparkSession) -> None:
    """Remove all that this application has written below the shared folder, once its results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` and the ALS iterations write to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/rdd")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; one folder per application can be removed when it is done."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in here are deleted when it has ended.

    Nobody reads them again, but Spark keeps them until the driver collects its garbage, so the files of all steps
    of a job would lie on the disks at once.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, for data that several steps read."""
    path = new_folder(df.sparkSession, name)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows moved to as many buckets of ``keys`` as there are shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def written_by(df: DataFrame, name: str, *keys: str, dealt_before: bool = False) -> DataFrame:
    """The rows as a table in buckets of ``keys``, one file each: joins and groups by them move no row again.

    All rows of a key lie in one bucket. There are as many buckets as shuffle partitions, so a joined side is
    shuffled to the buckets and the table stays where it is. Rows that have been ``dealt`` by the same keys, and
    since then only joined, ranked or cut by them, are written where they lie.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (df if dealt_before else dealt(df, *keys)).write.bucketBy(buckets, *keys).sortBy(*keys)
    with shuffles_released(spark):
        rows.option("path", path).saveAsTable(table)
    return spark.table(table)
