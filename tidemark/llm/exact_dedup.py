"""Exact deduplication against a persistent digest index."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import single_spaced
from tidemark.session import new_folder, written

BUCKETS = 64


class DigestIndex:
    """Digests seen so far and the id that stands for each, in a table bucketed and sorted by digest.

    The folder is the index; a session that opens it again registers the table anew. Buckets are fixed when
    the folder is first used: about 1 GB each at full size is a good number, so choose them for the corpus.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.sha1(path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        fresh.select("digest", "keep_id").repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def text_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, digest) of every row: SHA-256 of the text with white space runs as one blank, NULL as empty."""
    return docs.select(F.col(key).alias("doc_id"), F.sha2(single_spaced(F.col(text)), 256).alias("digest"))


def exact_dedup(docs: DataFrame, index: DigestIndex, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Compare a batch of documents with the index, append what is new, and say which rows stay.

    Of equal texts in a batch the smallest id stays, unless the index already has the text: then the id in
    the index stays and all rows of the batch are copies. Returns doc_id, keep_id, group_size (equal rows of
    this batch), kept, text_sha256; one row per input row, so a repeated row is returned as often as it stands
    there, with the same answer. A NULL text is the empty text. A text whose rows all have NULL ids keeps them
    (keep_id NULL). Empty table: no rows. Other columns are not looked at.

    Plan: one scan for the digests, a partial aggregation per digest (a text that a third of the rows share
    is one row per task), a sort-merge anti-join with the bucketed index (its side is neither shuffled nor
    sorted), and a skew-split join of the digests with their groups.
    """
    digests = written(text_digests(docs, text, key), "digests")
    groups = digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = written(groups, "digest-groups")
    index.append(groups.hint("merge").join(index.read().select("digest"), "digest", "left_anti"))
    known = index.read().hint("merge").join(groups.select("digest", "group_size"), "digest")
    return digests.join(known.hint("merge"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def fresh_index(spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
    return DigestIndex(spark, new_folder(spark, "digest-index"), buckets)


def drop_copies(docs: DataFrame, index: DigestIndex, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows repeating both id and text stay once."""
    stays = exact_dedup(docs, index, text, key).filter("kept").select(F.col("doc_id").alias("__id"), "text_sha256").distinct()
    marked = docs.withColumn("__digest", F.sha2(single_spaced(F.col(text)), 256)).withColumn("__n", F.lit(1))
    same = F.col(key).eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("text_sha256"))
    rows = marked.join(stays, same).drop("__id", "text_sha256", "__n")
    # Only a row that repeats another one's id and text meets it here, in the partition of the join.
    return rows.dropDuplicates(["__digest", key]).drop("__digest")
