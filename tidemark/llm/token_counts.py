"""Token counts through a cache of digests."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import written
from tidemark.sources.files import has_input

MEMO_PIECES = 200_000  # pieces whose count a task keeps at a time
CACHE_SCHEMA = "tokenizer string, digest string, n_tokens bigint"


def library_of(path: str) -> str:
    for ending, library in ((".json", "tokenizers"), (".model", "sentencepiece")):
        if path.endswith(ending):
            return library
    raise ValueError(f"{path}: a vocabulary is a .json or a .model file")


def tokenizer_digest(path: str) -> str:
    """What the counts depend on: the vocabulary's bytes, and the library with its version."""
    library = library_of(path)
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{library} {version(library)} {content}".encode()).hexdigest()


class _PieceCounts(dict):
    """Tokens of a piece between two blanks, the blank before it included; -1 where a cut is not safe."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMO_PIECES:
            self.clear()
        if not piece or piece[0].isspace() or piece[-1].isspace():
            count = -1
        else:
            count = len(self.tokenizer.encode(" " + piece, add_special_tokens=False))
        if len(piece) <= 64:
            self[piece] = count
        return count


_ready: dict[str, Callable[[str], int]] = {}


def _reused_counter(library: str, version_digest: str, content: Broadcast) -> Callable[[str], int]:
    """The counter of a vocabulary; a worker process builds it once, for all its tasks."""
    if version_digest not in _ready:
        _ready.clear()
        _ready[version_digest] = _counter(library, content.value)
    return _ready[version_digest]


def _counter(library: str, content: bytes) -> Callable[[str], int]:
    if library == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda text: len(model.encode(text, num_threads=1))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    whole = lambda text: len(tokenizer.encode(text, add_special_tokens=False))
    parts = json.loads(content)
    before = parts.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    blank_in_token = any(
        t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in parts["added_tokens"]
    )
    if not plain or parts.get("normalizer") or blank_in_token:
        return whole
    counts = _PieceCounts(tokenizer)

    def count(text: str) -> int:
        # The byte-level pattern always starts a new token at a blank between two characters that are no white
        # space, so the pieces there can be encoded (and remembered) one by one. Any other text is taken whole.
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return whole(text)
        each = [counts[piece] for piece in rest]
        return whole(text) if -1 in each else whole(first) + sum(each)

    return count


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """(digest, text) -> (digest, n_tokens); the vocabulary file, a few MB, is sent to the tasks."""
    library, version_digest = library_of(path), tokenizer_digest(path)
    with open(path, "rb") as file:
        content = texts.sparkSession.sparkContext.broadcast(file.read())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _reused_counter(library, version_digest, content)
        for batch in rows:
            yield pa.RecordBatch.from_pydict(
                {"digest": batch.column("digest"), "n_tokens": pa.array([count(t) if t else 0 for t in batch.column("text").to_pylist()], pa.int64())}
            )

    return texts.select("digest", "text").mapInArrow(run, "digest string, n_tokens bigint")


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """All counts stored so far; a folder that is not there yet is an empty cache."""
    if not has_input(spark, cache, ".parquet"):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def count_tokens(
    docs: DataFrame, path: str, cache: str, limit: int = 512, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Texts are joined by their digest with the counts stored under the tokenizer's digest; of those that have
    none, each different text is encoded once, and the counts are appended to the cache. Content is not
    changed beyond NULL as the empty text, since every blank counts for a tokenizer.

    NULL and empty texts have 0 bytes and 0 tokens. Rows that repeat are returned as often. NULL ids stay.
    Empty table: no rows. Two jobs that miss the same text at once may both store it; the reader takes one.
    Very long texts are cut at blanks where the tokenizer itself always cuts, so nothing is left out.

    The text is shuffled once, by document and so evenly, to bring it to the one row of each digest that is
    to be encoded; everything else moves digests only.
    """
    spark, version_digest = docs.sparkSession, tokenizer_digest(path)
    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(content, 256)
    keys = written(
        docs.select(F.col(key).alias("doc_id"), digest.alias("digest"), F.octet_length(content).cast("bigint").alias("n_bytes")),
        "text-keys",
    )
    stored = read_cache(spark, cache).filter(F.col("tokenizer") == version_digest).select("digest", "n_tokens")
    misses = (
        keys.groupBy("digest").agg(F.min("doc_id").alias("carrier")).join(stored, "digest", "left_anti")
    ).withColumnRenamed("digest", "missed")
    rows = docs.select(F.col(key).alias("doc_id"), content.alias("text"), digest.alias("digest"))
    carried = rows.join(misses, F.col("doc_id").eqNullSafe(F.col("carrier")) & (F.col("digest") == F.col("missed")))
    encoded = encode_counts(carried, path).select(F.lit(version_digest).alias("tokenizer"), "digest", "n_tokens")
    encoded = encoded.distinct()  # a row that repeats both id and text is carried as often
    encoded.write.mode("append").parquet(cache)
    counts = (
        read_cache(spark, cache).filter(F.col("tokenizer") == version_digest)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    return keys.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
