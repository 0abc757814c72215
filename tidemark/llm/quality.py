"""Quality classifier: hashed word n-gram logistic regression with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, hash_runs, joined, mix, runs_of, sliced

BITS = 18
DIMS = 1 << BITS
MAX_LABELLED = 8_000  # labelled rows the model is fitted on, chosen by a hash of the id
MAX_ENTRIES = 1 << 26  # features of these rows, 8 bytes each, that the fitting task holds; rows beyond are left out
MAX_PASSES, SETTLED = 30, 0.007  # passes over the examples, until their mean loss is this small
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.1
KEEP_AT = 0.3

# Tokens are runs of one kind of bytes: letters and digits (and all beyond ASCII), line ends, other signs.
_KINDS = np.full(256, 2, dtype=np.uint8)
_KINDS[[32, *range(9, 14)]] = 0
_KINDS[[10, 13]] = 3
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER = np.zeros(256, dtype=np.int64)  # counts ASCII capitals, and small letters against them
_UPPER[65:91] = 1
_UPPER[97:123] = -(1 << 30)


def held_out(key: Column) -> Column:
    """Rows that labels are never learnt from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _tokens(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Hashes of each text's tokens, A-Z in lower case; words in capitals throughout differ from other words."""
    for raws in sliced(texts):
        content, edges = joined([raw.strip() for raw in raws])
        raw = np.frombuffer(content, dtype=np.uint8)
        starts, ends = runs_of(raw, _KINDS)
        out = hash_runs(np.frombuffer(content.lower(), dtype=np.uint8), starts, ends)
        if len(out):
            capitals = np.add.reduceat(_UPPER[raw], starts)  # what follows a run up to the next one are blanks
            out[capitals > 1] ^= np.uint64(0x5851F42D4C957F2D)
            out[_KINDS[raw[starts]] == 3] = np.uint64(3)  # line ends are alike
        cuts = np.searchsorted(starts, edges).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield out[a:b].copy()


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the words, word pairs and repeats of a word in each whole text, and their weights of length 1."""
    return map(_features, _tokens(texts))


def _features(one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(one):
        return np.empty(0, dtype=np.int64), np.empty(0)
    pair = mix(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])
    again = np.flatnonzero(one[:-1] == one[1:])
    pair[again] = one[again + 1] = np.uint64(1)  # a word said again is the same n-gram, whichever the word
    buckets = (np.concatenate([mix(one), pair]) >> np.uint64(64 - BITS)).astype(np.int64)
    index, count = np.unique(buckets, return_counts=True)
    value = np.sqrt(count)
    return index, value / np.sqrt((value * value).sum())


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Per-coordinate FTRL-proximal over the examples in their order; the last weight is the bias.

    Both labels weigh the same as a whole, however rare one is, and passes go on until the loss has settled: few
    examples take more of them.
    """
    z, n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)
    times = np.bincount([label for _, _, label in examples], minlength=2)
    share = len(examples) / (2 * np.maximum(times, 1))

    def weights(at: np.ndarray) -> np.ndarray:
        short = np.abs(z[at]) <= L1
        full = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(short, 0.0, full)

    for _ in range(MAX_PASSES):
        loss = 0.0
        for index, value, label in examples:
            at, x = np.append(index, DIMS), np.append(value, 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            loss -= share[label] * np.log(max(p if label else 1 - p, 1e-12))
            slope = share[label] * (p - label) * x
            grown = np.sqrt(n[at] + slope * slope)
            z[at] += slope - (grown - np.sqrt(n[at])) / ALPHA * w
            n[at] += slope * slope
        if loss <= SETTLED * len(examples):
            break
    return weights(np.arange(DIMS + 1))


def train_quality(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", limit: int = MAX_LABELLED
) -> np.ndarray:
    """Weights learnt from at most ``limit`` labelled rows that are not held out, chosen by a hash of the id.

    The sample is fixed in size, so its ids may be broadcast and its feature vectors, one for each id and
    ``MAX_ENTRIES`` features in all (512 MB), meet in one task, where the updates run in the order of the hash. Rows
    without id or label are not used; an id with several labels has the smallest, one with several texts the one with
    the smallest vector; labels other than 0 and 1 are not used; without labelled rows all weights are 0.
    """
    rank = F.xxhash64("id")
    sample = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("quality").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.min("label").alias("label"))
        .orderBy(rank, "id").limit(limit)
    )
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")

    def vectors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = list(features(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "rank": batch.column("rank"),
                    "label": batch.column("label").cast(pa.int32()),
                    "buckets": pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary()),
                    "weights": pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary()),
                }
            )

    def fitted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, entries = [], 0
        for label, buckets, values in batches(rows, ["label", "buckets", "weights"]):
            entries += len(buckets) // 4
            if entries <= MAX_ENTRIES:
                examples.append((np.frombuffer(buckets, np.int32), np.frombuffer(values, np.float32), label))
        yield pa.RecordBatch.from_pydict({"model": pa.array([fit(examples).astype(np.float32).tobytes()], pa.binary())})

    sparse = texts.select("id", rank.alias("rank"), "label", "text").mapInArrow(
        vectors, "id bigint, rank bigint, label int, buckets binary, weights binary"
    )
    one = sparse.groupBy("rank", "id", "label").agg(F.min(F.struct("buckets", "weights")).alias("v")).select("rank", "id", "label", "v.*")
    models = one.repartition(1).sortWithinPartitions("rank", "id").mapInArrow(fitted, "model binary").collect()  # one row of 1 MB
    return np.frombuffer(models[0][0], np.float32) if models else np.zeros(DIMS + 1, np.float32)


def score_quality(docs: DataFrame, weights: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    The score is a sparse dot product over the whole text; a NULL or empty text, or one of white space only,
    has the score of the bias. Repeated rows are answered each, a NULL id is not held out, an empty table gives
    no rows. One scan, no shuffle; the weights have a fixed size of 1 MB.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value.astype(np.float64)
        for batch in rows:
            z = np.array([w[i] @ v + w[-1] for i, v in features(batch.column("text").to_pylist())], dtype=float)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(1 / (1 + np.exp(-z)))}
            )

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    scored = rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))


def keep_good(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value.astype(np.float64)
        for batch in rows:
            z = np.array([w[i] @ v + w[-1] for i, v in features(batch.column(text).to_pylist())], dtype=float)
            yield batch.filter(pa.array(1 / (1 + np.exp(-z)) >= KEEP_AT))

    return docs.mapInArrow(run, docs.schema)
