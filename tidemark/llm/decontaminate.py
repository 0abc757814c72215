"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact weighted shingle similarity.

Windows with the word count of a benchmark item slide over the whole text. The fingerprint of a window is the
SimHash of its words. Fingerprints are cut into one block more than the radius, so two that differ in no more bits
than the radius agree in a block: looking each block up finds all items within the radius. What is found is checked
exactly: the multisets of shingles, weighted by how often each occurs, must have a similarity of 0.75 or more.

A window that shares no shingle with any item of its size has similarity 0, so fingerprints are made for the
others only. That loses nothing and spares almost all the work on texts without benchmark passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SHINGLE_WORDS, mix, window_hashes, word_hashes

PERCENT = 75
RADIUS = 18  # of 64 bits
BITS = 64
BLOCK_ITEMS = 50_000  # items that are sent to the tasks at a time
BLOCK_CHARS = 20_000_000  # and characters
FILTER_BITS = 22
WINDOWS = 8192  # windows that are worked on at a time

PASSAGES = "doc_id bigint, item_id bigint, begin_word bigint, end_word bigint, similarity double"


def _simhash(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of the runs of ``size`` words at ``starts`` (ascending)."""
    low = int(starts[0])
    part = mix(words[low : int(starts[-1]) + size] ^ np.uint64(0xA0761D6478BD642F))
    bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    total = np.zeros((len(part) + 1, BITS), dtype=np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    at = starts - low
    return np.packbits((total[at + size] - total[at]) > 0, axis=1).view("<u8").ravel()


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 blocks that cover the fingerprint."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


@dataclass
class _Size:
    """The items of one word count."""

    ids: list[int] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)

    def close(self, size: int, radius: int) -> None:
        self.width = min(SHINGLE_WORDS, size)
        self.counts = [np.unique(window_hashes(w, self.width), return_counts=True) for w in self.words]
        self.known = np.unique(np.concatenate([tokens for tokens, _ in self.counts]))
        prints = np.array([_simhash(w, np.zeros(1, dtype=np.int64), size)[0] for w in self.words], dtype=np.uint64)
        self.prints = prints
        self.tables = []
        for shift, width in _blocks(radius):
            keys = (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            order = np.argsort(keys, kind="stable")
            self.tables.append((shift, width, keys[order], order))

    def near(self, prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
        """(window, item) for all fingerprints within the radius."""
        found = []
        for shift, width, keys, order in self.tables:
            key = (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            window = np.repeat(np.arange(len(prints)), high - low)
            place = np.arange(len(window)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            item = order[np.repeat(low, high - low) + place]
            close = np.bitwise_count(prints[window] ^ self.prints[item]) <= radius
            found.append(window[close] * len(self.ids) + item[close])
        both = np.unique(np.concatenate(found))
        return [divmod(int(x), len(self.ids)) for x in both]


class _Index:
    """A block of items, by size."""

    def __init__(self, items: list[tuple[int, str]], radius: int):
        self.radius, self.sizes = radius, {}
        for (item_id, _), (words, _) in zip(items, word_hashes([text for _, text in items]), strict=True):
            if len(words):
                size = self.sizes.setdefault(len(words), _Size())
                size.ids.append(item_id)
                size.words.append(words)
        for n, size in self.sizes.items():
            size.close(n, radius)
        # Of each width a bit table of the shingles, all shingles, and for each of them the sizes that have it.
        self.widths: dict[int, tuple[np.ndarray, np.ndarray, dict[int, list[int]]]] = {}
        for width in {size.width for size in self.sizes.values()}:
            owners: dict[int, list[int]] = {}
            for n, size in self.sizes.items():
                if size.width == width:
                    for token in size.known.tolist():
                        owners.setdefault(token, []).append(n)
            known = np.array(sorted(owners), dtype=np.uint64)
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            bits[(known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.widths[width] = bits, known, owners

    def passages(self, texts: list[str | None]) -> Iterator[list[tuple[int, int, int, float]]]:
        """For each text (item, begin, end, similarity) of the best window of every item it has a passage of."""
        for words, windows in word_hashes(texts):
            yield self._passages(words, windows) if len(words) else []

    def _passages(self, words: np.ndarray, windows: np.ndarray) -> list[tuple[int, int, int, float]]:
        best: dict[int, tuple[int, int, int, float]] = {}
        for width, (bits, known, owners) in self.widths.items():
            tokens = windows if width == SHINGLE_WORDS else window_hashes(words, width)
            at = np.flatnonzero(bits[(tokens >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at = at[known[np.minimum(np.searchsorted(known, tokens[at]), len(known) - 1)] == tokens[at]]
            by_size: dict[int, list[int]] = {}
            for place, token in zip(at.tolist(), tokens[at].tolist(), strict=True):
                for n in owners[token]:
                    by_size.setdefault(n, []).append(place)
            for n, places in by_size.items():
                self._slide(words, tokens, np.array(places), min(n, len(words)), self.sizes[n], best)
        return list(best.values())

    def _slide(self, words, tokens, at, n, size: _Size, best) -> None:
        # All windows of n words that hold one of the shingles at ``at``.
        edge = np.zeros(len(words) - n + 2, dtype=np.int64)
        np.add.at(edge, np.maximum(at - (n - size.width), 0), 1)
        np.add.at(edge, np.minimum(at, len(words) - n) + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        runs = np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1)
        for run in (r[i : i + WINDOWS] for r in runs for i in range(0, len(r), WINDOWS)):
            for window, item in size.near(_simhash(words, run, n), self.radius):
                begin = int(run[window])
                shared = size.counts[item]
                mine, often = np.unique(tokens[begin : begin + n - size.width + 1], return_counts=True)
                _, left, right = np.intersect1d(mine, shared[0], assume_unique=True, return_indices=True)
                common = int(np.minimum(often[left], shared[1][right]).sum())
                either = int(often.sum() + shared[1].sum()) - common
                if 100 * common >= PERCENT * either:
                    found = (size.ids[item], begin, begin + n, common / either)
                    known = best.get(found[0])
                    if known is None or found[3] > known[3]:
                        best[found[0]] = found


def _indexes(docs: DataFrame, items: DataFrame) -> list:
    """The items in blocks of a checked size, as broadcasts; items without id or text are left out."""
    spark = docs.sparkSession
    stated = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text")).filter(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    ).distinct()
    size = stated.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    n = max(1, -(-size[0] // BLOCK_ITEMS), -(-size[1] // BLOCK_CHARS))
    blocks = (stated.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block) for block in range(n))
    return [spark.sparkContext.broadcast(sorted((r["item_id"], r["text"]) for r in block.collect())) for block in blocks]


def find_passages(
    docs: DataFrame, items: DataFrame, radius: int = RADIUS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(doc_id, item_id, begin_word, end_word, similarity): the best window of each item a text has a passage of.

    Items are read in blocks of a checked size, each against all documents; of windows that are alike the first
    one counts. Items without words and NULL items match nothing, and an item that repeats is one item. A text
    shorter than an item is one window. NULL and empty texts have no passages; very long ones are worked on in
    slices of windows. Rows that repeat are answered each; rows without id are answered with a NULL id.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def search(sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _Index(sent.value, radius)
            names = [c.split()[0] for c in PASSAGES.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            for batch in batches:
                both = zip(batch.column("doc_id").to_pylist(), index.passages(batch.column("text").to_pylist()), strict=True)
                out = [(doc_id, *hit) for doc_id, hits in both for hit in hits]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        return rows.mapInArrow(run, PASSAGES)

    first, *more = (search(sent) for sent in _indexes(docs, items))
    for part in more:
        first = first.unionByName(part)
    return first


def contaminated_docs(
    docs: DataFrame, items: DataFrame, radius: int = RADIUS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, contaminated, n_items, item_id, similarity of every row: the best item, of equal ones the smallest id.

    Each row is judged by its own text where it is read, so nothing is joined or shuffled; rows without id are
    judged too. The cases of ``find_passages`` hold. No documents, no rows; no items, nothing is contaminated.
    """
    kind = "doc_id bigint, text string, n_items bigint, item_id bigint, similarity double"
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.lit(0).cast("bigint").alias("n_items"),
        F.lit(None).cast("bigint").alias("item_id"), F.lit(None).cast("double").alias("similarity"),
    )

    def judge(rows: DataFrame, sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _Index(sent.value, radius)
            for batch in batches:
                n, item, similarity = (batch.column(c).to_pylist() for c in ("n_items", "item_id", "similarity"))
                for i, hits in enumerate(index.passages(batch.column("text").to_pylist())):
                    for found, _, _, value in hits:
                        n[i] += 1
                        if item[i] is None or (-value, found) < (-similarity[i], item[i]):
                            item[i], similarity[i] = found, value
                columns = [batch.column("doc_id"), batch.column("text"), pa.array(n, pa.int64()), pa.array(item, pa.int64()), pa.array(similarity, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_items", "item_id", "similarity"])

        return rows.mapInArrow(run, kind)

    for sent in _indexes(docs, items):
        rows = judge(rows, sent)
    return rows.select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "item_id", "similarity")


def drop_contaminated(
    docs: DataFrame, items: DataFrame, radius: int = RADIUS, text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without a passage of any item, with all their columns; judged as above."""

    def clean(rows: DataFrame, sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _Index(sent.value, radius)
            for batch in batches:
                yield batch.filter(pa.array([not hits for hits in index.passages(batch.column(text).to_pylist())], pa.bool_()))

        return rows.mapInArrow(run, docs.schema)

    rows = docs
    for sent in _indexes(docs, items):
        rows = clean(rows, sent)
    return rows
