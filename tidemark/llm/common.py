"""Words, shingles and small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5

# White space other than one blank: only such runs change when a text is normalised.
_ODD_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def with_package(spark: SparkSession) -> SparkSession:
    """Let the Python workers of a local session find this package; on a cluster it is installed or shipped."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def single_spaced(text: Column) -> Column:
    """Every run of white space as one blank; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ODD_SPACE, " ")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LONG = 64  # longer runs are hashed one by one
_SIGNS = np.random.default_rng(20240101).integers(0, 2**64, 256, dtype=np.uint64)
_TOGETHER = 1 << 20
_SLICE = 1 << 15  # bytes that are summed up at a time
_BASE = 0xD6E8FEB86659FD93
_POWERS = np.cumprod(np.full(_SLICE + _LONG, _BASE, dtype=np.uint64))
_INVERSES = np.cumprod(np.full(_SLICE, pow(_BASE, -1, 1 << 64), dtype=np.uint64))
_WORDS = np.ones(256, dtype=np.uint8)
_WORDS[[32, *range(9, 14)]] = 0


def runs_of(raw: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the longest runs of bytes of one kind; kind 0 makes none."""
    kind = kinds[raw]
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, ends = np.append(0, change), np.append(change, len(raw))
    some = kind[starts] != 0
    return starts[some], ends[some]


def hash_runs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of bytes, none of them empty: polynomials, taken from running sums."""
    size, out = ends - starts, np.empty(len(starts), dtype=np.uint64)
    short = np.minimum(size, _LONG)
    edges = np.searchsorted(starts, np.arange(0, len(raw) + _SLICE, _SLICE))
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            part = raw[k * _SLICE : (k + 1) * _SLICE + _LONG]
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_SIGNS[part] * _POWERS[: len(part)], out=total[1:])
            at = starts[a:b] - k * _SLICE
            out[a:b] = (total[at + short[a:b]] - total[at]) * _INVERSES[at]
    out = mix(out + size.astype(np.uint64))
    for i in np.flatnonzero(size > _LONG):
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]].tobytes())
    return out


def sliced(texts: list[str | None]) -> Iterator[list[bytes]]:
    """The texts in UTF-8, in lists of about a megabyte: short ones are worked on together, array by array."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode("utf-8", "replace"))
        size += len(held[-1]) + 1
        if size > _TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def joined(raws: list[bytes]) -> tuple[bytes, np.ndarray]:
    """Texts with a blank between them, and where each one starts and the last one ends."""
    sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws)) + 1
    return b" ".join([*raws, b""]), np.append(0, np.cumsum(sizes))


def word_hashes(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the hashes of its words and those of its five-word shingles, by position.

    Words are runs of anything but blank, tab and line ends, with A-Z in lower case.
    """
    for raws in sliced(texts):
        content, edges = joined(raws)
        raw = np.frombuffer(content.lower(), dtype=np.uint8)
        starts, ends = runs_of(raw, _WORDS)
        words = hash_runs(raw, starts, ends)
        windows = window_hashes(words, SHINGLE_WORDS)
        cuts = np.searchsorted(starts, edges).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield words[a:b], windows[a : max(a, b - SHINGLE_WORDS + 1)]


_PLACE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words, by position."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:n] + np.uint64(size)
    for k in range(1, size):
        out *= _PLACE
        out += hashes[k : k + n]
    return mix(out)


def shingles(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Hashes of the shingles of each text by position; a text with fewer words is one shingle of all its words."""
    for words, windows in word_hashes(texts):
        yield window_hashes(words, len(words)) if 0 < len(words) < SHINGLE_WORDS else windows


def batches(rows: Iterator, columns: list[str]) -> Iterator[tuple]:
    """The rows of Arrow batches as Python tuples, batch after batch."""
    for batch in rows:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
