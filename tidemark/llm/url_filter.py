"""URL filter: listed rules first, then a logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOST_GRAMS = (3, 4, 5)
PATH_GRAMS = (3, 4)
BUCKETS = 1 << 16
MAX_LABELLED = 20_000  # rows of the labelled table; it is small by contract and trained on in one place
BLOCK_AT = 0.5

# The rules of the query, as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# The words that the small labelled table is built from.
BAD_WORDS = (
    "casino poker jackpot slots roulette gamble betting bets lottery win pills pharma viagra cialis meds drugs "
    "adult porn xxx sex nude cams escort dating spam scam phish fraud hack crack warez keygen torrent malware "
    "virus ads adserver adtrack banner clicks popup track tracker loan payday credit debt forex crypto replica "
    "cheap free discount deals farm"
).split()
GOOD_WORDS = (
    "news weather science history library museum school college university hospital clinic garden kitchen recipes "
    "travel maps music books sports football cinema theatre gallery journal review research physics biology "
    "chemistry math language grammar dictionary city town council government parliament court bank market office "
    "shop store bakery cafe hotel airport railway bridge river mountain forest ocean planet energy water blog "
    "forum wiki docs support help community project software code data cloud mobile photo video radio press"
).split()
SYLLABLES = "an ar ble ch da de ed en er es ha he in ing is ka la le lo ly ma mi na nd ne nt on or ou ra re ri ro sa se sh st ta te th ti tion to ver wh".split()
SUBDOMAINS = ("", "www.", "m.", "blog.", "shop.", "news.")
DOMAINS = ("com", "org", "net", "de", "fr", "es", "example.com", "example.org", "example.net")
PATHS = ("", "/", "/en/{}", "/de/{}", "/fr/{}.html", "/es/{}/", "/articles/{}", "/{}?page=2", "/index.html", "/en/{}#top")


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table: unwanted hosts pair listed words, wanted ones pair plain words or syllables."""
    rows, n = [], 0

    def add(name: str, blocked: int) -> None:
        nonlocal n
        sub, domain = SUBDOMAINS[n % len(SUBDOMAINS)], DOMAINS[n // 5 % len(DOMAINS)]
        path = PATHS[n // 3 % len(PATHS)].format(n * 37 % 1000)
        rows.append((f"http{'s' * (n % 2)}://{sub}{name}.{domain}{path}", blocked))
        n += 1

    for i, word in enumerate(BAD_WORDS):
        for step in (1, 5, 11, 23):
            add(f"{word}-{BAD_WORDS[(i + step) % len(BAD_WORDS)]}", 1)
        add(f"{word}{GOOD_WORDS[i % len(GOOD_WORDS)]}", 1)
        add(f"{word}-{'x' if i % 2 else 'online'}", 1)
    for i, word in enumerate(GOOD_WORDS):
        for step in (1, 7, 19):
            add(f"{word}{'-' * (step % 2)}{GOOD_WORDS[(i + step) % len(GOOD_WORDS)]}", 0)
        add(word, 0)
    for i in range(1200):
        add("".join(SYLLABLES[(i * (2 * k + 3) + i // 7 * k) % len(SYLLABLES)] for k in range(2 + i % 3)), 0)
    return rows


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (between the first :// and the next /, ? or #; A-Z lower-cased) and path (up to ? or #)."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; NULL where none fits."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, answer in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(answer)).otherwise(verdict)
    return name, verdict


def _grams(text: bytes, sizes: tuple[int, ...], seed: int) -> np.ndarray:
    """Buckets of all character n-grams; bytes stand for characters, and ends are marked."""
    raw = np.frombuffer(b"^" + text + b"$", dtype=np.uint8).astype(np.uint64)
    out = []
    for size in sizes:
        n = len(raw) - size + 1
        if n > 0:
            value = np.full(n, np.uint64(seed * 64 + size))
            for k in range(size):
                value = value * np.uint64(0x100000001B3) + raw[k : k + n]
            out.append(((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(BUCKETS))
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, dtype=np.int64)


def features(host: str, path: str) -> np.ndarray:
    """The distinct buckets of host and path."""
    return np.unique(
        np.concatenate([_grams(host.encode(), HOST_GRAMS, 1), _grams(path.encode(), PATH_GRAMS, 2)])
    )


def split_url(url: str | None) -> tuple[str, str]:
    """``url_parts`` for one text."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:end], rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return host.encode().lower().decode(), path[:stop]


def train(labelled: Sequence[tuple[str, int]], rounds: int = 300, rate: float = 0.5, l2: float = 1e-4) -> np.ndarray:
    """Weights, the last one the bias, by full-batch gradient steps with a falling rate; always the same result."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"the labelled table has more than {MAX_LABELLED} rows")
    rows = [features(*split_url(url)) for url, _ in labelled]
    y = np.array([blocked for _, blocked in labelled], dtype=np.float64)
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows)
    scale = 1 / np.sqrt(np.array([max(len(r), 1) for r in rows]))
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1))  # both classes count alike
    memory = np.zeros(BUCKETS + 1)
    for _ in range(rounds):
        z = np.bincount(at, weights[index], len(rows)) * scale + weights[-1]
        slope = (1 / (1 + np.exp(-z)) - y) * share
        step = np.append(np.bincount(index, (slope * scale)[at], BUCKETS), slope.sum())
        step[:-1] += l2 * weights[:-1]
        memory += step * step
        weights -= rate * step / (np.sqrt(memory) + 1e-9)
    return weights


def score_urls(spark: SparkSession, weights: np.ndarray):
    """A column function (host, path) -> probability of block; the weights have a fixed size of 512 KB."""
    sent = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w = sent.value
        for hosts, paths in parts:
            z = np.empty(len(hosts))
            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                found = features(host, path)
                z[i] = w[found].sum() / np.sqrt(max(len(found), 1)) + w[-1]
            yield pd.Series(1 / (1 + np.exp(-z)))

    return score


def filter_urls(
    pages: DataFrame,
    labelled: Sequence[tuple[str, int]] | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url: str = "url",
    key: str = "page_id",
) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score of every URL.

    The longest rule that fits decides; where none does, the regression does: block at a score of 0.5 or more.
    ``labelled`` are (url, 1 for block) rows of a small table.

    NULL urls and urls without :// have an empty host and path and are scored like that; repeated rows are
    answered each; an empty labelled table gives the score 0.5 everywhere; an empty table gives no rows; other
    columns are not looked at. One scan of two columns, no shuffle, nothing depends on another row.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    score = score_urls(pages.sparkSession, train(labelled_urls() if labelled is None else labelled))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("block_score") >= BLOCK_AT, F.lit("block")).otherwise(F.lit("allow"))
    return parts.withColumn("block_score", score("host", "path")).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "block_score"
    )
