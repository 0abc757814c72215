"""Mixing sources to target weights: temperature by bisection, budgets as permutations of blocks."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

SEED = "mix-1"
BLOCK_DOCS = 4096  # documents of a source in a block, on average
STEPS = 32  # halvings of the exponent's interval
SENT_SOURCES = 50_000  # rows of budgets that are broadcast at most
SALTS = 64


@dataclass(frozen=True)
class Target:
    """What the exponent is to meet: an entropy as a share of the highest one, or a limit on repetitions."""

    entropy: float | None = 0.95
    repeats: float | None = None


def token_count(text: Column) -> Column:
    """Words of a text: runs of anything but blank, tab and line ends."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return words.cast("bigint")


def source_totals(docs: DataFrame) -> DataFrame:
    """source, n_docs, n_tokens, share of the sources that have tokens; one row for each source."""
    totals = docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    totals = totals.filter(F.col("n_tokens") > 0)
    whole = totals.agg(F.sum("n_tokens").alias("all_tokens"))  # one row
    return totals.join(F.broadcast(whole)).withColumn("share", F.col("n_tokens") / F.col("all_tokens"))


def _too_flat(totals: DataFrame, exponent: float, target: Target, budget_tokens: int) -> bool:
    """Whether at this exponent the mix passes its target: one aggregate over the sources, one row back."""
    power = F.pow(F.col("share"), F.lit(exponent))
    sums = totals.agg(F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("s"), F.max(power / F.col("n_tokens")).alias("most"), F.count("*").alias("n")).first()
    if not sums["n"]:
        return False
    if target.repeats is not None:
        return sums["most"] / sums["z"] * budget_tokens > target.repeats
    entropy = math.log(sums["z"]) - sums["s"] / sums["z"]
    return entropy > target.entropy * math.log(sums["n"])


def bisect_exponent(totals: DataFrame, target: Target, budget_tokens: int) -> float:
    """The exponent in 0..1 at which the mix just keeps its target.

    A smaller exponent flattens the shares: the entropy grows, and so do the repetitions of small sources.
    Shares that pass the target even as they are keep the exponent 1; a target never reached gives 0.
    """
    low, high = 0.0, 1.0  # passes at low, keeps at high
    if _too_flat(totals, high, target, budget_tokens):
        return 1.0
    if not _too_flat(totals, low, target, budget_tokens):
        return 0.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        if _too_flat(totals, middle, target, budget_tokens):
            low = middle
        else:
            high = middle
    return high


def source_budgets(totals: DataFrame, exponent: float, budget_tokens: int) -> DataFrame:
    """source, n_docs, n_tokens, weight, budget (tokens) for every source."""
    power = F.pow(F.col("share"), F.lit(exponent))
    whole = totals.agg(F.sum(power).alias("z"))  # one row
    weight = power / F.col("z")
    return totals.join(F.broadcast(whole)).select(
        "source", "n_docs", "n_tokens", F.round(weight, 6).alias("weight"), F.floor(F.round(weight * budget_tokens, 3)).cast("bigint").alias("budget")
    )


def _with_budgets(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """The documents with their source's budget; no source's documents meet in one task.

    Up to ``SENT_SOURCES`` rows of budgets, a few MB, are sent to the tasks. More of them are repeated for
    every salt, and documents are dealt by source and salt.
    """
    same = F.col("source") == F.col("of_source")
    if budgets.count() <= SENT_SOURCES:
        return rows.join(F.broadcast(budgets), same).drop("of_source")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SALTS)).cast("int"))
    return salted.join(budgets.select("*", salts), same & (F.col("salt") == F.col("of_salt"))).drop("of_source", "salt", "of_salt")


def draw(*parts: Column) -> Column:
    """A number from 0 to 2^60 - 1 for the parts: the first 15 digits of their MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("bigint")


def mix_sources(
    docs: DataFrame, target: Target = Target(), budget_tokens: int | None = None, seed: str = SEED, block_docs: int = BLOCK_DOCS
) -> DataFrame:
    """The mixed corpus as (doc_id, source, epoch, block, n_tokens, weight), a row for every time a document is taken.

    ``docs`` has doc_id, source and n_tokens (see ``token_count``); the budget is the corpus itself unless given.
    Share of a source: its part of all tokens, raised to the exponent that meets the target and normalised.
    A source's budget is taken in epochs. Every epoch is a permutation of the source's blocks, and of the
    documents in each block, drawn anew from the seed: whole epochs take everything, the last one takes blocks
    and documents in their order as long as the tokens before them are below what is left of the budget.

    A NULL source is the source ``unknown``; documents without tokens are never taken, and a source of nothing
    else has no share; NULL ids are drawn as the text ``null``; rows that repeat are documents of their own.
    No documents, no rows. Columns of other names are not looked at.

    Plan: sums per source, then per source and block (partial aggregation first); the running sum over blocks
    sees one row per block, the one over documents ``block_docs`` rows on average, so a source with a third of
    all documents is spread over as many tasks as any other rows. The number of epochs multiplies the rows, as
    it must; nothing but sums reaches the driver.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("unknown")).alias("source"), "n_tokens").filter(F.col("n_tokens") > 0)
    rows = written(rows, "mix-documents")
    totals = written(source_totals(rows), "mix-sources")
    budget_tokens = (totals.agg(F.sum("n_tokens")).first()[0] or 0) if budget_tokens is None else budget_tokens
    exponent = bisect_exponent(totals, target, budget_tokens)
    budgets = source_budgets(totals, exponent, budget_tokens).select(
        F.col("source").alias("of_source"),
        "weight",
        F.col("budget"),
        F.col("n_tokens").alias("epoch_tokens"),
        F.ceil(F.col("n_docs") / block_docs).cast("bigint").alias("blocks"),
    )
    epochs = F.expr("sequence(0L, (budget - 1) div epoch_tokens)")
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    taken = (
        _with_budgets(rows, budgets.filter(F.col("budget") > 0))
        .withColumn("block", F.pmod(draw(F.lit(seed), F.lit("block"), identity), F.col("blocks")))
        .withColumn("epoch", F.explode(epochs))
    )
    whole = taken.filter((F.col("epoch") + 1) * F.col("epoch_tokens") <= F.col("budget"))
    last = taken.filter((F.col("epoch") + 1) * F.col("epoch_tokens") > F.col("budget"))
    columns = ["doc_id", "source", "epoch", "block", "n_tokens", "weight"]
    place = draw(F.lit(seed), F.lit("order"), F.col("epoch").cast("string"), F.col("block").cast("string"))
    blocks = last.groupBy("source", "epoch", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    ahead = Window.partitionBy("source").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("place", place).select(
        F.col("source").alias("of_source"), F.col("block").alias("of_block"), F.coalesce(F.sum("block_tokens").over(ahead), F.lit(0)).alias("before_block")
    )
    mine = draw(F.lit(seed), F.lit("doc"), F.col("epoch").cast("string"), identity)
    inside = Window.partitionBy("source", "block").orderBy("drawn", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.col("epoch") * F.col("epoch_tokens")
    partial = (
        last.join(blocks, (F.col("source") == F.col("of_source")) & (F.col("block") == F.col("of_block")))
        .filter(F.col("before_block") < left)
        .withColumn("drawn", mine)
        .withColumn("before", F.col("before_block") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .filter(F.col("before") < left)
    )
    return whole.select(columns).unionByName(partial.select(columns))


def mix_documents(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """``mix_sources`` over a table of documents with doc_id, source and text."""
    return mix_sources(docs.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens")), target)
