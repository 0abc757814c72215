"""Operators that stream sorted rows give the same however the rows are cut into Arrow batches."""

import pytest

from tests.llm.helpers import docs_of, odd_rows, sentence
from tests.llm.test_prefix_trie import ODD, answers, conversations, plainly, table_of
from tidemark.llm import prefix_trie, suffix_dedup, token_alignment
from tidemark.llm.common import with_package

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture(params=["3", "50"])
def small_batches(spark, request):
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, request.param)
    yield with_package(spark)
    spark.conf.set(BATCH, before)


def rows():
    line = sentence(9, 30)
    return [(i, t) for i, t, _ in odd_rows() if t is None or len(t) < 5_000] + [(100 + k, f"{sentence(k, 9)} {line[: 120 + k]} {sentence(50 + k, 9)}") for k in range(25)]


@pytest.mark.parametrize("surroundings", [0, 4, 1 << 16])
def test_suffix_dedup(small_batches, surroundings):
    from tests.llm.test_suffix_dedup import answers as removed
    from tests.llm.test_suffix_dedup import plainly as plain

    assert removed(small_batches, rows(), surroundings) == plain(rows())


def test_prefix_trie(small_batches):
    given = conversations(2) + ODD
    assert answers(prefix_trie.prefix_trie(table_of(small_batches, given).repartition(3))) == plainly(given)


def test_token_alignment(small_batches):
    from tests.llm.test_token_alignment import A, B
    from tests.llm.test_token_alignment import answers as aligned
    from tests.llm.test_token_alignment import plainly as plain

    words = " ".join(f"wörd{k * 7919 % 1007}" for k in range(12_000))  # longer than one range
    given = [*rows(), (900, words)]
    found = aligned(token_alignment.align_tokenizers(docs_of(small_batches, [(i, t, "s") for i, t in given]), A, B))
    expected = {r[0]: r for r in plain(given[:-1] + [(900, "")])}
    assert {r[0] for r in found} == set(expected)
    assert suffix_dedup.LENGTH == 100 and all(r[1:5] == expected[r[0]][1:5] and r[7] == expected[r[0]][7] for r in found if r[0] not in (900, None))
