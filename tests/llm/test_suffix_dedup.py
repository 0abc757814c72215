import hashlib
import random

import pytest
import xxhash

from tests.llm.helpers import docs_of, odd_rows, sentence
from tidemark.llm import suffix_dedup as sd
from tidemark.llm.common import with_package


def plainly(rows):
    """Every string of 100 bytes in a dictionary, in the order of the documents."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, xxhash.xxh3_64_intdigest((rows[k][1] or "").encode())))
    seen, out = set(), []
    for k in order:
        raw = (rows[k][1] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((rows[k][0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def answers(spark, rows, surroundings=0, parts=3):
    found = sd.remove_repeats(docs_of(with_package(spark), [(i, t, "s") for i, t in rows]).coalesce(parts), surroundings=surroundings)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("surroundings", [0, 3, sd.SURROUNDINGS])
def test_planted_passages(spark, surroundings):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (15, 25, 60, 200)] + [text(30) + " é日本🙂 " + text(10)]
    rows = []
    for k in range(60):
        parts = [text(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 3)):
            one = draw.choice(passages)
            a = draw.randint(0, len(one) // 2)
            parts += [one[a : a + draw.randint(60, 400)], text(draw.randint(0, 12))]
        rows.append((draw.randint(0, 90), "".join(parts)))
    near = [text(80).split() for _ in range(3)]
    for k in range(24):  # near copies, each changed at a place of its own
        words = list(near[k % 3])
        words[draw.randint(0, 79)] = word()
        rows.append((200 + k, " ".join(words)))
    assert answers(spark, rows, surroundings) == plainly(rows)


@pytest.mark.parametrize("surroundings", [0, sd.SURROUNDINGS])
def test_odd_rows(spark, surroundings):
    rows = [(i, t) for i, t, _ in odd_rows()]
    rows += [(20, "a" * 99), (21, "a" * 100), (22, "a" * 101), (23, "a" * 700), (24, "ab" * 300), (25, "ba" * 200)]
    rows += [(26, "x" * 99), (27, "x" * 99), (28, "é" * 60), (29, "é" * 60), (30, sentence(4, 25)), (30, sentence(4, 25) + "."), (30, sentence(4, 25))]
    rows += [(None, sentence(4, 24)), (None, sentence(4, 24)), (-3, sentence(2, 100))]
    assert answers(spark, rows, surroundings) == plainly(rows)


@pytest.mark.parametrize("alphabet", ["a", "ab", "abc"])
def test_few_letters(spark, alphabet):
    """Strings that are nearly all repeated, by short periods and by chance."""
    draw = random.Random(len(alphabet))
    rows = [(k, "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 12))) * draw.randint(1, 60)) for k in range(40)]
    assert answers(spark, rows) == answers(spark, rows, 5) == answers(spark, rows, sd.SURROUNDINGS) == plainly(rows)


def test_ranks_of_suffixes(spark):
    """The recursion alone, against sorted suffixes; names of one byte each make it as deep as it gets."""
    draw = random.Random(9)
    raw = bytes(draw.choice(b"ab") for _ in range(700)) + b"ab" * 150
    n = len(raw) + 1
    s = [b + 1 for b in raw] + [0, 0, 0]
    table = with_package(spark).createDataFrame([(i, s[i], s[i + 1], s[i + 2]) for i in range(n)], "pos bigint, s0 bigint, s1 bigint, s2 bigint")
    found = {r.pos: r["rank"] for r in sd.suffix_ranks(table, ["s0", "s1", "s2"], n, 3, enough=10**9).collect()}
    whole = sorted(range(n), key=lambda i: s[i:n])
    assert [i for i, _ in sorted(found.items(), key=lambda x: x[1])] == whole


def test_empty_table(spark):
    assert answers(spark, []) == []
    assert answers(spark, [(1, None), (2, "")]) == plainly([(1, None), (2, "")])
