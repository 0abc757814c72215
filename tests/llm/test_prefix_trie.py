import hashlib
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie as pt
from tidemark.llm.common import with_package

SCHEMA = "conv_id bigint, turn int, role string, text string, digest string, n int, place int, level int, key string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "k") for r in rows], SCHEMA)


def plainly(rows):
    """Every prefix of every rebuilt conversation in a dictionary; subtrees by looking at all nodes below."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def answers(df):
    return sorted(map(tuple, df.collect()), key=repr)


def conversations(shared):
    """Conversations over few different turns, so that prefixes are shared at every depth."""
    rows = []
    for c in [*range(0, 40), *range(95, 130), 250, 399]:
        for t in range((c * 7) % 9):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"text {(c * 31 + t * 17) % shared}" * (t % 3 + 1)))
    return rows


ODD = [
    (500, None, "user", "null turn"), (500, 1, None, None), (500, 1, None, ""), (500, 1, "a", "tie"), (500, 1, "a", "tie"),
    (None, 0, "user", "of no conversation"), (7001, 0, "user", "alone"), (7001, -5, "user", "é🙂"), (601, None, None, None),
]


@pytest.mark.parametrize("shared", [1, 2, 5])
def test_against_all_prefixes(spark, shared):
    rows = conversations(shared) + ODD
    found = pt.prefix_trie(table_of(with_package(spark), rows).repartition(5))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {kind for name, kind in found.dtypes if name != "ends_sha256"} == {"bigint"}
    assert answers(found) == plainly(rows)


def test_conversations_longer_than_a_segment(spark):
    """They share whole segments, part ways inside one, or end right at its edge."""
    long_ = [(t, "user", f"turn {t % 7}") for t in range(2 * pt.SEGMENT + 30)]
    rows = [(c, *x) for c in (1000, 1001, 1002) for x in long_]
    rows += [(1003, *x) for x in long_[: pt.SEGMENT]] + [(1004, *x) for x in long_[: pt.SEGMENT + 10]]
    rows += [(1005, *x) for x in long_[: 2 * pt.SEGMENT]] + [(1006, t, r, x if t < 300 else x + "!") for t, r, x in long_] + [(2000, 0, "user", "other")]
    assert answers(pt.prefix_trie(table_of(with_package(spark), rows).repartition(4))) == plainly(rows)


def test_shards_of_any_size():
    """However the sorted sequences are cut into shards, closed nodes and merged open ones are the same nodes."""
    sequences = sorted({tuple((c * 31 + t * c) % 3 for t in range(c % 6)) for c in range(60)})
    z = lambda d, i: hash((d, i, "z")) & (2**62 - 1)
    rows = [(0, 0, 0, [(i, 5, z(d, i), z(d, i) ^ 77) for d, i in enumerate(s)], False, k % 3 + 1, k) for k, s in enumerate(sequences)]
    whole = None
    for size in (len(rows), 1, 2, 7):
        n, conv = defaultdict(int), {}
        for a in range(0, len(rows), size):
            for _, h1, h2, _, _, open_, depth, members, smallest, *_ in pt._shard_rows(rows[a : a + size]):
                assert open_ or (depth, h1, h2) not in n
                n[depth, h1, h2] += members
                conv[depth, h1, h2] = min(smallest, conv.get((depth, h1, h2), smallest))
        whole = whole or (n, conv)
        assert (n, conv) == whole


def test_balanced_by_medians():
    tree = pt.SearchTree(0, 0, 0)
    tree.insert_sorted([([(k, 1, k, k)], 1, k, False) for k in range(1023)])
    depth, todo = 0, [(tree.below[0], 1)]
    while todo:
        at, d = todo.pop()
        if at:
            depth = max(depth, d)
            todo += [(tree.low[at], d + 1), (tree.high[at], d + 1)]
    assert depth == 10


def test_empty_table(spark):
    assert pt.prefix_trie(table_of(with_package(spark), [])).collect() == []
    assert pt.prefix_trie(table_of(spark, [(None, 1, "a", "b")])).collect() == []
