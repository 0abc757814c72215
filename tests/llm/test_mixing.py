import hashlib
import math

import pytest

from tests.llm.helpers import docs_of, rows_of
from tidemark.llm import mixing
from tidemark.llm.mixing import Target, mix_documents, mix_sources


def draw(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def expected(docs, target, budget, block_docs):
    docs = [(i, s or "unknown", n) for i, s, n in docs if n]
    totals, counts = {}, {}
    for _, s, n in docs:
        totals[s] = totals.get(s, 0) + n
        counts[s] = counts.get(s, 0) + 1
    if not totals:
        return []
    whole = sum(totals.values())
    budget = whole if budget is None else budget

    def mix(e):
        power = {s: (n / whole) ** e for s, n in totals.items()}
        z = sum(power.values())
        return {s: p / z for s, p in power.items()}

    def too_flat(e):
        if target.repeats is not None:
            return max(w * budget / totals[s] for s, w in mix(e).items()) > target.repeats
        return -sum(w * math.log(w) for w in mix(e).values()) > target.entropy * math.log(len(totals))

    low, high = 0.0, 1.0
    if too_flat(1.0):
        e = 1.0
    elif not too_flat(0.0):
        e = 0.0
    else:
        for _ in range(32):
            mid = (low + high) / 2
            low, high = (mid, high) if too_flat(mid) else (low, mid)
        e = high
    out = []
    for s, w in mix(e).items():
        left, epoch = math.floor(round(w * budget, 3)), 0
        blocks = math.ceil(counts[s] / block_docs)
        own = [(i, n, draw("mix-1", "block", "null" if i is None else i) % blocks) for i, t, n in docs if t == s]
        while left > 0:
            order = sorted(own, key=lambda d: (draw("mix-1", "order", epoch, d[2]), d[2], draw("mix-1", "doc", epoch, "null" if d[0] is None else d[0]), d[0] or 0, d[1]))
            for i, n, b in order:
                if left > 0:
                    out.append((i, s, epoch, b, n, round(w, 6)))
                    left -= n
            epoch += 1
    return sorted(out, key=repr)


def tokens_of(spark, docs):
    return spark.createDataFrame([(i, s, n, "x", 1) for i, s, n in docs], "doc_id bigint, source string, n_tokens bigint, weight string, epoch int")


HOT = [(i, "hot" if i % 3 else f"s{i % 9}", 3 + i * 7919 % 40) for i in range(600)]
ODD = [(1, "a", 5), (2, "a", 0), (3, None, 4), (None, "b", 3), (4, "b", 7), (5, "empty", 0), (6, "c", 1), (7, "c", None), (8, "b", 7)]


@pytest.mark.parametrize("docs", [HOT, ODD])
@pytest.mark.parametrize("target,budget", [(Target(), None), (Target(entropy=0.999), None), (Target(entropy=0.0), None), (Target(repeats=2.0), None), (Target(repeats=1.5), 900), (Target(entropy=2.0), 5_000)])
def test_against_a_plain_version(spark, docs, target, budget):
    got = mix_sources(tokens_of(spark, docs), target, budget, block_docs=50)
    assert got.columns == ["doc_id", "source", "epoch", "block", "n_tokens", "weight"]
    assert rows_of(got) == expected(docs, target, budget, 50)


def test_many_sources_are_joined_by_salt(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SENT_SOURCES", 3)
    got = mix_sources(tokens_of(spark, HOT), Target(repeats=1.5), block_docs=50)
    assert rows_of(got) == expected(HOT, Target(repeats=1.5), None, 50)


def test_budgets_are_met_and_limits_kept(spark):
    got = mix_sources(tokens_of(spark, HOT), Target(repeats=2.0), block_docs=50)
    whole = sum(n for _, _, n in HOT)
    taken, has = {}, {}
    for r in got.collect():
        taken[r.source] = taken.get(r.source, 0) + r.n_tokens
    for _, s, n in HOT:
        has[s] = has.get(s, 0) + n
    assert abs(sum(taken.values()) - whole) < 40 * len(has)
    assert max(taken[s] / has[s] for s in has) < 2.0 + 40 / min(has.values())


def test_texts_and_empty_tables(spark):
    rows = [(1, "a b  c\n", "s"), (2, None, "s"), (3, "", None), (4, "x", None)]
    got = mix_documents(docs_of(spark, rows))
    assert {(r.doc_id, r.source, r.n_tokens) for r in got.collect()} == {(1, "s", 3), (4, "unknown", 1)}
    assert mix_documents(docs_of(spark, [])).count() == 0
    assert mix_documents(docs_of(spark, [(1, "", "s")])).count() == 0
