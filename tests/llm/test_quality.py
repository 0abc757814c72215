import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import docs_of, odd_rows
from tidemark.llm import quality
from tidemark.llm.common import hash_runs, mix, table
from tidemark.llm.quality import DIMS, fit, keep_good, score_quality, train_quality


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return train_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def test_held_out_rows_are_told_apart(spark, sf_dir, model):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = score_quality(docs, model).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
    unseen = [r for r in rows if r.held_out]
    good, bad = [r.score for r in unseen if r.quality], [r.score for r in unseen if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r.predicted == r.quality for r in unseen]) >= 0.97
    assert np.mean([b < 0.3 for b in bad]) > 0.9 and np.mean([g >= 0.3 for g in good]) > 0.99


def test_held_out_labels_are_never_learnt(spark, sf_dir, model):
    labels = table(spark, sf_dir, "labels")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    again = train_quality(table(spark, sf_dir, "documents").repartition(5), turned)
    assert np.array_equal(model, again)  # nor does the order of the rows matter


def test_odd_rows(spark, model):
    docs = docs_of(spark, odd_rows())
    rows = score_quality(docs, model).collect()
    assert len(rows) == len(odd_rows())
    scores = {r.doc_id: r.score for r in rows}
    assert scores[6] == scores[7] == scores[8] == pytest.approx(1 / (1 + np.exp(-float(model[-1]))))
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r.doc_id for r in rows if r.predicted), key=repr)


def test_empty_tables(spark, model):
    no_labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert not train_quality(docs_of(spark, odd_rows()), no_labels).any()
    assert score_quality(docs_of(spark, []), np.zeros(DIMS + 1, np.float32)).count() == 0
    null_labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, quality int")
    assert not train_quality(docs_of(spark, odd_rows()), null_labels).any()


def test_bound_on_labelled_rows(spark, sf_dir):
    few = train_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), limit=20)
    assert few.any()


def hashed(word):
    raw = np.frombuffer(word.encode().lower(), np.uint8)
    return int(hash_runs(raw, np.array([0]), np.array([len(raw)]))[0])


def plain_features(text):
    """Words, pairs and repeats one by one."""
    tokens = []
    for word in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[\n\r]+|[^0-9A-Za-z\x80-\U0010ffff\x09-\x0d ]+", text.strip(" \t\n\r\v\f")):
        capitals, small = sum("A" <= c <= "Z" for c in word), sum("a" <= c <= "z" for c in word)
        tokens.append(3 if word[0] in "\n\r" else hashed(word) ^ (0x5851F42D4C957F2D if capitals > 1 and not small else 0))
    mixed = lambda x: int(mix(np.array([x % 2**64], dtype=np.uint64))[0])
    pairs = [mixed(a * 0x9E3779B97F4A7C15 + b) if a != b else 1 for a, b in zip(tokens, tokens[1:])]
    single = [mixed(1 if k and tokens[k - 1] == t else t) for k, t in enumerate(tokens)]
    count = Counter(x >> (64 - quality.BITS) for x in single + pairs)
    length = math.sqrt(sum(count.values()))
    return {b: math.sqrt(n) / length for b, n in sorted(count.items())}


def plain_ftrl(examples):
    """Follow the regularised leader, coordinate by coordinate."""
    z, n = Counter(), Counter()
    share = [len(examples) / (2 * max(1, sum(y == k for _, y in examples))) for k in (0, 1)]

    def weight(k):
        if abs(z[k]) <= quality.L1:
            return 0.0
        return -(z[k] - math.copysign(quality.L1, z[k])) / ((quality.BETA + math.sqrt(n[k])) / quality.ALPHA + quality.L2)

    for _ in range(quality.MAX_PASSES):
        loss = 0.0
        for x, y in examples:
            x = {**x, DIMS: 1.0}
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            loss -= share[y] * math.log(p if y else 1 - p)
            for k, v in x.items():
                slope = share[y] * (p - y) * v
                z[k] += slope - (math.sqrt(n[k] + slope**2) - math.sqrt(n[k])) / quality.ALPHA * w[k]
                n[k] += slope**2
        if loss <= quality.SETTLED * len(examples):
            break
    return {k: weight(k) for k in z}


TEXTS = ["One two two, three.\nFOUR four!", "  spam SPAM spam spam \n\n buy!!", "été Été ﬀ x\ty", "a", "", "Words and words and words, again", "AB ab Ab 12 12 12\r\nend", "buy buy now"]


def test_against_plain_features_and_updates():
    both = list(quality.features(TEXTS))
    for (index, value), text in zip(both, TEXTS):
        told = plain_features(text)
        assert index.tolist() == list(told) and np.allclose(value, list(told.values()))
    labels = [1, 0, 1, 1, 0, 1, 1, 0]
    weights = fit([(i, v, y) for (i, v), y in zip(both, labels)])
    plain = plain_ftrl([(plain_features(t), y) for t, y in zip(TEXTS, labels)])
    assert {int(k) for k in np.flatnonzero(weights)} <= set(plain)
    assert all(abs(weights[k] - w) < 1e-6 for k, w in plain.items())


def test_ids_that_repeat_are_one_example(spark):
    rows = [(1, "good words here", "a"), (2, "buy buy buy", "a"), (3, "more good words", "a"), (4, "spam spam", "a")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (4, 7)], "doc_id bigint, quality int")
    once = train_quality(docs_of(spark, rows), labels)
    assert once.any() and np.array_equal(once, train_quality(docs_of(spark, rows * 3).repartition(4), labels))
