from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import WORDS, docs_of, lowered, odd_rows, sentence
from tidemark.llm import decontaminate
from tidemark.llm.common import table
from tidemark.llm.decontaminate import _blocks, _Size, contaminated_docs, drop_contaminated, find_passages


def shingled(words):
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def expected(docs, items):
    """Every window of every item's size, compared with the item."""
    out = {}
    for i, text in docs:
        words = WORDS.findall(lowered(text))
        for item, stated in items:
            own = WORDS.findall(lowered(stated))
            size = min(len(own), len(words))
            width, best = min(5, len(own)), 0
            theirs = Counter(tuple(own[k : k + width]) for k in range(len(own) - width + 1))
            for at in range(len(words) - size + 1 if size >= width and own else 0):
                some = words[at : at + size]
                mine = Counter(tuple(some[k : k + width]) for k in range(size - width + 1))
                shared = sum((mine & theirs).values())
                either = sum(mine.values()) + sum(theirs.values()) - shared
                if 100 * shared >= 75 * either and shared / either > best:
                    best = shared / either
                    out[i, item] = (at, at + size, round(best, 9))
    return out


ITEMS = [(1, sentence(1, 40)), (2, sentence(2, 20)), (3, sentence(2, 19)), (4, "three words here"), (5, None), (6, ""), (7, "again again again again again again"), (1, sentence(1, 40)), (None, "x")]


def planted():
    item, rows = ITEMS[0][1].split(), []
    for k, edit in enumerate([{}, {0: "q"}, {20: "q"}, {39: "q"}, {10: "q", 30: "r"}, {2: "q", 37: "r"}]):
        words = [edit.get(i, w) for i, w in enumerate(item)]
        rows.append((100 + k, f"{sentence(900 + k, 50)} {' '.join(words).upper()}\n{sentence(950 + k, 30)}", "a"))
    rows += [(200, " ".join(item[4:]), "a"), (201, " ".join(item[:20]), "a"), (202, " ".join([*item[:20], "in", *item[20:]]), "a"), (203, "and three words  here it is", "a")]
    rows += [(204, ITEMS[1][1], "a"), (205, f"{ITEMS[0][1]} {ITEMS[1][1]} {ITEMS[0][1]}", "a"), (206, "again " * 30, "a"), (207, "words here three", "a")]
    return [*rows, *(r for r in odd_rows() if r[0] not in (1, 2, 3, 4, 5, 13, 14))]


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id bigint, text string, doc_id int, similarity string")


def test_against_all_windows(spark):
    rows = planted()
    got = find_passages(docs_of(spark, rows), items_of(spark, ITEMS)).distinct().collect()
    stated = [x for x in dict.fromkeys(ITEMS) if x[0] is not None]
    assert {(r.doc_id, r.item_id): (r.begin_word, r.end_word, round(r.similarity, 9)) for r in got} == expected([(i, t) for i, t, _ in rows], stated)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    whole = {tuple(r) for r in find_passages(docs_of(spark, planted()), items_of(spark, ITEMS)).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(decontaminate, "WINDOWS", 3)
    assert {tuple(r) for r in find_passages(docs_of(spark, planted()), items_of(spark, ITEMS)).collect()} == whole


def test_given_documents(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    stated = [(r.item_id, f" {' '.join(r.text.lower().split())} ") for r in items.collect()]
    verbatim = {r.doc_id for r in docs.collect() for _, t in stated if t in f" {' '.join(r.text.lower().split())} "}
    rows = contaminated_docs(docs, items).collect()
    assert len(rows) == docs.count() and verbatim
    assert verbatim <= {r.doc_id for r in rows if r.contaminated}


def test_rows_and_what_is_dropped(spark):
    rows = planted()
    docs, items = docs_of(spark, rows), items_of(spark, ITEMS)
    answers = contaminated_docs(docs, items).collect()
    assert len(answers) == len(rows)
    stated = [x for x in dict.fromkeys(ITEMS) if x[0] is not None]
    bad = [bool(expected([(i, t)], stated)) for i, t, _ in rows]
    assert sorted((repr(r.doc_id), r.contaminated) for r in answers) == sorted((repr(i), b) for (i, *_), b in zip(rows, bad, strict=True))
    assert next(r.n_items for r in answers if r.doc_id == 205) == 3
    left = drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((i for (i, *_), b in zip(rows, bad, strict=True) if not b), key=repr)


def test_empty_tables(spark):
    assert contaminated_docs(docs_of(spark, []), items_of(spark, ITEMS)).count() == 0
    assert not any(r.contaminated for r in contaminated_docs(docs_of(spark, planted()), items_of(spark, [])).collect())


@pytest.mark.parametrize("radius", [0, 3, 11, 18])
def test_blocks_find_every_fingerprint_within_the_radius(radius):
    assert sum(w for _, w in _blocks(radius)) == 64 and len(_blocks(radius)) == radius + 1
    rng = np.random.default_rng(radius)
    size = _Size(list(range(20)), [rng.integers(0, 2**63, 12, dtype=np.uint64) for _ in range(20)])
    size.close(12, radius)
    prints = size.prints[rng.integers(0, 20, 400)]
    for _ in range(radius + 3):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) * rng.integers(0, 2, 400, dtype=np.uint64)
    near = {(i, k) for i, p in enumerate(prints) for k, q in enumerate(size.prints) if bin(int(p) ^ int(q)).count("1") <= radius}
    assert set(size.near(prints, radius)) == near
