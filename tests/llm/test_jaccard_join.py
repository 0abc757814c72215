import numpy as np
import pytest

from tests.llm.helpers import component_ids, docs_of, odd_rows, sentence, shingle_set, similar
from tidemark.llm import jaccard_join
from tidemark.llm.components import components
from tidemark.llm.jaccard_join import drop_near_copies, jaccard_components, jaccard_links, tree_overlaps


def near_copies(first, group, words, edits, seed):
    """Texts that differ from one base in some words; some link with each other, some with the base alone."""
    base = sentence(group, words).split()
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(edits):
        text = list(base)
        for at in rng.integers(0, words, rng.integers(0, 4)):
            text[at] = f"x{group}-{i}-{at}"
        rows.append((first + i, " ".join(text), "a"))
    return rows


ROWS = [
    *odd_rows(),
    *near_copies(100, 50, 80, 60, 1),
    *near_copies(200, 51, 40, 30, 2),
    *near_copies(300, 52, 300, 20, 3),
    # a passage that many otherwise different documents share
    *((400 + i, sentence(60, 20) + " " + sentence(500 + i, 15 + i), "a") for i in range(40)),
    # just at the threshold and just below: 5-word shingles of 11 and 12 words
    (500, sentence(70, 10), "a"), (501, sentence(70, 12), "a"), (502, sentence(70, 13), "a"),
]


def check(spark, rows):
    got = jaccard_components(docs_of(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "class_id"]
    found = got.collect()
    sets = {i: shingle_set(t) for i, t, _ in rows if i is not None}
    roots = component_ids(sets)
    expected = sorted(((i, len(shingle_set(t)), None if i is None else roots[i]) for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == expected
    classes = {}
    for i, s in sets.items():
        if s:
            classes[s] = min(i, classes.get(s, i))
    for r in found:
        if r.doc_id is not None:
            assert r.class_id == (classes[sets[r.doc_id]] if sets[r.doc_id] else r.doc_id)


def test_against_all_pairs(spark):
    check(spark, ROWS)


def test_small_blocks_and_stars_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "STAR", 5)
    check(spark, ROWS)


def test_links_against_all_pairs(spark):
    first = {}
    for i, text, _ in ROWS:
        if i is not None and shingle_set(text):
            first[shingle_set(text)] = min(i, first.get(shingle_set(text), i))
    sets = sorted((i, s) for s, i in first.items())
    expected = {(i, k) for n, (i, s) in enumerate(sets) for k, t in sets[n + 1 :] if similar(s, t)}
    found = [tuple(r) for r in jaccard_links(docs_of(spark, ROWS)).collect()]
    assert len(expected) > 300 and set(found) == expected and len(found) == len(expected)


def test_empty_tables(spark):
    assert jaccard_components(docs_of(spark, [])).count() == 0
    check(spark, [(1, None, "a"), (2, "", "a")])
    check(spark, [(1, "a b c", "a")])


def test_an_id_with_different_texts_is_one_document(spark):
    rows = [(1, sentence(1, 30), "a"), (1, sentence(2, 30), "a"), (2, sentence(1, 30), "a"), (3, sentence(2, 30), "a")]
    got = jaccard_components(docs_of(spark, rows)).collect()
    linked = {r.doc_id for r in got if r.component_id == 1}
    assert len(got) == 4 and linked in ({1, 2}, {1, 3})


@pytest.mark.parametrize("tasks", [1, 2, 4])
def test_copies_of_a_set_that_does_not_stand_for_its_id(spark, tasks):
    """Of id 1 the set with the smaller digest stands; the other set's copy under id 2 must still be sent out."""
    one, other = sorted((sentence(1, 60), sentence(2, 60)), key=lambda t: jaccard_join._digest(next(jaccard_join._sets_of([t]))))
    near = " ".join([*other.split()[:-1], "changed"])
    docs = docs_of(spark, [(1, other, "a"), (1, one, "a"), (2, other, "a"), (3, near, "a")])
    docs = docs.coalesce(1) if tasks == 1 else docs.repartitionByRange(tasks, "doc_id")
    got = jaccard_components(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 2), (3, 2)]


def test_short_names_are_those_of_spark(spark):
    digests = [bytes(range(k, k + 16)) for k in range(20)]
    got = [r[0] % 2**64 for r in spark.createDataFrame([(d,) for d in digests], "d binary").selectExpr("xxhash64(d)").collect()]
    assert got == [jaccard_join._short(d) for d in digests]


def test_drop_near_copies(spark):
    docs = docs_of(spark, ROWS)
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    roots = component_ids({i: shingle_set(t) for i, t, _ in ROWS if i is not None})
    expected = [i for i, _, _ in ROWS if i is None or roots[i] == i]
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(expected, key=repr)


def test_tree_walk_finds_what_counting_finds():
    rng = np.random.default_rng(5)
    universe = rng.integers(0, 2**63, 60, dtype=np.uint64)
    for _ in range(200):
        base = rng.choice(universe, rng.integers(1, 40), replace=False)
        near = [np.unique(np.append(rng.choice(base, rng.integers(1, len(base) + 1), replace=False), rng.choice(universe, 2))) for _ in range(20)]
        sets = sorted(((i, s) for i, s in enumerate(near)), key=lambda x: x[1].tobytes())
        probe = np.sort(base)
        expected = {i for i, s in sets if 100 * (o := len(np.intersect1d(s, probe))) >= 75 * (len(s) + len(probe) - o)}
        assert set(tree_overlaps(probe, iter(sets))) == expected


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 3), (5, 4), (4, 9), (7, 7)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(70, 3)]])
def test_components(spark, links):
    got = {r.node: r.root for r in components(spark.createDataFrame([*links, (None, 1)], "a bigint, b bigint")).collect()}
    root = {x: x for a, b in links if a != b for x in (a, b)}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_drawn_partners_that_are_not_new_leave_the_rest_to_the_last_turn(spark):
    """All three meet by the same shingles; the first is below the threshold with both others, which link."""
    base, tail = sentence(1000, 100), sentence(1001, 26)
    rows = [(30, base + " tail", "a")]
    rows += [(i, f"{base} {' '.join(f'{c}{k}' for k in range(6))} {tail}", "a") for i, c in ((31, "y"), (32, "z"))]
    check(spark, rows + [(1000 + i, f"{sentence(3000 + i, 100)} {tail}", "a") for i in range(8)])


@pytest.mark.parametrize("part, shingles", [(jaccard_join.PART, jaccard_join.PART_SHINGLES), (7, 1 << 20), (512, 3_000)])
def test_numbers_of_links_against_all_pairs(spark, monkeypatch, part, shingles):
    monkeypatch.setattr(jaccard_join, "PART", part)
    monkeypatch.setattr(jaccard_join, "PART_SHINGLES", shingles)
    rows = [*ROWS, *ROWS[:20]]
    sets = {shingle_set(text) for i, text, _ in rows if i is not None} - {frozenset()}
    links = {s: sum(s != t and similar(s, t) for t in sets) for s in sets}
    got = jaccard_join.jaccard_join(docs_of(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "class_id", "n_links"]
    expected = [(i, 0 if i is None else links.get(shingle_set(text), 0)) for i, text, _ in rows]
    assert sorted(((r.doc_id, r.n_links) for r in got.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(links.values()) > 600


def test_no_links(spark):
    assert [r.n_links for r in jaccard_join.jaccard_join(docs_of(spark, [(1, None, "a"), (2, "", "a"), (3, "a b c", "a"), (None, "a b c", "a")])).collect()] == [0] * 4
    assert jaccard_join.jaccard_join(docs_of(spark, [])).count() == 0
