"""Documents with everything that may be odd about them, and plain Python versions of the operators' rules."""

import re

from pyspark.sql import types as T

# Names that the operators use inside, and that a table may bring along
CLASHES = ["digest", "n", "token", "tokens", "rank", "size", "epoch", "block", "weight", "score", "rule", "verdict", "label", "a", "b", "kept", "position", "part", "share", "__x"]
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(name, T.StringType()) for name in CLASHES),
    ]
)


def docs_of(spark, rows):
    """A table of (doc_id, text, source) rows with further columns of clashing names."""
    full = [(i, text, None, source, None if text is None else len(text), *("x" for _ in CLASHES)) for i, text, source in rows]
    return spark.createDataFrame(full, DOCS)


def sentence(seed, words):
    """Words that hardly repeat, always the same for a seed."""
    return " ".join(f"w{(seed * 7919 + k * 104729 + k * k * seed) % 100003}" for k in range(words))


def odd_rows():
    base = sentence(1, 60).split()
    near = [*base[:30], "changed", *base[31:]]
    return [
        (1, " ".join(base), "a"),
        (2, "  ".join(base).upper(), "a"),
        (3, "\n".join(base), "b"),
        (4, " ".join(near), "b"),
        (5, " ".join(near[:50]), "c"),
        (6, None, "c"),
        (7, "", "c"),
        (8, " \t\n ", None),
        (9, "one two", "a"),
        (10, "one  two", "a"),
        (11, "One\ttwo", "a"),
        (12, "Été ÉTÉ ﬀ \u00a0 \u2003x", "a"),
        (12, "Été ÉTÉ ﬀ \u00a0 \u2003x", "a"),
        (None, " ".join(base), "a"),
        (None, None, None),
        (13, sentence(2, 20_000), "a"),
        (14, sentence(2, 20_000) + " end", "a"),
        (15, "same same same same same same same", "a"),
        (16, "same same same same same", "a"),
    ]


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda x: x[0].lower(), text or "")


def shingle_set(text):
    words = WORDS.findall(lowered(text))
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def similar(a, b):
    shared = len(a & b)
    return bool(a) and 100 * shared >= 75 * (len(a) + len(b) - shared)


def component_ids(sets):
    """Smallest reachable id by comparing all sets with each other."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and find(x) != find(y) and similar(sets[x], sets[y]):
                low, high = sorted((find(x), find(y)))
                root[high] = low
    return {i: find(i) for i in ids}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
