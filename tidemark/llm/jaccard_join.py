"""N-gram Jaccard join: shingle sets in one global order, candidates by prefix, checked along a prefix tree.

1. A pass over the texts gives every document its number of shingles, a digest of its set, a parity
   signature, and a sketch of how common shingles are (counts per hash slot, over all documents).
2. The global order puts shingles of rare slots first. A pair that links shares one of the first
   n - ceil(0.75 n) + 1 shingles, so only those are sent out, and documents meet by them.
3. Documents that meet are paired by length and signature; both bounds lose nothing.
4. Pairs are checked exactly, many sets against one: the sets come in the order of a prefix tree, the overlap
   of a shared path is taken over from the set before, and a path is left as soon as what remains of either
   set can't reach the needed overlap.
5. Links join components. Documents that already share one need no further check, so a group of near copies
   costs a few checks per document instead of one per pair; all other pairs that pass step 3 are checked.
6. Links lie inside components, so the number of links of each set comes from counting the overlaps of all
   pairs of a component, a pair of blocks at a time; of the pairs only sums per set leave a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, shingles
from tidemark.llm.components import components
from tidemark.session import written

PERCENT = 75
SLOTS = 1 << 16  # of the sketch; the order needs no more than a rough count
BLOCK = 2048  # documents of a group that are paired at a time
STAR = 2048  # sets that are checked against one in a task
PART = 512  # sets of a component that are counted against as many others in a task ...
PART_SHINGLES = 1 << 20  # ... or as many as have so many shingles
SEEN_SETS = 200_000  # digests a task remembers, so that copies in one task are sent out once


def _sets_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted shingle set of each text."""
    for tokens in shingles(texts):
        tokens = np.sort(tokens)
        yield tokens[np.append(True, tokens[1:] != tokens[:-1])] if len(tokens) > 1 else tokens


def _digest(tokens: np.ndarray) -> bytes:
    """128 bits of a sorted set."""
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else b""


def _parity(tokens: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on each bit: sets that differ in d shingles differ in d bits at most.

    There are as many bits as the next power of two has, 512 at least: unlike sets differ in nearly half of them.
    """
    bits = max(512, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount(((tokens >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(parity: np.ndarray) -> np.ndarray:
    """Signatures with half as many bits."""
    half = parity.shape[-1] // 2
    return parity[..., :half] ^ parity[..., half:]


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(SLOTS - 1)).astype(np.int64)


def _ordered(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A sorted set in the global order: by the rank of the slot, then by the shingle."""
    return tokens[np.argsort(common[_slots(tokens)], kind="stable")]


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of documents (slot NULL) and of the sketch (doc_id NULL, n the count)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.int64)
        for batch in rows:
            sets = list(_sets_of(batch.column("text").to_pylist()))
            n = [len(tokens) for tokens in sets]
            digest = [_digest(tokens) for tokens in sets]
            parity = [_parity(tokens) if len(tokens) else b"" for tokens in sets]
            for some in (sets[i : i + 64] for i in range(0, len(sets), 64)):
                counts += np.bincount(_slots(np.concatenate(some)), minlength=SLOTS)
            yield _batch(doc_id=batch.column("doc_id"), slot=pa.nulls(len(n), pa.int32()), n=pa.array(n, pa.int64()), digest=pa.array(digest, pa.binary()), parity=pa.array(parity, pa.binary()))
        slots = np.flatnonzero(counts)
        none = pa.nulls(len(slots), pa.binary())
        yield _batch(doc_id=pa.nulls(len(slots), pa.int64()), slot=pa.array(slots, pa.int32()), n=pa.array(counts[slots]), digest=none, parity=none)

    return docs.mapInArrow(run, "doc_id bigint, slot int, n bigint, digest binary, parity binary")


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _short(digest: bytes) -> int:
    """64 bits of a set's digest, as Spark's xxhash64 gives them."""
    return xxhash.xxh64_intdigest(digest, seed=42)


def _postings(docs: DataFrame, common) -> DataFrame:
    """(token, name) for the first shingles of every set, by a short name of the set itself.

    Copies within a task are sent out once, whichever ids they have: the name says which classes they belong to.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = common.value, set()
        held, names, size = [], [], 0
        pairs = (x for batch in rows for x in zip(batch.column("doc_id").to_pylist(), _sets_of(batch.column("text").to_pylist()), strict=True))
        for doc_id, tokens in pairs:
            digest = _digest(tokens)
            if doc_id is None or not digest or digest in seen:
                continue
            if len(seen) >= SEEN_SETS:
                seen.clear()
            seen.add(digest)
            n = len(tokens)
            first = _ordered(tokens, order)[: n - -(-PERCENT * n // 100) + 1]
            held.append(first)
            names.append(np.full(len(first), _short(digest), dtype=np.uint64))
            size += len(first)
            if size >= 100_000:
                yield _batch(token=pa.array(np.concatenate(held).view(np.int64)), name=pa.array(np.concatenate(names).view(np.int64)))
                held, names, size = [], [], 0
        if held:
            yield _batch(token=pa.array(np.concatenate(held).view(np.int64)), name=pa.array(np.concatenate(names).view(np.int64)))

    return docs.mapInArrow(run, "token bigint, name bigint")


def _sets(docs: DataFrame, common) -> DataFrame:
    """(doc_id, tokens, digest): whole sets in the global order, 8 bytes a shingle."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = common.value
        for batch in rows:
            found = list(_sets_of(batch.column("text").to_pylist()))
            tokens = pa.array([_ordered(x, order).tobytes() for x in found], pa.binary())
            yield _batch(doc_id=batch.column("doc_id"), tokens=tokens, digest=pa.array(map(_digest, found), pa.binary()))

    return docs.mapInArrow(run, "doc_id bigint, tokens binary, digest binary")


def _groups_of(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Neighbouring rows with the same first ``width`` values."""
    key, held = None, []
    for row in rows:
        if row[:width] != key:
            if held:
                yield key, held
            key, held = row[:width], []
        held.append(row[width:])
    if held:
        yield key, held


def _proposals(held: list[tuple], same: bool, everything: bool) -> list[tuple[int, int]]:
    """Pairs of one unit that length and signature let through and that have different labels.

    ``held``: (side, order, doc_id, label, n, parity), sides 0 and 1 being the two blocks. With ``everything``
    all of them; else each document gets its first partner in the order, and one without gets its next one, so
    whoever has any partner is in a pair.
    """
    held.sort(key=lambda r: (r[1], r[2]))
    ids, labels, n, side = (np.array([r[k] for r in held]) for k in (2, 3, 4, 0))
    # Signatures by length, as rows of 64-bit words; ``row`` is a document's row among those of its length.
    length = np.array([len(r[5]) for r in held])
    row, tables = np.zeros(len(held), dtype=np.int64), {}
    for one in set(length.tolist()):
        at = np.flatnonzero(length == one)
        row[at] = np.arange(len(at))
        tables[one, one] = np.frombuffer(b"".join(held[k][5] for k in at), dtype=np.uint64).reshape(len(at), -1)
        tables[one, one // 2] = _folded(tables[one, one])
    out: list[tuple[int, int]] = []
    open_ = np.ones(len(held), dtype=bool)
    for i in range(len(held) - 1):
        rest = np.arange(i + 1, len(held)) if open_[i] else i + 1 + np.flatnonzero(open_[i + 1 :])
        fits = (labels[rest] != labels[i]) & (100 * np.minimum(n[rest], n[i]) >= PERCENT * np.maximum(n[rest], n[i]))
        if not same:
            fits &= side[rest] != side[i]
        rest = rest[fits]
        if not len(rest):
            continue
        near = []
        for one in set(length[rest].tolist()):
            some, bits = rest[length[rest] == one], min(one, int(length[i]))  # lengths differ by one doubling at most
            differ = np.bitwise_count(tables[one, bits][row[some]] ^ tables[int(length[i]), bits][row[i]]).sum(axis=1, dtype=np.int64)
            # 100 * o >= PERCENT * (sum - o) with sum - 2 * o = differing shingles
            near.append(some[differ * (100 + PERCENT) <= (100 - PERCENT) * (n[some] + n[i])])
        rest = np.sort(np.concatenate(near))
        if not everything and len(rest):
            still = rest[open_[rest]]
            rest = still if len(still) else rest[:1]
            open_[rest] = open_[i] = False
        out += [(int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))) for j in rest]
    return out


def _pair_up(members: DataFrame, classes: DataFrame, labels: DataFrame, turn: int, everything: bool) -> DataFrame:
    """Distinct pairs (a, b) of documents that meet by a shingle, bear different labels and pass both bounds.

    A group is cut into blocks, and blocks are paired, so a shingle of very many documents becomes many units
    of work, each of two blocks at most; a pair of blocks gives only the pairs that pass.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = members.join(labels.withColumnsRenamed({"node": "doc_id", "root": "label"}), "doc_id", "left")
    told = told.withColumn("label", F.coalesce("label", "doc_id"))
    mixed = told.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    mixed = mixed.filter(F.col("low") < F.col("high")).select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    placed = told.join(mixed, "token").withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    units = placed.select(
        "token",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        (F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", "token", F.lit(turn))).alias("place"),
        "doc_id",
        "label",
    ).join(classes.select("doc_id", "n", "parity"), "doc_id")
    columns = ["token", "one", "two", "side", "place", "doc_id", "label", "n", "parity"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for (_, one, two), held in _groups_of(batches(rows, columns), 3):
            found.update(_proposals(held, one == two, everything))
            if len(found) >= 100_000:
                yield _batch(a=pa.array([x for x, _ in found], pa.int64()), b=pa.array([y for _, y in found], pa.int64()))
                found = set()
        yield _batch(a=pa.array([x for x, _ in found], pa.int64()), b=pa.array([y for _, y in found], pa.int64()))

    sorted_units = units.select(columns).repartition(parts, "token", "one", "two").sortWithinPartitions("token", "one", "two")
    return sorted_units.mapInArrow(run, "a bigint, b bigint").distinct()


def tree_overlaps(probe: np.ndarray, sets: Iterator[tuple[int, np.ndarray]]) -> Iterator[int]:
    """Ids of the sets that link with the probe; all are in the global order, the sets in that of the prefix tree.

    Along the path of the set before, ``shared[d]`` is its overlap with the probe after d shingles and
    ``used[d]`` how far into the probe that was, as far as the walk went. The next set takes over what it has
    in common with that path and walks on from there, in steps, until all is seen or the rest of either set
    can't make up what is needed; a set below a place that was left ends there too.
    """
    by_value = np.argsort(probe)
    values, size = probe[by_value], len(probe)
    path, shared, used = np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for key, tokens in sets:
        n = len(tokens)
        needed = -(-PERCENT * (n + size) // (100 + PERCENT))
        reach = min(n, len(path), len(shared) - 1)
        unlike = np.flatnonzero(tokens[:reach] != path[:reach])
        known = int(unlike[0]) if len(unlike) else reach
        path, shared, used = tokens, shared[: known + 1], used[: known + 1]
        while known < n and shared[-1] + min(n - known, size - used[-1]) >= needed:
            step = tokens[known : known + max(32, n // 4)]
            place = np.minimum(np.searchsorted(values, step), size - 1)
            hit = values[place] == step
            shared = np.append(shared, shared[-1] + np.cumsum(hit))
            used = np.append(used, np.maximum(used[-1], np.maximum.accumulate(np.where(hit, by_value[place] + 1, 0))))
            known = len(shared) - 1
        if known == n and shared[-1] >= needed:
            yield key


def _check(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link. Sets are dealt to the set they are checked against, STAR at a time."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stars = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("shares"))
    own = (
        stars.withColumn("share", F.explode(F.expr("sequence(0, shares - 1)")))
        .join(sets.withColumnRenamed("doc_id", "a"), "a")
        .select("a", "share", F.lit(0).alias("role"), F.col("a").alias("b"), "tokens")
    )
    others = (
        pairs.join(stars, "a")
        .withColumn("share", F.pmod(F.xxhash64("b"), F.col("shares")).cast("int"))
        .join(sets.withColumnRenamed("doc_id", "b"), "b")
        .select("a", "share", F.lit(1).alias("role"), "b", "tokens")
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits_a: list[int] = []
        hits_b: list[int] = []

        def walk(stream: Iterator[tuple]) -> Iterator[tuple[int, int]]:
            row = next(stream, None)
            while row is not None:
                star, probe = row[:2], np.frombuffer(row[4], dtype=np.uint64)
                following = None

                def members() -> Iterator[tuple[int, np.ndarray]]:
                    nonlocal following
                    for other in stream:
                        if other[:2] != star:  # noqa: B023
                            following = other
                            return
                        if other[2]:  # a repeated probe is no member
                            yield other[3], np.frombuffer(other[4], dtype=np.uint64)

                for key in tree_overlaps(probe, members()):
                    yield star[0], key
                row = following

        for a, b in walk(batches(rows, ["a", "share", "role", "b", "tokens"])):
            hits_a.append(a)
            hits_b.append(b)
        yield _batch(a=pa.array(hits_a, pa.int64()), b=pa.array(hits_b, pa.int64()))

    dealt = own.unionByName(others).repartition(parts, "a", "share").sortWithinPartitions("a", "share", "role", "tokens")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _links_within(ids: list[int], sides: np.ndarray, sets: list[np.ndarray], same: bool) -> Iterator[tuple[int, int]]:
    """(id, number of links) of the sets of one unit: between its two sides, or among all where it is one block."""
    n = np.array([len(x) for x in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(n)
    order = np.argsort(codes, kind="stable")
    owner = np.repeat(np.arange(len(sets)), n)[order]  # the sets of each shingle, one shingle after the other
    begin = np.append(0, np.cumsum(np.bincount(codes)))
    counts = np.zeros(len(sets), dtype=np.int64)
    for i in range(len(sets)) if same else np.flatnonzero(sides == 0):
        own = codes[ends[i] - n[i] : ends[i]]
        size = begin[own + 1] - begin[own]
        at = np.arange(size.sum()) + np.repeat(begin[own] - np.cumsum(size) + size, size)
        overlap = np.bincount(owner[at], minlength=len(sets))
        links = 100 * overlap >= PERCENT * (n + n[i] - overlap)
        links[i] = False
        if same:  # every pair is met from both ends
            counts[i] = links.sum()
        else:
            links &= sides == 1
            counts[i] = links.sum()
            counts += links
    return zip(ids, counts.tolist(), strict=True)


def _link_counts(labels: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, n_links): with how many other sets each set of a component links; every pair is looked at once."""
    parts = int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = labels.join(classes.select(F.col("doc_id").alias("node"), "n"), "node")
    blocks = F.ceil(F.greatest(F.count("*") / PART, F.sum("n") / PART_SHINGLES)).cast("int").alias("blocks")
    placed = told.join(told.groupBy("root").agg(blocks), "root").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    units = placed.select(
        "root",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        "node",
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    ).join(sets.withColumnRenamed("doc_id", "node"), "node")
    columns = ["root", "one", "two", "node", "side", "tokens"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()

        def once() -> Iterator[tuple]:
            last = None
            for row in batches(rows, columns):
                if row[:4] != last:  # rows that repeat an id
                    yield row
                last = row[:4]

        for (_, one, two), held in _groups_of(once(), 3):
            ids, sides = [r[0] for r in held], np.array([r[1] for r in held])
            for node, n in _links_within(ids, sides, [np.frombuffer(r[2], dtype=np.uint64) for r in held], one == two):
                found[node] += n
            if len(found) >= 100_000:
                yield _batch(node=pa.array(found.keys(), pa.int64()), n_links=pa.array(found.values(), pa.int64()))
                found = Counter()
        yield _batch(node=pa.array(found.keys(), pa.int64()), n_links=pa.array(found.values(), pa.int64()))

    dealt = units.select(columns).repartition(parts, "root", "one", "two").sortWithinPartitions("root", "one", "two", "node")
    return dealt.mapInArrow(run, "node bigint, n_links bigint").groupBy("node").agg(F.sum("n_links").alias("n_links"))


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after further links between nodes."""
    of = labels.withColumnRenamed("node", "a").withColumnRenamed("root", "ra")
    lifted = links.join(of, "a", "left").withColumn("a", F.coalesce("ra", "a")).drop("ra")
    of = labels.withColumnRenamed("node", "b").withColumnRenamed("root", "rb")
    lifted = lifted.join(of, "b", "left").withColumn("b", F.coalesce("rb", "b")).select("a", "b")
    roots = written(components(lifted), "roots").select(F.col("node").alias("root"), F.col("root").alias("upper"))
    moved = labels.join(roots, "root", "left").select("node", F.coalesce("upper", "root").alias("root"))
    fresh = roots.join(labels.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("upper").alias("root"))
    return written(moved.unionByName(fresh), "labels")


@dataclass
class _Meetings:
    """What the first three steps have found out about a table of documents."""

    rows: DataFrame  # doc_id, text
    surveyed: DataFrame  # doc_id, n, digest, parity of every row
    classes: DataFrame  # doc_id, n, digest, parity, class_id; one row for each id that has a set
    members: DataFrame  # token, doc_id: who meets whom; only the first id of each set
    common: Broadcast  # rank of each slot of the sketch

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """The whole sets of the documents with these ids."""
        sets = _sets(self.rows.join(ids, F.col("doc_id") == F.col("id")).select("doc_id", "text"), self.common)
        # of rows that share an id, the one that stands for it
        return written(sets.join(self.classes.select("doc_id", "digest"), ["doc_id", "digest"], "left_semi").drop("digest"), "sets")


def _meet(docs: DataFrame, text: str, key: str) -> _Meetings:
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    survey = written(_survey(rows), "survey")
    counts = np.zeros(SLOTS, dtype=np.int64)
    for slot, n in survey.filter(F.col("slot").isNotNull()).groupBy("slot").agg(F.sum("n")).collect():
        counts[slot] = n
    ranks = np.empty(SLOTS, dtype=np.uint16)  # by rising count
    ranks[np.argsort(counts, kind="stable")] = np.arange(SLOTS, dtype=np.uint16)
    common = spark.sparkContext.broadcast(ranks)
    surveyed = survey.filter(F.col("slot").isNull()).select("doc_id", "n", "digest", "parity")
    full = surveyed.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    one = full.groupBy("doc_id").agg(F.min(F.struct("digest", "n", "parity")).alias("s")).select("doc_id", "s.*")
    same = one.groupBy("digest", "n").agg(F.min("doc_id").alias("class_id"))
    classes = written(one.join(same, ["digest", "n"]), "classes")
    # Shingles that the same sets share are one group, named by two hashes of its sets.
    group = Window.partitionBy("token")
    names = [F.bit_xor(F.xxhash64("name", F.lit(k))).over(group).alias(f"name{k}") for k in (1, 2)]
    sent = _postings(rows, common).repartition("token").distinct()  # dealt once for both
    met = sent.select("name", F.count("*").over(group).alias("size"), *names).filter(F.col("size") > 1)
    met = met.select("name", F.xxhash64("name1", "name2", "size").alias("token")).distinct()
    # A set that stands for no id has no class and goes here.
    standing = classes.select(F.xxhash64("digest").alias("name"), "class_id").distinct()
    members = written(met.join(standing, "name").select("token", F.col("class_id").alias("doc_id")).distinct(), "members")
    return _Meetings(rows, surveyed, classes, members, common)


def _ids_in(pairs: DataFrame) -> DataFrame:
    return written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")


def _no_labels(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("root"))


def jaccard_links(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All links (a, b), a < b, between different sets, each by the smallest id that has it.

    With the classes of ``jaccard_components`` this is the whole join. A group of k near copies that all link
    has k * (k - 1) / 2 links, and so many rows; where the groups alone matter, take the components.
    """
    found = _meet(docs, text, key)
    pairs = _pair_up(found.members, found.classes, _no_labels(docs.sparkSession), 0, everything=True)
    pairs = written(pairs, "pairs")
    return _check(pairs, found.sets_of(_ids_in(pairs)))


def _linked(docs: DataFrame, text: str, key: str) -> tuple[_Meetings, DataFrame, DataFrame | None]:
    """What was found out, (node, root) of every set that links, and the sets of all that may (None: there are none)."""
    found = _meet(docs, text, key)
    labels = written(_no_labels(docs.sparkSession), "labels")
    members, tested, sets = found.members, None, None
    # The first document as partner, then two drawn ones, then all that are left.
    for turn in range(4):
        pairs = _pair_up(members, found.classes, labels, turn, everything=turn == 3)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():  # a turn with drawn partners may draw none that are new and leave others untested
            if turn == 0:
                break
            continue
        if sets is None:  # whoever has any partner is in one of the first pairs; all others are done with
            ids = _ids_in(pairs)
            sets = found.sets_of(ids)
            members = written(members.join(ids, F.col("doc_id") == F.col("id"), "left_semi"), "members")
        labels = _relabel(labels, written(_check(pairs, sets), "links"))
        tested = pairs if tested is None else tested.unionByName(pairs)
    return found, labels, sets


def _answer(found: _Meetings, labels: DataFrame) -> DataFrame:
    ends = found.classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        F.col("doc_id").alias("id"), "class_id", F.coalesce("root", "class_id").alias("component_id")
    )
    return found.surveyed.join(ends, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id of every row of ``docs``.

    A set has the distinct five-word shingles of a whole text (words in lower case, A-Z only); a text of
    fewer words is one shingle; a NULL or empty text, or one without words, has none and links with nothing.
    Two documents link from a Jaccard similarity of 75 % on, in whole numbers. ``class_id`` is the smallest id
    with the very same set, ``component_id`` the smallest that links reach. Shingles are 64-bit hashes.

    Rows that repeat an id are one document, and each is returned; should their texts differ, the set with the
    smallest digest makes the links. A row without id links with nothing and has no component. Empty table:
    no rows. Columns of other names are not looked at.

    The text is read three times and shuffled once, and only sets that a bound lets through are sent on; no
    group, list of pairs or component is ever gathered in one task or on the driver. On the driver and in
    the tasks there is the sketch of fixed size: 65,536 counts there, their ranks in 128 KB here.
    """
    found, labels, _ = _linked(docs, text, key)
    return _answer(found, labels)


def jaccard_join(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The columns of ``jaccard_components`` and n_links: with how many other sets the set of the row's id links.

    Exact copies are one set and count once. A row without id or without shingles has 0 links. All pairs of a
    component are looked at, so a component of k sets costs k * (k - 1) / 2 overlaps and k * k / 512 shuffled
    sets; a task holds two blocks of about 512 sets or 1,048,576 shingles each, or of one set that is larger.
    """
    found, labels, sets = _linked(docs, text, key)
    rows = _answer(found, labels)
    if sets is None:
        return rows.withColumn("n_links", F.lit(0).cast("bigint"))
    counts = _link_counts(labels, found.classes, sets).withColumnRenamed("node", "of")
    # without an id or a set there is no class: such a row's class_id is its own id, which no link has
    return rows.join(counts, F.col("class_id") == F.col("of"), "left").select(*rows.columns, F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all their columns."""
    stays = jaccard_components(docs, text, key).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = stays.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(stays, F.col(key).eqNullSafe(F.col("__id"))).drop("__id")
