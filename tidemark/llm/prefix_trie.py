"""Trie of the prefixes that conversations share: ternary search trees per range shard, merged at their edges.

1. Turns are numbered within their conversation, conversations are rebuilt, and distinct turns get dense ids.
2. A conversation is a sequence of ids, in rows of ``SEGMENT`` turns. Equal rows are counted first; then the rows are
   range-partitioned, so a shard holds neighbouring sequences.
3. A shard puts its sequences into a ternary search tree, the median first, then the medians of both halves, which
   keeps it balanced. An iterative traversal sums up members, leaves and savings from below.
4. Nodes on the path of a shard's first or last sequence, and those above a segment that goes on, are open: what
   the shards know of them is merged by node. The sums of open nodes travel up by pointer doubling, so a path of
   d turns takes log2(d) rounds, not d.

A node is named by its depth and two 64-bit hashes, each the exclusive or of hashes of (place, id) along its path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches
from tidemark.operators.indexing import number_rows
from tidemark.session import written

SEGMENT = 256  # turns of a conversation in one row
SHARD_TURNS = 1 << 17  # turns of the sequences in one tree
PERIOD = 100  # conversations c take over the first turns of c - c % PERIOD ...
TAKEN = 6  # ... crc32(c) % TAKEN of them
PACK = 10_000  # ids of ending conversations that are hashed as one piece

_PART = "level bigint, h1 bigint, h2 bigint, p1 bigint, p2 bigint, open boolean, depth bigint, n bigint, conv bigint, parent_conv bigint, chars bigint, children bigint, leaves bigint, saved bigint"


class SearchTree:
    """A ternary search tree over sequences of ids; node 0 stands for the empty sequence.

    ``low``, ``high``: siblings with smaller and larger ids; ``below``: the first sibling of the next turn.
    """

    def __init__(self, depth: int, h1: int, h2: int):
        self.low, self.high, self.below, self.above, self.key = [0], [0], [0], [-1], [None]
        self.depth, self.h1, self.h2, self.chars = [depth], [h1], [h2], [0]
        self.n, self.conv, self.open = [0], [None], [True]

    def _node(self, above: int, turn: tuple) -> int:
        key, chars, z1, z2 = turn
        for values, value in (
            (self.low, 0), (self.high, 0), (self.below, 0), (self.above, above), (self.key, key), (self.depth, self.depth[above] + 1),
            (self.h1, self.h1[above] ^ z1), (self.h2, self.h2[above] ^ z2), (self.chars, chars), (self.n, 0), (self.conv, None), (self.open, False),
        ):
            values.append(value)
        return len(self.key) - 1

    def insert(self, sequence: list[tuple], n: int, conv: int | None, stays_open: bool) -> None:
        """``sequence``: (id, chars, z1, z2) of each turn; ``n`` conversations, ``conv`` the smallest, have it."""
        at = 0
        for turn in sequence:
            above, side, values = at, at, self.below
            at = values[side]
            while at and self.key[at] != turn[0]:
                side, values = at, self.low if turn[0] < self.key[at] else self.high
                at = values[side]
            if not at:
                at = values[side] = self._node(above, turn)
        self.n[at] += n
        self.conv[at] = conv if self.conv[at] is None else self.conv[at] if conv is None else min(self.conv[at], conv)
        self.open[at] |= stays_open

    def insert_sorted(self, rows: list[tuple]) -> None:
        """Rows (sequence, n, conv, stays_open) in the order of their ids, the median of every range first."""
        todo = [(0, len(rows))]
        while todo:
            a, b = todo.pop()
            if a < b:
                middle = (a + b) // 2
                self.insert(*rows[middle])
                todo += [(a, middle), (middle + 1, b)]

    def traversal(self) -> list[int]:
        """All nodes, each after the node above it."""
        out, todo = [0], [self.below[0]]
        while todo:
            at = todo.pop()
            if at:
                out.append(at)
                todo += [self.low[at], self.high[at], self.below[at]]
        return out

    def summed(self) -> Iterator[tuple]:
        """(h1, h2, p1, p2, open, depth, n, conv, parent_conv, chars, children, leaves, saved) of every node.

        A closed node's sums are those of its whole subtree. An open node's hold its closed children only, and its
        own part is left to be added once all of it is known.
        """
        size = len(self.key)
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        order = self.traversal()
        for at in reversed(order):
            if not self.open[at]:
                leaves[at] += children[at] == 0
                saved[at] += (self.n[at] - 1) * self.chars[at]
            above = self.above[at]
            if above < 0:
                continue
            self.n[above] += self.n[at]
            if self.conv[at] is not None:
                self.conv[above] = self.conv[at] if self.conv[above] is None else min(self.conv[above], self.conv[at])
            if self.open[at]:
                self.open[above] = True
            else:
                children[above] += 1
                leaves[above] += leaves[at]
                saved[above] += saved[at]
        for at in order:
            above = self.above[at]
            p1, p2 = (self.h1[above], self.h2[above]) if above >= 0 else (None, None)
            known = None if above < 0 or self.open[above] else self.conv[above]
            yield self.h1[at], self.h2[at], p1, p2, self.open[at], self.depth[at], self.n[at], self.conv[at], known, self.chars[at], children[at], leaves[at], saved[at]


def _shard_rows(rows: list[tuple]) -> Iterator[tuple]:
    """Nodes of one shard: neighbouring rows (level, s1, s2, turns, goes_on, n, conv)."""
    a = 0
    while a < len(rows):
        b = a
        while b < len(rows) and rows[b][:3] == rows[a][:3]:
            b += 1
        level, s1, s2 = rows[a][:3]
        tree = SearchTree(level * SEGMENT, s1, s2)
        tree.insert_sorted([(turns, n, conv, goes_on or k in (0, len(rows) - 1)) for k, (_, _, _, turns, goes_on, n, conv) in enumerate(rows[a:b], a)])
        for node in tree.summed():
            if level and node[2] is None:  # the members of a segment's root are known where the segment before ends
                node = (*node[:6], 0, None, *node[8:])
            yield level, *node
        a = b


def _trees(sequences: DataFrame) -> DataFrame:
    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["level", "s1", "s2", "ids", "turns", "goes_on", "n", "conv"]
    fields = [(x.split()[0], pa.bool_() if x.endswith("boolean") else pa.int64()) for x in _PART.split(", ")]

    def table(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = list(_shard_rows(rows))
        for k in range(0, len(found), 20_000):
            values = zip(*found[k : k + 20_000], strict=True)
            yield pa.RecordBatch.from_pydict({name: pa.array(v, kind) for (name, kind), v in zip(fields, values, strict=True)})

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for level, s1, s2, ids, rest, goes_on, n, conv in batches(rows, columns):
            held.append((level, s1, s2, [(i, x["chars"], x["z1"], x["z2"]) for i, x in zip(ids, rest, strict=True)], goes_on, n, conv))
            turns += len(ids) + 1
            if turns >= SHARD_TURNS:
                yield from table(held)
                held, turns = [], 0
        yield from table(held)

    order = ["level", "s1", "s2", "ids", "goes_on"]
    return sequences.select(columns).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, _PART)


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, digest, chars) of all rebuilt turns, and (conv_id, length) of all conversations."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumns({"digest": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")), "chars": F.length("text").cast("bigint"), "tie": F.monotonically_increasing_id()})
    numbered = number_rows(rows, F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("tie"), name="place")
    numbered = numbered.select("conv_id", "place", "digest", "chars")
    convs = numbered.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % TAKEN).withColumn("leader", F.col("conv_id") - F.col("conv_id") % PERIOD)
    of_leader = convs.select(F.col("conv_id").alias("leader"), F.col("own").alias("there"))
    convs = convs.join(of_leader, "leader", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = written(convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    placed = numbered.join(convs.select("conv_id", "first", "h", "taken"), "conv_id").withColumn("place", F.col("place") - F.col("first"))
    own = placed.filter(F.col("place") >= F.col("h")).withColumn("at", F.col("place") - F.col("h") + F.col("taken"))
    opening = placed.filter(F.col("place") < TAKEN - 1).select(F.col("conv_id").alias("leader"), F.col("place").alias("at"), "digest", "chars")
    lent = opening.join(convs.select("conv_id", "leader", "taken"), "leader").filter(F.col("at") < F.col("taken"))
    columns = ["conv_id", "at", "digest", "chars"]
    return own.select(columns).unionByName(lent.select(columns)), convs.select("conv_id", "length")


def _key(depth: str | Column, h1: str, h2: str) -> Column:
    depth = F.col(depth) if isinstance(depth, str) else depth
    return F.when(F.col(h1).isNotNull(), F.concat_ws(":", depth.cast("string"), F.hex(h1), F.hex(h2)))


def _merged(parts: DataFrame) -> DataFrame:
    """Open nodes as whole nodes: key, up, depth, conv, n, children, leaves, saved."""
    nodes = parts.filter("open").groupBy("depth", "h1", "h2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")],
    )
    nodes = nodes.withColumns({"key": _key("depth", "h1", "h2"), "up": _key(F.col("depth") - 1, "p1", "p2")})
    nodes = written(nodes.drop("h1", "h2", "p1", "p2"), "open-nodes")
    more = nodes.filter("up is not null").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("further"))
    nodes = nodes.join(more, "key", "left").withColumn("children", F.col("children") + F.coalesce("further", F.lit(0)))
    leaf = (F.col("children") == 0).cast("bigint")
    nodes = nodes.withColumns({"leaves": F.col("leaves") + leaf, "saved": F.col("saved") + (F.col("n") - 1) * F.col("chars")}).drop("further", "chars")
    state = written(nodes.withColumn("jump", F.col("up")), "open-nodes")
    while state.filter("jump is not null").limit(1).count():
        given = state.filter("jump is not null").groupBy(F.col("jump").alias("key")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = state.select(F.col("key").alias("jump"), F.col("jump").alias("next"))
        step = state.join(given, "key", "left").join(above, "jump", "left")
        step = step.withColumns({"leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)), "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)), "jump": F.col("next")})
        state = written(step.drop("more_leaves", "more_saved", "next"), "open-nodes")
    return state.drop("jump")


def _ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): pieces of sorted ids are made by range, then hashed in order."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "key string, conv_id bigint, piece string"

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out():
            return pa.RecordBatch.from_pydict({"key": pa.array([key]), "conv_id": pa.array([held[0]], pa.int64()), "piece": pa.array([",".join(map(str, held))])})

        for one, conv in batches(rows, ["key", "conv_id"]):
            if held and (one != key or len(held) >= PACK):
                yield out()
                held = []
            key = one
            held.append(conv)
        if held:
            yield out()

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for one, piece in batches(rows, ["key", "piece"]):
            if one == key:
                sha.update(b"," + piece.encode())
                continue
            if sha:
                yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [sha.hexdigest()]})
            key, sha = one, hashlib.sha256(piece.encode())
        if sha:
            yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [sha.hexdigest()]})

    packed = ends.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pack, schema)
    return packed.repartition(parts, "key").sortWithinPartitions("key", "conv_id").select("key", "piece").mapInArrow(hashed, "key string, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    Turns are taken by turn number (NULL first), then role and text; a NULL role or text is empty. Rows that repeat
    are turns each. Rows without conv_id belong to no conversation and are left out. Conversation c is rebuilt from
    the first turns of the one that its hundred starts with and its own later ones. A node is a distinct sequence of first
    turns, the root the empty one; without conversations there is none. ``conv_id`` is its smallest member.

    A conversation of any length is cut into segments, and the numbering is by ranges, so a conversation, a
    first turn or a group of copies may hold any part of the rows: a task holds one shard of bounded size. The ids of
    conversations that end at one node stream through one hash, in pieces of ``PACK``.
    """
    rebuilt, convs = _rebuilt(turns)
    rebuilt = written(rebuilt, "rebuilt")
    distinct = rebuilt.groupBy("digest").agg(F.max("chars").alias("chars"))
    dictionary = number_rows(distinct, F.asc("digest"), name="id").select("digest", "id")
    coded = rebuilt.join(dictionary, "digest").withColumns({f"z{k}": F.xxhash64("at", "id", F.lit(k)) for k in (1, 2)})
    told = F.sort_array(F.collect_list(F.struct("at", "id", "chars", "z1", "z2")))
    segments = coded.groupBy("conv_id", F.floor(F.col("at") / SEGMENT).alias("level")).agg(told.alias("told"), F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"))
    segments = written(segments, "segments")
    before = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    several = convs.filter(F.col("length") > SEGMENT).select("conv_id")
    starts = segments.select("conv_id", "level", "x1", "x2").join(several, "conv_id", "left_semi")
    starts = starts.select("conv_id", "level", *[F.bit_xor(f"x{k}").over(before).alias(f"s{k}") for k in (1, 2)])
    zero = F.lit(0).cast("bigint")
    rows = segments.join(starts, ["conv_id", "level"], "left").join(convs, "conv_id").select(
        "conv_id",
        "level",
        *[F.coalesce(f"s{k}", zero).alias(f"s{k}") for k in (1, 2)],
        F.transform("told", lambda x: x["id"]).alias("ids"),
        F.transform("told", lambda x: F.struct(x["chars"].alias("chars"), x["z1"].alias("z1"), x["z2"].alias("z2"))).alias("turns"),
        ((F.col("level") + 1) * SEGMENT < F.col("length")).alias("goes_on"),
    )
    turn = "array<struct<chars: bigint, z1: bigint, z2: bigint>>"
    none = convs.filter(F.col("length") == 0).select(
        "conv_id", zero.alias("level"), zero.alias("s1"), zero.alias("s2"), F.array().cast("array<bigint>").alias("ids"), F.array().cast(turn).alias("turns"), F.lit(False).alias("goes_on")
    )
    same = ["level", "s1", "s2", "ids", "goes_on"]
    sequences = rows.unionByName(none).groupBy(same).agg(F.first("turns").alias("turns"), F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    nodes = written(_trees(sequences), "nodes")
    merged = _merged(nodes)
    whole = nodes.filter("not open").select(
        _key("depth", "h1", "h2").alias("key"), F.when(F.col("parent_conv").isNull(), _key(F.col("depth") - 1, "p1", "p2")).alias("up"), "parent_conv", "depth", "conv", "n", "children", "leaves", "saved"
    )
    every = whole.unionByName(merged, allowMissingColumns=True)
    parents = merged.select(F.col("key").alias("up"), F.col("conv").alias("merged_parent"))
    last = segments.groupBy("conv_id").agg(F.bit_xor("x1").alias("e1"), F.bit_xor("x2").alias("e2"))
    ends = convs.join(last, "conv_id", "left").withColumns({"e1": F.coalesce("e1", zero), "e2": F.coalesce("e2", zero)}).select(_key("length", "e1", "e2").alias("key"), "conv_id")
    out = every.join(parents, "up", "left").join(_ends(ends), "key", "left")
    return out.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.coalesce("parent_conv", "merged_parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
