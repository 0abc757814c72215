"""Repeated passages by a suffix array that the difference-cover algorithm builds with sorts and joins.

1. Every string of ``LENGTH`` bytes has an anchor, the 32 bytes in it with the smallest hash. Neighbouring strings with
   the same anchor are one run. Of runs with the same bytes the first stays, the others are repeats as a whole; a run
   whose anchor stands nowhere else is no repeat. Both lose nothing and leave little to be sorted: runs
   that share an anchor and differ around it, at the edges of passages and at changed words.
2. The runs of one anchor, if they are not very many, are compared string by string where they meet. For an anchor with
   more surroundings than a task should hold, the stretches of text that its runs cover become one string, a sentinel
   behind each, in the order of documents.
3. That string is sorted. Difference cover modulo 3: triples at places 1 and 2 modulo 3 are sorted and named by the number of smaller ones;
   where names repeat, the names are a string of two thirds the length, whose suffixes are ranked the same way. The
   remaining suffixes are merged by their first symbols and the rank of the sampled suffix behind these.
   Characters are 8 bytes wide at first, and names that stand for ``LENGTH`` bytes need no further recursion.
4. In the order of suffixes, neighbours with the same first ``LENGTH`` bytes form classes. All but the first place of a
   class repeat it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, mix
from tidemark.session import written

LENGTH = 100  # bytes of a string that counts as repeated
GRAM = 32  # bytes of an anchor
SLICE = 1 << 22  # strings that are looked at together; longer texts are taken in slices
CHARACTER = 8  # bytes of a symbol of the first triples
SURROUNDINGS = 1 << 16  # runs of one anchor that a task compares; of an anchor with more, all strings go to the array

_SIGNS = np.random.default_rng(20240811).integers(0, 2**64, (2, 256), dtype=np.uint64)
_STEPS = (np.random.default_rng(20240812).integers(0, 2**63, (2, 8), dtype=np.uint64) << np.uint64(1)) + np.uint64(1)
_RUN = "kind int, gram bigint, context bigint, no_id boolean, doc_id bigint, hash bigint, uid bigint, first bigint, last bigint"
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _table(schema: str, columns) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_pydict({name: pa.array(values, _ARROW[kind]) for (name, kind), values in zip(fields, columns, strict=True)})


def _window_hashes(raw: np.ndarray, which: int, size: int) -> np.ndarray:
    """64-bit hashes of all strings of ``size`` bytes, put together from those of powers of two."""
    power, out, at = _SIGNS[which][raw], None, 0
    for k in range(size.bit_length()):
        width = 1 << k
        if size & width:
            out = power if out is None else out[: len(power) - at] * _STEPS[which, 7] + power[at : at + len(out)]
            at += width
        if 2 * width <= size:
            power = power[: len(power) - width] * _STEPS[which, k % 7] + power[width:]
    return mix(out[: len(raw) - size + 1] + np.uint64(size))


def runs(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last string of every run of several texts laid end to end, the anchor's hash and that of all its bytes.

    ``ends``: where the text that each byte belongs to ends. Strings that would reach into the next text are left out.
    """
    none = np.empty(0, dtype=np.int64)
    if len(raw) < LENGTH:
        return none, none, none, none
    grams = _window_hashes(raw, 0, GRAM)
    smallest = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)  # the leftmost, if equal
    width, size = LENGTH - GRAM + 1, 1
    while 2 * size <= width:
        smallest = np.minimum(smallest[: len(smallest) - size], smallest[size:])
        size *= 2
    smallest = np.minimum(smallest[: len(raw) - LENGTH + 1], smallest[width - size : width - size + len(raw) - LENGTH + 1])
    valid = np.flatnonzero(ends[: len(smallest)] - np.arange(len(smallest)) >= LENGTH)
    if not len(valid):
        return none, none, none, none
    anchor = (smallest[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.append(0, np.flatnonzero((anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)) + 1)
    first, last = valid[starts], valid[np.append(starts[1:], len(valid)) - 1]
    strings = _window_hashes(raw, 1, LENGTH)  # the first and the last string of a run have all its bytes
    context = mix(strings[first] * _STEPS[1, 0] + strings[last] * _STEPS[1, 1] + (last - first).astype(np.uint64))
    return first, last, grams[anchor[starts]].view(np.int64), context.view(np.int64)


def _slices(rows: Iterator[tuple]) -> Iterator[tuple[list[tuple], np.ndarray, list[int]]]:
    """Parts of texts that are looked at together: (uid, doc_id, hash, offset), their bytes, where each one ends."""
    heads, parts, size = [], [], 0
    for uid, doc_id, text in rows:
        content = (text or "").encode()
        for at in range(0, max(len(content) - LENGTH + 1, 0), SLICE):
            part = content[at : at + SLICE + LENGTH - 1]
            heads.append((uid, doc_id, xxhash.xxh3_64_intdigest(content) - 2**63, at))
            parts.append(part)
            size += len(part)
            if size >= SLICE:
                yield heads, np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([len(p) for p in parts]).tolist()
                heads, parts, size = [], [], 0
    if heads:
        yield heads, np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([len(p) for p in parts]).tolist()


def _survey(docs: DataFrame) -> DataFrame:
    """Runs (kind 0), the first of equal ones of a slice; the others are repeats (kind 1), dealt evenly."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for heads, raw, edges in _slices(batches(rows, ["uid", "doc_id", "text"])):
            ends = np.array(edges)
            sizes = np.diff(ends, prepend=0)
            first, last, gram, context = runs(raw, np.repeat(ends, sizes))
            part = np.searchsorted(ends, first, side="right")
            order = sorted(range(len(heads)), key=lambda k: (heads[k][1] is None, heads[k][1] or 0, heads[k][2], heads[k][0], heads[k][3]))  # noqa: B023
            place = np.empty(len(heads), dtype=np.int64)
            place[order] = np.arange(len(heads))
            by = np.lexsort((first, place[part], context, gram))
            kind = np.zeros(len(first), dtype=np.int32)
            kind[by[1:]] = (gram[by[1:]] == gram[by[:-1]]) & (context[by[1:]] == context[by[:-1]])
            shift = np.array([h[3] for h in heads]) - (ends - sizes)
            gram = np.where(kind == 1, mix((context + first).view(np.uint64)).view(np.int64), gram)
            doc_ids = np.array([h[1] or 0 for h in heads])[part]
            no_id, hashes, uids = (np.array(x)[part] for x in ([h[1] is None for h in heads], [h[2] for h in heads], [h[0] for h in heads]))
            columns = (kind, gram, context, no_id, doc_ids, hashes, uids, first + shift[part], last + shift[part])
            for a in range(0, len(first), 50_000):
                yield _table(_RUN, [c[a : a + 50_000] for c in columns])

    return docs.mapInArrow(run, _RUN)


def _sieve(found: DataFrame) -> DataFrame:
    """Repeats (kind 1), and of runs that share an anchor with unlike ones the first of each (kind 0)."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["kind", "gram", "context", "no_id", "doc_id", "hash", "uid", "first"]
    names = [x.split()[0] for x in _RUN.split(", ")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting = None, None  # of the row before; the only context of a gram so far
        for batch in rows:
            kind, gram, context = (batch.column(c).to_numpy() for c in ("kind", "gram", "context"))
            if not len(kind):
                continue
            before = [np.append(x, y[:-1]) for x, y in zip(key or (-1, 0, 0), (kind, gram, context), strict=True)]
            same_gram = (kind == before[0]) & (gram == before[1]) & (kind == 0)
            same = same_gram & (context == before[2])
            out = np.where((kind == 1) | same, 1, 0)
            # A context that is not its gram's first stays, and so does the first one, once a second is met.
            stays = (kind == 1) | same | same_gram
            starts = np.flatnonzero((kind == 0) & ~same_gram)  # rows that begin a gram
            second = np.flatnonzero(same_gram & ~same)
            owner = np.searchsorted(starts, second, side="right") - 1
            stays[starts[np.unique(owner[owner >= 0])]] = True
            if waiting is not None and (owner < 0).any():
                yield waiting
                waiting = None
            if len(starts):
                last = int(starts[-1])
                waiting = None if stays[last] else batch.slice(last, 1)
            key = (kind[-1], gram[-1], context[-1])
            rows_ = batch.set_column(0, "kind", pa.array(out, pa.int32()))
            yield rows_.filter(pa.array(stays))

    dealt = found.select(names).repartition(parts, "gram").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, _RUN).drop("context")


def _with_content(judged: DataFrame, docs: DataFrame) -> DataFrame:
    """The runs with the bytes they cover."""
    told = judged.groupBy("uid").agg(F.min("no_id").alias("no_id"), F.min("doc_id").alias("known"), F.min("hash").alias("hash"), F.collect_list(F.struct("gram", "first", "last")).alias("runs"))
    schema = "gram bigint, no_id boolean, doc_id bigint, hash bigint, uid bigint, first bigint, last bigint, content binary"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for no_id, doc_id, hash_, uid, text, found in batches(rows, ["no_id", "known", "hash", "uid", "text", "runs"]):
            raw = text.encode()
            for r in found:
                out.append((r["gram"], no_id, doc_id, hash_, uid, r["first"], r["last"], raw[r["first"] : r["last"] + LENGTH]))
            if len(out) >= 5_000:
                yield _table(schema, zip(*out, strict=True))
                out = []
        if out:
            yield _table(schema, zip(*out, strict=True))

    return docs.select("uid", "text").join(told, "uid").mapInArrow(run, schema)


def repeats_within(anchors: list[int], uids: list[int], firsts: list[int], contents: list[bytes]) -> tuple[np.ndarray, ...]:
    """(uid, first, last) of strings that an earlier run of the same anchor has too; runs come in the order of documents."""
    raw = np.frombuffer(b"".join(contents), dtype=np.uint8)
    size = np.array(list(map(len, contents)))
    ends = np.cumsum(size)
    count = size - LENGTH + 1
    which = np.repeat(np.arange(len(size)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = inside + (ends - size)[which]
    one, two = (_window_hashes(raw, k, LENGTH)[at] for k in (0, 1))
    anchor, uid, place = np.array(anchors)[which], np.array(uids)[which], np.array(firsts)[which] + inside
    by = np.lexsort((np.arange(len(at)), two, one, anchor))
    again = np.zeros(len(at), dtype=bool)
    again[by[1:]] = (anchor[by[1:]] == anchor[by[:-1]]) & (one[by[1:]] == one[by[:-1]]) & (two[by[1:]] == two[by[:-1]])
    uid, place, which = uid[again], place[again], which[again]
    if not len(uid):
        return uid, place, place
    start = np.append(True, (which[1:] != which[:-1]) | (place[1:] != place[:-1] + 1))
    return uid[start], place[start], place[np.append(np.flatnonzero(start)[1:] - 1, len(place) - 1)]


def _compared(runs_: DataFrame, surroundings: int) -> DataFrame:
    """Repeats (kind 1) among the runs of an anchor; runs of an anchor with too many surroundings go on as they are (kind 0)."""
    parts = int(runs_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["gram", "no_id", "doc_id", "hash", "uid", "first", "last", "content"]
    schema = "kind int, no_id boolean, doc_id bigint, hash bigint, uid bigint, first bigint, last bigint, content binary"
    together = 1 << 14  # runs of several anchors that are compared at once

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(some: list[tuple]) -> Iterator[pa.RecordBatch]:
            if some:
                gram, _, _, _, uid, first, _, content = zip(*some, strict=True)
                uid, first, last = repeats_within(gram, uid, first, content)
                n = len(uid)
                for a in range(0, n, 50_000):
                    m = min(n, a + 50_000) - a
                    none = [None] * m
                    yield _table(schema, ([1] * m, none, none, none, uid[a : a + m], first[a : a + m], last[a : a + m], none))

        def passed_on(some: list[tuple]) -> Iterator[pa.RecordBatch]:
            if some:
                yield _table(schema, zip(*[(0, *row[1:]) for row in some], strict=True))

        whole, own, over = [], [], False  # runs of anchors that are complete, and of the one that is being read
        for row in batches(rows, columns):
            if own and own[0][0] != row[0] or over and over[0] != row[0]:
                if over:
                    yield from passed_on(own)
                else:
                    whole += own
                own, over = [], False
                if len(whole) >= together:
                    yield from compared(whole)
                    whole = []
            own.append(row)
            if over and len(own) >= 1_000 or len(own) > surroundings:
                over = (row[0],)
                yield from passed_on(own)
                own = []
        if over:
            yield from passed_on(own)
        else:
            whole += own
        yield from compared(whole)

    dealt = runs_.repartition(parts, "gram").sortWithinPartitions("gram", "no_id", "doc_id", "hash", "uid", "first")
    return dealt.select(columns).mapInArrow(run, schema)


def _stretches(runs_: DataFrame) -> DataFrame:
    """(no_id, doc_id, hash, uid, at, content): what the runs of a document cover, overlapping ones as one stretch."""
    parts = int(runs_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "no_id boolean, doc_id bigint, hash bigint, uid bigint, at bigint, content binary"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, at, held = None, 0, b""
        for no_id, doc_id, hash_, uid, first, content in batches(rows, ["no_id", "doc_id", "hash", "uid", "first", "content"]):
            if head and head[3] == uid and first <= at + len(held):
                held += content[max(0, at + len(held) - first) :]
                continue
            if head:
                yield _table(schema, [[x] for x in (*head, at, held)])
            head, at, held = (no_id, doc_id, hash_, uid), first, content
        if head:
            yield _table(schema, [[x] for x in (*head, at, held)])

    return runs_.repartition(parts, "uid").sortWithinPartitions("uid", "first", "last").mapInArrow(run, schema)


def _laid_out(stretches: DataFrame) -> tuple[DataFrame, int]:
    """(place, uid, at, content) with the place of each stretch in the whole string, and the string's length."""
    parts = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["no_id", "doc_id", "hash", "uid", "at"]
    schema = "part int, inside bigint, uid bigint, at bigint, content binary"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, inside = TaskContext.get().partitionId(), 0
        for batch in rows:
            sizes = np.array([len(x) + 1 for x in batch.column("content").to_pylist()], dtype=np.int64)
            places = inside + np.cumsum(sizes) - sizes
            inside += int(sizes.sum())
            yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(sizes), part, np.int32)), "inside": pa.array(places), **{c: batch.column(c) for c in ("uid", "at", "content")}})

    rows = written(stretches.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, schema), "stretches")
    totals = rows.groupBy("part").agg(F.sum(F.octet_length("content") + 1).alias("size"))
    offsets = totals.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    placed = rows.join(F.broadcast(offsets), "part").select((F.col("inside") + F.col("offset")).alias("place"), "uid", "at", "content")  # a row for each partition
    return placed, totals.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def _symbols(placed: DataFrame) -> DataFrame:
    """(pos, s0, s1, t0, t1, t2) of every place: its first symbols, and a triple of wide characters."""
    schema = "pos bigint, s0 bigint, s1 bigint, t0 bigint, t1 bigint, t2 bigint"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, content in batches(rows, ["place", "content"]):
            raw = np.frombuffer(content + b"\0" * (4 * CHARACTER), dtype=np.uint8)
            n = len(content) + 1
            wide = np.lib.stride_tricks.sliding_window_view(raw, CHARACTER)
            wide = np.ascontiguousarray(wide).view(">u8").ravel().astype(np.uint64)
            wide = (wide ^ np.uint64(1 << 63)).view(np.int64)  # order of unsigned numbers
            symbol = np.append(raw[: n - 1].astype(np.int64) + 1, [0, 0])
            columns = (np.arange(n) + place, symbol[:n], symbol[1 : n + 1], wide[:n], wide[CHARACTER : n + CHARACTER], wide[2 * CHARACTER : n + 2 * CHARACTER])
            for a in range(0, n, 100_000):
                yield _table(schema, [c[a : a + 100_000] for c in columns])

    return placed.select("place", "content").mapInArrow(run, schema)


def smaller_ones(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(pos, kind, less0, less1): for every row the number of rows of kind 0 and 1 with a smaller key.

    Equal keys lie in one range partition; the partitions' totals, a row for each, are added afterwards.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "part int, pos bigint, kind int, less0 bigint, less1 bigint"

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, done, at_start = TaskContext.get().partitionId(), None, [0, 0], [0, 0]
        for batch in batches_:
            n = batch.num_rows
            if not n:
                continue
            values = [batch.column(k).to_numpy() for k in keys]
            kind = batch.column("kind").to_numpy()
            fresh = np.zeros(n, dtype=bool)
            for k, v in enumerate(values):
                fresh[1:] |= v[1:] != v[:-1]
                fresh[0] |= before is None or v[0] != before[k]
            before = [v[-1] for v in values]
            start = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            less = []
            for one in (0, 1):
                so_far = done[one] + np.cumsum(kind == one) - (kind == one)
                less.append(np.where(start < 0, at_start[one], so_far[np.maximum(start, 0)]))
                done[one] += int((kind == one).sum())
            at_start = [int(x[-1]) for x in less]
            yield _table(schema, [np.full(n, part, np.int32), batch.column("pos").to_numpy(), kind, *less])

    dealt = rows.select("pos", F.col("kind").cast("int").alias("kind"), *keys).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    counted = written(dealt.mapInArrow(run, schema), "smaller")
    totals = counted.groupBy("part").agg(*[F.sum((F.col("kind") == k).cast("bigint")).alias(f"n{k}") for k in (0, 1)])
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", *[F.coalesce(F.sum(f"n{k}").over(ahead), F.lit(0)).alias(f"n{k}") for k in (0, 1)])
    return counted.join(F.broadcast(totals), "part").select("pos", "kind", *[(F.col(f"less{k}") + F.col(f"n{k}")).alias(f"less{k}") for k in (0, 1)])


def suffix_ranks(table: DataFrame, triple: list[str], n: int, covers: int, step: int = 1, enough: int = LENGTH) -> DataFrame:
    """(pos, rank) of all ``n`` suffixes of a string: the number of smaller ones.

    ``table``: pos (0 to n - 1), s0, s1 (the symbol there and the next one) and the columns of a triple that stands for
    ``covers`` characters of the text; neighbouring symbols are ``step`` characters apart. Suffixes with the same
    first ``enough`` characters may have the same rank, or be told apart by what follows.
    """
    place = F.col("pos") % 3
    ranks = smaller_ones(table.filter(place != 0).withColumn("kind", F.lit(0)), triple).select("pos", F.col("less0").alias("rank"))
    ranks = written(ranks, "names")
    repeated = covers < enough and ranks.groupBy("rank").agg(F.count("*").alias("times")).filter("times > 1").limit(1).count()
    if repeated:
        ones = (n + 1) // 3  # places 1 modulo 3 come first, then those 2 modulo 3
        inner = F.when(place == 1, F.floor(F.col("pos") / 3)).otherwise(F.floor(F.col("pos") / 3) + ones).cast("bigint")
        string = ranks.select(inner.alias("pos"), (F.col("rank") + 1).alias("symbol"))
        told = string.select(F.explode(F.array(*[F.struct((F.col("pos") - k).alias("pos"), F.lit(k).alias("k"), "symbol") for k in range(3)])).alias("x")).select("x.*").filter("pos >= 0")
        symbols = [F.coalesce(F.max(F.when(F.col("k") == k, F.col("symbol"))), F.lit(0)).cast("bigint").alias(f"s{k}") for k in range(3)]
        inner_ranks = suffix_ranks(written(told.groupBy("pos").agg(*symbols), "string"), ["s0", "s1", "s2"], n - (n + 2) // 3, covers + 2 * 3 * step, 3 * step, enough)
        outer = F.when(F.col("pos") < ones, 3 * F.col("pos") + 1).otherwise(3 * (F.col("pos") - ones) + 2)
        ranks = inner_ranks.select(outer.cast("bigint").alias("pos"), "rank")
    # The remaining suffixes against those of either sampled place.
    added = [ranks.select("pos", F.col("rank").alias("more"))]
    for k, keys in ((1, ["s0", "behind"]), (2, ["s0", "s1", "behind"])):
        behind = ranks.select((F.col("pos") - k).alias("pos"), F.col("rank").alias("behind"))
        side = table.filter((place == 0) | (place == k)).select("pos", "s0", "s1").join(behind, "pos", "left")
        side = side.withColumns({"behind": F.coalesce("behind", F.lit(-1)), "kind": (F.col("pos") % 3 == k).cast("int")})
        counted = smaller_ones(side, keys)
        own = F.col("less1") + F.col("less0") if k == 1 else F.col("less1")  # remaining ones are counted once
        added.append(counted.select("pos", F.when(F.col("kind") == 0, own).otherwise(F.col("less0")).alias("more")))
    every = added[0].unionByName(added[1]).unionByName(added[2])
    return written(every.groupBy("pos").agg(F.sum("more").alias("rank")), "ranks")


def _strings(placed: DataFrame) -> DataFrame:
    """(pos, uid, at, d1, d2) of every whole string: its document, its place there, and 128 bits of its bytes."""
    schema = "pos bigint, uid bigint, at bigint, d1 bigint, d2 bigint"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, uid, at, content in batches(rows, ["place", "uid", "at", "content"]):
            raw = np.frombuffer(content, dtype=np.uint8)
            digests = [_window_hashes(raw, k, LENGTH).view(np.int64) for k in (0, 1)]
            n = len(raw) - LENGTH + 1
            for a in range(0, n, 100_000):
                some = np.arange(a, min(n, a + 100_000))
                yield _table(schema, [some + place, np.full(len(some), uid), some + at, digests[0][some], digests[1][some]])

    return placed.mapInArrow(run, schema)


def _repeated_strings(placed: DataFrame, ranks: DataFrame) -> DataFrame:
    """(uid, first, last) of strings that an earlier place has too: neighbours in the order of suffixes are compared."""
    spark = ranks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "part int, class bigint, pos bigint, uid bigint, at bigint, d1 bigint, d2 bigint"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in rows:
            n = batch.num_rows
            if not n:
                continue
            d1, d2 = (batch.column(c).to_numpy() for c in ("d1", "d2"))
            fresh = np.ones(n, dtype=np.int64)
            fresh[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
            fresh[0] = (d1[0], d2[0]) != last
            number = held + np.cumsum(fresh)
            last, held = (d1[-1], d2[-1]), int(number[-1])
            yield _table(schema, [np.full(n, part, np.int32), number, *(batch.column(c).to_numpy() for c in ("pos", "uid", "at")), d1, d2])

    ordered = _strings(placed).join(ranks, "pos").repartitionByRange(parts, "rank", "pos").sortWithinPartitions("rank", "pos")
    classes = written(ordered.select("pos", "uid", "at", "d1", "d2").mapInArrow(run, schema), "classes")
    digest = F.struct("d1", "d2")
    edges = classes.groupBy("part").agg(F.min_by(digest, "class").alias("head"), F.max_by(digest, "class").alias("tail"), F.max("class").alias("last"))
    joined, before = [], None
    for part, head, tail, last in sorted(map(tuple, edges.collect())):  # a row for each partition
        same = before is not None and before[0] == head
        if same:
            joined.append((part, 1, *before[1]))
        before = (tail, before[1] if same and last == 1 else (part, last))
    joined = spark.createDataFrame(joined, "part int, class bigint, to_part int, to_class bigint")
    classes = classes.join(F.broadcast(joined), ["part", "class"], "left").select(
        F.coalesce("to_part", "part").alias("part"), F.coalesce("to_class", "class").alias("class"), "pos", "uid", "at"
    )
    earliest = classes.groupBy("part", "class").agg(F.min("pos").alias("earliest"), F.count("*").alias("times")).filter("times > 1")
    return classes.join(earliest, ["part", "class"]).filter(F.col("pos") > F.col("earliest")).select("uid", F.col("at").alias("first"), F.col("at").alias("last"))


def _cut_out(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for doc_id, text, found in batches(rows, ["doc_id", "text", "runs"]):
            raw = (text or "").encode()
            spans = []
            if found:
                begins = np.array([r["first"] for r in found])
                ends = np.array([r["last"] for r in found]) + LENGTH
                order = np.argsort(begins, kind="stable")
                begins, ends = begins[order], np.maximum.accumulate(ends[order])
                new = np.append(True, begins[1:] > ends[:-1])
                spans = list(zip(begins[new].tolist(), ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)].tolist(), strict=True))
            sha, at = hashlib.sha256(), 0
            for begin, end in spans:
                sha.update(raw[at:begin])
                at = end
            sha.update(raw[at:])
            out.append((doc_id, len(raw), sum(b - a for a, b in spans), len(spans), sha.hexdigest()))
            if len(out) >= 1_000:
                yield _table(schema, zip(*out, strict=True))
                out = []
        if out:
            yield _table(schema, zip(*out, strict=True))

    told = repeats.groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    return docs.join(told, "uid", "left").select("doc_id", "text", "runs").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", surroundings: int = SURROUNDINGS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document with a smaller id, or
    earlier in the same one. Strings are judged on the input; overlapping ones count. Bytes are those of UTF-8.

    NULL texts are empty. Rows without id come after all others. Rows that share an id are documents of their own, in
    the order of a hash of their text, so of repeated rows one keeps its bytes. Empty table: no rows. Other columns
    are not looked at.

    Memory: a task holds a slice of 4 MB of text, ``surroundings`` runs of one anchor (11 MB), or one document where its
    spans are cut out; sorted rows are streamed. The driver sees a few numbers for each partition.
    ``surroundings=0`` leaves all that the sieve could not decide to the suffix array; results are the same.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sieved = written(_sieve(_survey(rows)), "sieved")
    compared = written(_compared(_with_content(sieved.filter("kind = 0"), rows), surroundings), "compared")
    repeats = sieved.filter("kind = 1").select("uid", "first", "last").unionByName(compared.filter("kind = 1").select("uid", "first", "last"))
    placed, n = _laid_out(_stretches(compared.filter("kind = 0")))
    if n:
        symbols = written(_symbols(placed), "symbols")
        ranks = suffix_ranks(symbols, ["t0", "t1", "t2"], n, 3 * CHARACTER)
        repeats = repeats.unionByName(written(_repeated_strings(placed, ranks), "repeats"))
    return _cut_out(rows, repeats)
