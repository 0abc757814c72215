"""Alignment of two tokenizers over the same bytes: groups of tokens between the ends that both have.

1. Byte-level and piece vocabularies never join a blank or line end to the character before it, so texts are cut
   there into units; a unit's tokens, groups and links are found once and remembered.
2. A very long text is cut into byte ranges, whatever lies at their edges. A range owns the tokens that end in
   it and becomes a fragment: an open prefix up to the first common end, closed groups, and an open suffix.
   Fragments form a monoid: the suffix of the left one and the prefix of the right one close one group. They are
   composed along a tree, FAN at a time, by Spark tasks that hold open parts only.
3. Counts of linked ids are summed over the corpus per block of documents, which has a dictionary of its units and
   pairs, and go back to the blocks by a join on the pair.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches
from tidemark.session import written

RANGE = 1 << 16  # bytes of a very long text that one fragment stands for
LONG = 1 << 16  # characters from which a text is cut into ranges
SPAN = 1 << 12  # a range does not end inside a unit longer than this, so no unit is encoded for many ranges
FAN = 8  # fragments composed at a time
BLOCK_CHARS = 1 << 21  # text of the documents that share one dictionary of pairs
BLOCK_ROWS = 1 << 14
MEMO_UNITS = 300_000  # units a task remembers from one block to the next; beyond, the half met most stays
PAIR_BITS = 24  # of a pair of ids, the lower bits are the second tokenizer's

_ROW = "kind int, block bigint, uid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, idx binary, ns binary, pair bigint, n bigint"
_PIECE = "uid bigint, k bigint, sub int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, closed string, pairs binary"
_FRAGMENT = "uid bigint, k bigint, cut boolean, close bigint, pa binary, pb binary, sa binary, sb binary"


def _letters() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and what is known of units: codes, sizes, groups as text, links as pairs of ids."""

    def __init__(self, json_vocabulary: bytes, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(json_vocabulary)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = _letters()
        self.a_bytes = [bytes(letters.get(c, 63) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        parts = json.loads(json_vocabulary)
        before = parts.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not parts.get("normalizer")
        plain = plain and all(t["special"] and not t["lstrip"] and not t["rstrip"] for t in parts["added_tokens"])
        self.a_text, self.b_text = list(map(str, range(len(self.a_bytes)))), list(map(str, range(len(self.b_bytes))))
        self.a_sizes, self.b_sizes = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        starts_only = not any("\n" in p or "▁" in p.lstrip("▁") for p in pieces)
        verbatim = "".join(self.b.id_to_piece(i) for i in self.b.encode(" ﬁ  x ")) == "▁▁ﬁ▁▁x▁"  # nothing normalised or trimmed
        self.cut = re.compile(r"(?<=\S)(?=[ \n])") if plain and starts_only and verbatim else None
        # With a token for every byte on both sides, nothing but the model's sign for a blank comes back changed.
        self.lossless = self.cut is not None and set(letters.values()) <= {x[0] for x in self.a_bytes if len(x) == 1} and sum(map(self.b.is_byte, range(len(pieces)))) == 256
        self.blank = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = array("q")  # four numbers for each unit: tokens of both sides, groups, links; -1 where bytes differ
        self.links = array("q")  # of all units, one after the other
        self.starts = array("q", [0])

    def keep(self, times: np.ndarray, most: int) -> None:
        """Forget the units met least; ``times`` tells how often each was met."""
        stay = np.flatnonzero(times >= 2)
        stay = np.sort(stay[np.argsort(-times[stay], kind="stable")[:most]])
        units = list(self.codes)  # in the order of their codes
        groups, sizes, links, starts = self.groups, np.array(self.sizes).reshape(-1, 4)[stay], np.array(self.links), np.array(self.starts)
        n = sizes[:, 3].clip(0)
        self.codes = {units[c]: k for k, c in enumerate(stay.tolist())}
        self.groups = [groups[c] for c in stay.tolist()]
        self.sizes = array("q", sizes.ravel().tolist())
        self.links = array("q", links[np.arange(n.sum()) + np.repeat(starts[stay] - np.cumsum(n) + n, n)].tolist())
        self.starts = array("q", [0, *np.cumsum(n).tolist()])

    def units(self, text: str) -> list[str]:
        return self.cut.split(" " + text) if self.cut else [" " + text]

    def encode(self, units: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Token ids of both sides; None where the bytes of either differ from the unit."""
        own = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        others = self.b.encode([u.removeprefix(" ") for u in units], num_threads=1)
        out = []
        for unit, x, y in zip(units, own, others, strict=True):
            if unit == " ":
                y = [self.blank]
            elif unit[0] != " ":  # the blank that the model puts in front
                y = y[1:]
            if self.lossless:
                same = "▁" not in unit
            else:
                same = b"".join(map(self.a_bytes.__getitem__, x)) == unit.encode() == b"".join(map(self.b_bytes.__getitem__, y))
            out.append((x, y) if same else None)
        return out

    def steps(self, x: list[int], y: list[int]) -> tuple[str, list[int], int]:
        """The groups as text, the links in order, and the number of groups of two sequences over the same bytes."""
        text_a, text_b, of_a, of_b = self.a_text, self.b_text, self.a_sizes, self.b_sizes
        one, other = x[0], y[0]
        links, groups, left, right = [one << PAIR_BITS | other], [], text_a[one], text_b[other]
        i, j, ahead = 0, 0, of_a[one] - of_b[other]  # bytes that A's token ends behind B's
        while True:
            if ahead == 0:
                groups.append(left + "|" + right)
                i += 1
                j += 1
                if i == len(x):
                    return ";".join(groups), links, len(groups)
                one, other = x[i], y[j]
                left, right, ahead = text_a[one], text_b[other], of_a[one] - of_b[other]
            elif ahead < 0:
                i += 1
                one = x[i]
                left += "," + text_a[one]
                ahead += of_a[one]
            else:
                j += 1
                other = y[j]
                right += "," + text_b[other]
                ahead -= of_b[other]
            links.append(one << PAIR_BITS | other)

    def codes_of(self, units: list[str]) -> list[int]:
        fresh = list(set(units).difference(self.codes))
        if fresh:
            for unit, both in zip(fresh, self.encode(fresh), strict=True):
                self.codes[unit] = len(self.groups)
                groups, links, n = self.steps(*both) if both else ("", [], 0)
                self.sizes.extend((len(both[0]), len(both[1]), n, len(links)) if both else (-1, -1, -1, -1))
                self.groups.append(groups)
                self.links.extend(links)
                self.starts.append(len(self.links))
        return list(map(self.codes.__getitem__, units))

    def size(self, code: int) -> list[int]:
        return self.sizes[4 * code : 4 * code + 4].tolist()

    def links_of(self, code: int) -> list[int]:
        return self.links[self.starts[code] : self.starts[code + 1]].tolist()


_ready: dict[bytes, Aligner] = {}


def _aligner(vocabularies) -> Aligner:
    """A worker process builds the tokenizers once for all its tasks."""
    key = vocabularies.value[2]
    if key not in _ready:
        _ready.clear()
        _ready[key] = Aligner(*vocabularies.value[:2])
    return _ready[key]


class _Blocks:
    """Numbers the blocks of a task. A block's rows: its pairs (kind 0), the links of its units (1), and its documents (2)."""

    def __init__(self, stage: int):
        self.next = stage << 60 | TaskContext.get().partitionId() << 30

    def rows(self, heads: list[tuple], units: list[np.ndarray], times: list[np.ndarray], links: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``heads``: (uid, doc_id, n_a, n_b, n_groups, n_links, sha), with the numbers of their units and how often each is met.

        ``links``: those of unit 0, 1, ..., one after the other, ``sizes`` of each.
        """
        self.next += 1
        known, at = np.unique(links, return_inverse=True)
        often = np.bincount(np.concatenate(units), weights=np.concatenate(times), minlength=len(sizes)) if units else np.zeros(len(sizes))
        counts = np.bincount(at, weights=np.repeat(often, sizes), minlength=len(known)).astype(np.int64)
        fields = [x.split() for x in _ROW.split(", ")]
        for k in range(0, len(known), 100_000):
            some = known[k : k + 100_000]
            given = {"kind": np.zeros(len(some), np.int32), "block": np.full(len(some), self.next), "pair": some, "n": counts[k : k + 100_000]}
            yield pa.RecordBatch.from_pydict({name: pa.array(given[name]) if name in given else pa.nulls(len(some), _ARROW[kind]) for name, kind in fields})
        at, sizes, edges = at.astype(np.int32), sizes.astype(np.int32), np.append(0, np.cumsum(sizes))
        for k in range(0, len(sizes), 100_000):
            last = min(len(sizes), k + 100_000)
            yield _rows(_ROW, [(1, self.next, *[None] * 7, at[edges[k] : edges[last]].tobytes(), sizes[k:last].tobytes(), k, None)])
        told = [(2, self.next, *head, u.astype(np.int32).tobytes(), t.astype(np.int32).tobytes(), None, None) for head, u, t in zip(heads, units, times, strict=True)]
        for k in range(0, len(told), 2_000):
            yield _rows(_ROW, told[k : k + 2_000])


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_pydict({name: pa.array(values, _ARROW[kind]) for (name, kind), values in zip(fields, columns, strict=True)})


def _block_of(aligner: Aligner, blocks: _Blocks, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Block rows of (uid, doc_id, codes of the units); no units: no tokens."""
    sizes = np.array(aligner.sizes, dtype=np.int64).reshape(-1, 4)
    links, starts = np.array(aligner.links, dtype=np.int64), np.array(aligner.starts, dtype=np.int64)
    heads, some, often, none = [], [], [], np.empty(0, np.int64)
    for uid, doc_id, codes in held:
        distinct, times = np.unique(np.array(codes, dtype=np.int64), return_counts=True)
        if not len(distinct) or sizes[distinct, 0].min() < 0:
            heads.append((uid, doc_id, 0, 0, 0, 0, ""))
            distinct = times = none
        else:
            told = hashlib.sha256(";".join(map(aligner.groups.__getitem__, codes)).encode()).hexdigest()
            heads.append((uid, doc_id, *(times @ sizes[distinct]).tolist(), told))
        some.append(distinct)
        often.append(times)
    used = np.zeros(len(sizes), dtype=bool)
    for one in some:
        used[one] = True
    number, used = np.cumsum(used) - 1, np.flatnonzero(used)
    n = sizes[used, 3]
    at = np.arange(n.sum()) + np.repeat(starts[used] - np.cumsum(n) + n, n)
    yield from blocks.rows(heads, [number[x] for x in some], often, links[at], n)


def _align_texts(docs: DataFrame, vocabularies) -> DataFrame:
    """Block rows of whole texts; a text whose bytes differ, or that is empty, has no tokens and an empty column."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, blocks, held, chars, met = _aligner(vocabularies), _Blocks(0), [], 0, np.empty(0, np.int64)
        for uid, doc_id, text in batches(rows, ["uid", "doc_id", "text"]):
            held.append((uid, doc_id, array("i", aligner.codes_of(aligner.units(text)) if text else [])))
            chars += len(text or "")
            if chars >= BLOCK_CHARS or len(held) >= BLOCK_ROWS or len(aligner.groups) > 2 * MEMO_UNITS:
                yield from _block_of(aligner, blocks, held)
                met = np.append(met, np.zeros(len(aligner.groups) - len(met), np.int64))
                met += np.bincount(np.concatenate([np.frombuffer(codes, np.int32) for _, _, codes in held]), minlength=len(met))
                held, chars = [], 0
                if len(aligner.groups) > MEMO_UNITS:
                    aligner.keep(met, MEMO_UNITS // 2)
                    met = np.empty(0, np.int64)
        if held:
            yield from _block_of(aligner, blocks, held)

    return docs.mapInArrow(run, _ROW)


def _ranges(docs: DataFrame, vocabularies) -> DataFrame:
    """(uid, k, begin, end, at, text): byte ranges of a blank and the text, with the units that reach into them."""
    schema = "uid bigint, k bigint, begin bigint, end bigint, at bigint, text string"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabularies)
        for uid, text in batches(rows, ["uid", "text"]):
            full = " " + text
            raw = full.encode()
            starts = np.flatnonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)  # of the characters
            cuts = [m.start() for m in aligner.cut.finditer(full)] if aligner.cut else []
            cuts = np.append(np.append(0, starts[cuts] if cuts else []), len(raw)).astype(np.int64)
            edges = [0]
            for edge in range(RANGE, len(raw), RANGE):
                after = int(np.searchsorted(cuts, edge))
                if cuts[after] - cuts[after - 1] > SPAN:
                    edge = int(cuts[after])
                if edges[-1] < edge < len(raw):
                    edges.append(edge)
            edges.append(len(raw))
            for k, (begin, end) in enumerate(zip(edges, edges[1:], strict=False)):
                low = int(cuts[np.searchsorted(cuts, begin, side="right") - 1])
                high = int(cuts[np.searchsorted(cuts, end)])
                yield _rows(schema, [(uid, k, begin, end, low, raw[low:high].decode())])

    return docs.mapInArrow(run, schema)


def _binary(ids: list[int]) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


def _ids(content: bytes) -> list[int]:
    return np.frombuffer(content, dtype=np.int32).tolist()


def fragment(aligner: Aligner, text: str, at: int, begin: int, end: int):
    """What the byte range (begin, end] is: (open parts pa, pb, sa, sb), whether it has a common end, and closed pieces.

    ``text`` starts at byte ``at`` where a unit starts, and ends with a unit. Pieces are (n_a, n_b, groups as text,
    links); None stands for a text whose bytes differ.
    """
    units = aligner.cut.split(text) if aligner.cut else [text]
    open_, cut, closed = ([], [], [], []), False, []
    codes = aligner.codes_of(units)
    for unit, code in zip(units, codes, strict=True):
        size = len(unit.encode())
        if aligner.size(code)[0] < 0:
            return None
        if cut and not open_[2] and not open_[3] and at >= begin and at + size <= end:
            n_a, n_b, n, _ = aligner.size(code)
            closed.append((n_a, n_b, aligner.groups[code], aligner.links_of(code), n))
            at += size
            continue
        (both,) = aligner.encode([unit])
        ends = [np.cumsum([len(table[i]) for i in ids]) + at for ids, table in zip(both, (aligner.a_bytes, aligner.b_bytes), strict=True)]
        own = [[(int(e), i) for e, i in zip(es, ids, strict=True) if begin < e <= end] for es, ids in zip(ends, both, strict=True)]
        last = [0, 0]
        for common in sorted({e for e, _ in own[0]} & {e for e, _ in own[1]}):
            group = []
            for side in (0, 1):
                stop = last[side]
                while stop < len(own[side]) and own[side][stop][0] <= common:
                    stop += 1
                group.append([i for _, i in own[side][last[side] : stop]])
                last[side] = stop
            if not cut:
                open_[0].extend(group[0])
                open_[1].extend(group[1])
                cut = True
            else:  # a unit starts with a group, so nothing is open here
                told, links, n = aligner.steps(*group)
                closed.append((len(group[0]), len(group[1]), told, links, n))
        for side in (0, 1):
            open_[side + 2 * cut].extend(i for _, i in own[side][last[side] :])
        at += size
    return open_, cut, closed


def _fragments(ranges: DataFrame, vocabularies) -> DataFrame:
    """A row for each range: its open parts and its closed groups as one piece. ``bad``: bytes differ."""
    schema = f"{_FRAGMENT}, bad boolean, sub int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, closed string, pairs binary"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabularies)
        for uid, k, begin, end, at, text in batches(rows, ["uid", "k", "begin", "end", "at", "text"]):
            found = fragment(aligner, text, at, begin, end)
            if found is None:
                yield _rows(schema, [(uid, k, False, k, b"", b"", b"", b"", True, 1, 0, 0, 0, 0, "", b"")])
            else:
                open_, cut, closed = found
                links = [p for piece in closed for p in piece[3]]
                sums = [sum(piece[x] for piece in closed) for x in (0, 1, 4)]
                pairs = np.array(links, dtype=np.int64).tobytes()
                yield _rows(schema, [(uid, k, cut, k, *map(_binary, open_), False, 1, *sums, len(links), ";".join(p[2] for p in closed), pairs)])
            if len(aligner.groups) > MEMO_UNITS:
                aligner.forget()

    return ranges.mapInArrow(run, schema)


def compose(left: tuple, right: tuple) -> tuple[tuple, tuple | None]:
    """Two neighbouring fragments (cut, close, pa, pb, sa, sb) as one, and the group that closes between them, if any.

    ``close`` is the range in which the first common end lies. The composition is associative.
    """
    cut, close, *x = left
    other_cut, other_close, *y = right
    if not cut:
        return (other_cut, other_close, x[0] + y[0], x[1] + y[1], y[2], y[3]), None
    if not other_cut:
        return (True, close, x[0], x[1], x[2] + y[0], x[3] + y[1]), None
    return (True, close, x[0], x[1], y[2], y[3]), (other_close, x[2] + y[0], x[3] + y[1])


def _composed(fragments: DataFrame) -> DataFrame:
    """(uid, close, a, b): the groups that close between ranges, and each document's first one."""
    spark = fragments.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = f"seam boolean, {_FRAGMENT}"
    names = [x.split()[0] for x in _FRAGMENT.split(", ")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = None, None
        for uid, k, cut, close, *parts_ in batches(rows, names):
            one = (cut, close, *parts_)
            if key == (uid, k // FAN):
                held, seam = compose(held, one)
                if seam:
                    yield _rows(schema, [(True, uid, None, None, seam[0], seam[1], seam[2], None, None)])
                continue
            if key:
                yield _rows(schema, [(False, *key, *held)])
            held, key = one, (uid, k // FAN)
        if key:
            yield _rows(schema, [(False, *key, *held)])

    seams, state = [], fragments.select(names)
    while True:
        dealt = state.withColumn("up", F.floor(F.col("k") / FAN)).repartition(parts, "uid", "up").sortWithinPartitions("uid", "up", "k")
        done = written(dealt.select(names).mapInArrow(run, schema), "composed")
        seams.append(done.filter("seam"))
        state = done.filter("not seam").drop("seam")
        if not state.filter("k > 0").limit(1).count():
            break
    out = state
    for one in seams:
        out = out.unionByName(one.drop("seam"))
    return out.select("uid", "close", F.col("pa").alias("a"), F.col("pb").alias("b"))


def _seam_pieces(seams: DataFrame, vocabularies) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabularies)
        for uid, close, a, b in batches(rows, ["uid", "close", "a", "b"]):
            x, y = _ids(a), _ids(b)
            told, links, n = aligner.steps(x, y)
            yield _rows(_PIECE, [(uid, close, 0, len(x), len(y), n, len(links), told, np.array(links, dtype=np.int64).tobytes())])

    return seams.mapInArrow(run, _PIECE)


def _block_pieces(pieces: DataFrame) -> DataFrame:
    """Block rows of the pieces of very long texts."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, heads, pairs, size = _Blocks(1), [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            """Each piece is one unit of its block."""
            once = np.ones(1, np.int64)
            return blocks.rows(heads, [np.array([k]) for k in range(len(heads))], [once] * len(heads), np.concatenate(pairs), np.array(list(map(len, pairs))))

        for uid, n_a, n_b, n_groups, n_links, links in batches(rows, ["uid", "n_a", "n_b", "n_groups", "n_links", "pairs"]):
            heads.append((uid, None, n_a, n_b, n_groups, n_links, None))
            pairs.append(np.frombuffer(links, dtype=np.int64))
            size += len(pairs[-1])
            if size >= BLOCK_CHARS or len(heads) >= BLOCK_ROWS:
                yield from block()
                heads, pairs, size = [], [], 0
        if heads:
            yield from block()

    return pieces.mapInArrow(run, _ROW)


def _hash_pieces(pieces: DataFrame) -> DataFrame:
    """(uid, groups_sha256): the pieces of a text stream through its hash in order, none is kept."""
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "uid bigint, groups_sha256 string"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for uid, closed in batches(rows, ["uid", "closed"]):
            if uid != last:
                if sha:
                    yield _rows(schema, [(last, sha.hexdigest())])
                last, sha, first = uid, hashlib.sha256(), True
            if closed:
                sha.update((closed if first else ";" + closed).encode())
                first = False
        if sha:
            yield _rows(schema, [(last, sha.hexdigest())])

    return pieces.select("uid", "k", "sub", "closed").repartition(parts, "uid").sortWithinPartitions("uid", "k", "sub").mapInArrow(run, schema)


def _judged(rows: DataFrame) -> DataFrame:
    """uid, doc_id, the sizes, groups_sha256, n_best, count_sum of every document or piece."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = rows.filter("kind = 0").select("block", "pair", "n")
    counts = written(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    other = F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1))
    highest = counts.groupBy(other.alias("other")).agg(F.max("total").alias("top"))
    values = counts.join(highest, other == F.col("other")).select("pair", "total", (F.col("total") == F.col("top")).alias("best"))
    told = pairs.select("block", "pair").join(values, "pair")
    rest = rows.filter("kind > 0").drop("n").withColumns({"pair": F.coalesce("pair", F.lit(-1)), "total": F.lit(0).cast("bigint"), "best": F.lit(False)})
    both = told.withColumn("kind", F.lit(0)).unionByName(rest, allowMissingColumns=True)
    columns = ["kind", "block", "total", "best", "uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "idx", "ns"]
    schema = "uid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pairs_, units, values, out = None, [], [], None, []
        for batch in batches_:
            kinds, ids = batch.column("kind").to_numpy(), batch.column("block").to_numpy()
            edges = np.append(0, np.flatnonzero((np.diff(kinds) != 0) | (np.diff(ids) != 0)) + 1).tolist()
            for a, b in zip(edges, [*edges[1:], len(kinds)], strict=True):
                if a == b:
                    continue
                if ids[a] != block:
                    block, pairs_, units, values = ids[a], [], [], None
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    pairs_.append(np.stack([part.column("best").to_numpy(zero_copy_only=False).astype(np.int64), part.column("total").to_numpy()]))
                elif kinds[a] == 1:
                    units += [[np.frombuffer(x, dtype=np.int32) for x in row] for row in batches(iter([part]), ["idx", "ns"])]
                else:
                    if values is None:  # of every unit: its best links, and the sum of its links' counts
                        links, sizes = (np.concatenate([u[k] for u in units]) if units else np.empty(0, np.int32) for k in (0, 1))
                        of_link = np.concatenate(pairs_, axis=1)[:, links] if len(links) else np.zeros((2, 0), np.int64)
                        sums = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(of_link, axis=1)], axis=1)
                        ends = np.cumsum(sizes, dtype=np.int64)
                        values = sums[:, ends] - sums[:, ends - sizes]
                    for *head, sha, idx, ns in batches(iter([part]), columns[4:]):
                        found = values[:, np.frombuffer(idx, dtype=np.int32)] @ np.frombuffer(ns, dtype=np.int32).astype(np.int64)
                        out.append((*head, *found.tolist(), sha))
                    if len(out) >= 2_000:
                        yield _rows(schema, out)
                        out = []
        if out:
            yield _rows(schema, out)

    dealt = both.repartition(parts, "block").sortWithinPartitions("block", "kind", "pair").select(columns)
    return dealt.mapInArrow(run, schema)


def align_tokenizers(docs: DataFrame, json_vocabulary: str, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    Side A is a ``tokenizers`` file and gets a blank and the text, side B a ``sentencepiece`` model, which puts the
    blank itself. Special tokens are plain text. Where the bytes of A's and B's tokens both end, a group ends. Every
    pair of tokens whose bytes overlap is a link; its count is the number of links with the same two ids in the
    corpus, and it is best if no other id of A has a higher count with its id of B.

    A NULL or empty text, and one whose bytes either side changes, has no tokens: zeros and an empty column. Rows
    that repeat are answered, and counted, each. NULL ids stay. Empty table: no rows. Other columns are not looked at.

    Memory: a task holds a block of documents, 2 MB of text or one document, and its dictionary; of a text longer
    than ``LONG`` characters one byte range at a time. Only dictionaries of blocks, (block, pair) rows, are joined on the
    pair; the text is read twice and only that of very long documents is shuffled.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    contents = [open(path, "rb").read() for path in (json_vocabulary, model)]
    vocabularies = spark.sparkContext.broadcast((*contents, hashlib.sha256(b"|".join(contents)).digest()))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > LONG
    short = _align_texts(rows.filter(~is_long), vocabularies)
    ranges = _ranges(rows.filter(is_long).select("uid", "text"), vocabularies).repartition(parts, "uid", "k")
    found = written(_fragments(ranges, vocabularies), "fragments")
    bad = found.filter("bad").select("uid").distinct()
    sound = found.join(bad, "uid", "left_anti")
    names = [x.split()[0] for x in _PIECE.split(", ")]
    pieces = written(sound.select(names).unionByName(_seam_pieces(_composed(sound), vocabularies)), "pieces")
    judged = _judged(written(short.unionByName(_block_pieces(pieces)), "aligned"))
    judged = written(judged, "judged")
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    columns = ["doc_id", *sums, "groups_sha256"]
    long_ = judged.filter("groups_sha256 is null").groupBy("uid").agg(*[F.sum(c).alias(c) for c in sums]).join(_hash_pieces(pieces), "uid")
    of_long = rows.filter(is_long).select("uid", "doc_id").join(long_.select("uid", *sums, F.col("groups_sha256").alias("told")), "uid", "left")
    of_long = of_long.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in sums], F.coalesce("told", F.lit("")).alias("groups_sha256"))
    return judged.filter("groups_sha256 is not null").select(columns).unionByName(of_long)
