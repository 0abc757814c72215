"""WARC archives: written per task, read back by a salvage reader that keeps a log of what it had to leave out."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches
from tidemark.session import new_folder, written

ARCHIVE_BYTES = 32_000_000  # an archive is closed once it is this long
REVISIT_FROM = 1000  # payloads from this length on are stored once
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 18

ARCHIVES = "archive string, records bigint, bytes bigint"
RECORDS = (
    "archive string, kind string, begin bigint, finish bigint, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)
_COLUMNS = [part.split()[0] for part in RECORDS.split(", ")]
_SCHEMA = pa.schema(
    [(c, pa.int64() if t == "bigint" else pa.binary() if t == "binary" else pa.string()) for c, t in (p.split() for p in RECORDS.split(", "))]
)


def plan_records(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """page_id, url, html, payload_digest, payload_bytes, record_type, refers_to of every row.

    Of equal payloads of ``revisit_from`` bytes or more the largest page_id is the response. Only ids and
    digests are grouped (partial aggregation, skew-split join); the markup is shuffled once, by page and so
    evenly, when the decision joins it.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("payload_digest"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("bigint"))
    keys = written(rows.select("page_id", "payload_digest", "payload_bytes").distinct(), "payload-digests")
    first = (
        keys.filter(F.col("payload_bytes") >= revisit_from)
        .groupBy("payload_digest").agg(F.max("page_id").alias("response_id"))
    )
    decided = keys.join(first, "payload_digest", "left").select(
        F.col("page_id").alias("of_page"),
        F.col("payload_digest").alias("of_digest"),
        F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id")).alias("refers_to"),
    )
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("payload_digest") == F.col("of_digest"))
    return rows.join(decided, same).drop("of_page", "of_digest").withColumn(
        "record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    )


def _uri(url: str | None) -> str:
    """A header is one line: control characters and blanks are written as %XX."""
    return re.sub(r"[\x00-\x20\x7f]", lambda x: f"%{ord(x[0]):02X}", url or "")


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", identifier or "")
    return int(found[1]) if found else None


def make_record(page_id, url, html: str, digest: str, size: int, kind: str, refers_to) -> bytes:
    """One record: the answer's header, and the payload unless another record has it."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if kind == "response":
        block += html.encode("utf-8", "replace")
    header = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    header += [f"WARC-Target-URI: {_uri(url)}"] if url is not None else []
    if kind == "revisit":
        header += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    header += [
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    return VERSION + "\r\n".join(header).encode() + END + block + END


def write_archives(records: DataFrame, folder: str, compress: bool = True, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records below ``folder`` (a URI that all executors reach); returns the archives' list.

    Each task writes its own archives under names that no other attempt has, and the list, a table, has only
    those of attempts that ended well: what a lost executor or a second attempt leaves is never read.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        names = ["page_id", "url", "html", "payload_digest", "payload_bytes", "record_type", "refers_to"]
        file = uri = None
        count = size = 0
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            if file is not None:
                file.close()
                done.append((uri, count, size))

        for row in batches(rows, names):
            if file is None or size >= limit:
                close()
                name = f"{uuid.uuid4().hex}.warc" + ".gz" * compress
                uri = f"{folder}/{name}"
                file, count, size = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
            record = make_record(*row)
            if compress:
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                record = pack.compress(record) + pack.flush()
            file.write(record)
            count, size = count + 1, size + len(record)
        close()
        yield pa.RecordBatch.from_pydict(
            {n: pa.array([x[i] for x in done], t) for i, (n, t) in enumerate((("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())))}
        )

    return written(records.mapInArrow(run, ARCHIVES), "archives")


class _Salvage:
    """The records and gaps of one archive, read in chunks; memory holds one record at most, plus a chunk."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.next: dict[bytes, int] = {}

    def find(self, pattern: bytes, start: int) -> int:
        """The next place of a pattern from ``start`` on; the end if there is none."""
        while start < self.size:
            chunk = self.file.read_at(min(CHUNK, self.size - start), start)
            at = chunk.find(pattern)
            if at >= 0:
                return start + at
            if start + len(chunk) >= self.size:
                break
            start += max(1, len(chunk) - len(pattern) + 1)
        return self.size

    def ahead(self, pattern: bytes, start: int) -> int:
        """As ``find`` for starts that rise; what was found once is not looked for again."""
        if self.next.get(pattern, -1) < start:
            self.next[pattern] = self.find(pattern, start)
        return self.next[pattern]

    def member(self, start: int) -> tuple[bytes, int]:
        """The content of the compressed member at ``start`` and where it ends."""
        unpack, out, at = zlib.decompressobj(31), [], start
        while not unpack.eof:
            chunk = self.file.read_at(min(CHUNK, self.size - at), at) if at < self.size else b""
            if not chunk:
                raise ValueError("member cut off")
            try:
                out.append(unpack.decompress(chunk))
            except zlib.error:
                raise ValueError("member damaged") from None
            at += len(chunk)
            if not out[0].startswith(VERSION[: min(5, len(out[0]))]):
                raise ValueError("no version line")
        return b"".join(out), at - len(unpack.unused_data)

    def plain(self, start: int) -> tuple[bytes, int]:
        """The record at ``start`` of an archive that is not compressed and where it ends."""
        stop = self.ahead(END, start)
        if stop == self.size or self.ahead(b"\r\n" + VERSION[:7], start) < stop:  # a header may be long, but not go into the next record
            raise ValueError("header without end")
        length = _length(_fields(self.file.read_at(stop - start, start)))
        finish = stop + len(END) + length + len(END)
        if finish > self.size:
            raise ValueError("record cut off")
        return self.file.read_at(finish - start, start), finish

    def __iter__(self) -> Iterator[tuple[int, int, dict | None, str | None]]:
        """(begin, finish, record, None) or (begin, finish, None, reason), in the order of the bytes."""
        if not self.size:
            return
        head = self.file.read_at(min(len(MAGIC), self.size), 0)
        packed = head == MAGIC
        if not packed and head != VERSION[: len(head)]:  # damaged from the start: whichever sign comes first
            packed = self.find(MAGIC, 0) < self.find(b"WARC/1.", 0)
        sign, take = (MAGIC, self.member) if packed else (b"WARC/1.", self.plain)
        at, gap, reason = 0, None, None
        while at < self.size:
            try:
                if self.file.read_at(min(len(sign), self.size - at), at) != sign:
                    raise ValueError("no record where one must begin")
                content, finish = take(at)
                record = parse_record(content)
            except ValueError as error:
                if gap is None:
                    gap, reason = at, str(error)
                at = self.find(sign, at + 1)
                continue
            if gap is not None:
                yield gap, at, None, reason
                gap = None
            yield at, finish, record, None
            at = finish
        if gap is not None:
            yield gap, self.size, None, reason


def _fields(head: bytes) -> dict[str, str]:
    first, *lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", first):
        raise ValueError("no version line")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without a colon")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields


def _length(fields: dict[str, str]) -> int:
    if not re.fullmatch(r"\d+", fields.get("content-length", "")):
        raise ValueError("no content length")
    return int(fields["content-length"])


def parse_record(content: bytes) -> dict:
    """The fields of one record; ValueError unless length, end and digests are right."""
    stop = content.find(END)
    if stop < 0:
        raise ValueError("header without end")
    fields = _fields(content[:stop])
    block = content[stop + len(END) : -len(END)]
    if len(block) != _length(fields) or not content.endswith(END):
        raise ValueError("wrong content length")
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != hashlib.sha1(block).hexdigest():
        raise ValueError("wrong block digest")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(END)
        found = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size = int(found[1]) if found else len(payload)
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind != "revisit":
        size, digest_found = len(payload), hashlib.sha1(payload).hexdigest()
        if digest and digest != digest_found:
            raise ValueError("wrong payload digest")
        digest = digest_found
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload,
    }


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records and the quarantined gaps (``kind``) of the listed archives, with their byte ranges.

    A record counts if its member unpacks, its version line, length, end and digests are right. After a check
    that fails the reader looks for the next sign of a member (or, in an archive that is not compressed, of a
    version line) and goes on with the first that holds a right record; the bytes between are one gap with the
    reason of the first failure. An archive is read by one task, in chunks; the archives are dealt evenly.
    An empty archive gives no rows; a missing one is an error.
    """
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (uri,) in batches(rows, ["archive"]):
            store, path = fs.FileSystem.from_uri(uri)
            with store.open_input_file(path) as file:
                out, held = [], 0
                for begin, finish, record, reason in _Salvage(file, file.size()):
                    row = dict.fromkeys(_COLUMNS) | {"archive": uri, "begin": begin, "finish": finish, "reason": reason}
                    row |= {"kind": "gap"} if record is None else {"kind": "record", **record}
                    if not payloads:
                        row["payload"] = None
                    out.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    return archives.select("archive").repartition(parts).mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record per page, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    NULL markup is an empty payload, a NULL url a record without target, a NULL page_id stays NULL. Rows that
    repeat id and payload are records each, all responses if their id is the largest. Long payloads are
    neither cut nor split, nor are long urls. No pages, no archives, no rows. Other columns are not looked at.
    Bytes that can't be read back are an error that names them: no page is missing without a word.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    return pages_of(read_archives(write_archives(plan_records(pages), folder)))


def pages_of(records: DataFrame) -> DataFrame:
    """The pages of records that ``read_archives`` gives; a gap among them is an error."""
    gap = F.concat_ws(" ", F.lit("unreadable bytes"), F.concat_ws("-", "begin", "finish"), F.lit("of"), "archive", F.lit(":"), "reason")
    sound = F.when(F.col("kind") == "record", F.lit(True)).otherwise(F.raise_error(gap).cast("boolean"))
    read = records.filter(sound)
    number = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint")
    return read.select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )
