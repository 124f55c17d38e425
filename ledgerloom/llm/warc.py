"""WARC archives: written with revisits of equal payloads, read in ranges by their record chain."""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import file_system, kept, new_folder, or_empty, write_whole

# Payloads from this size on are written once.
REVISIT_FROM = 1_000
# Bytes of a file that a task fills, and of a range that a task reads.
FILE_BYTES = 32_000_000
RANGE = 8_000_000
# Tasks that read ranges, at most; beyond, a task reads several.
MOST_TASKS = 10_000
# Groups of equal payloads that are sent to all tasks, at most: some 100 bytes each.
BROADCAST_GROUPS = 100_000
# Tasks that write the groups of equal payloads, a small row each.
WRITERS = 64
# A record has no date of its own in the pages.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n)", re.IGNORECASE)
# Bytes of a header read with a range; a longer one is read on its own.
_HEADER = 65_536
_LONGEST_HEADER = 1 << 24

RECORD = (
    "file string, offset long, record_type string, record_id string, target_uri string, page_id long, "
    "refers_to long, digest string, http_length long, payload binary"
)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(url: str | None, page_id: int | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; with ``refers_to``, a revisit of that page's record without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)))
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Page", str(refers_to))]
    body = http.encode() + (payload if refers_to is None else b"")
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def write(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``); the list of files.

    Of rows with equal payloads of at least REVISIT_FROM bytes, those with the largest id are
    responses (rows that repeat it as well), the others revisits of it; without any id in such a
    group all are responses. A null html is an empty payload, a null url or id is left out of its
    record, an empty table has no files, and other columns are not looked at. Returns ``file``,
    ``size``, ``records`` and ``folder``.
    """
    spark = pages.sparkSession
    to = folder or new_folder(spark, "warc")
    rows = pages.select("page_id", "url", or_empty(F.col("html")).alias("payload"))
    keyed = rows.select(
        "page_id",
        "url",
        F.col("payload").cast("binary").alias("payload"),
        F.sha1(F.col("payload").cast("binary")).alias("digest"),
        F.octet_length("payload").alias("size"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("same"),
    )
    # Equal payloads are counted in each task before they meet.
    groups = (
        keyed.filter(F.col("size") >= REVISIT_FROM)
        .groupBy(F.col("same").alias("of_same"))
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("copies"))
        .filter("copies > 1 and holder is not null")
        .drop("copies")
    )
    groups = kept(groups.coalesce(WRITERS))
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    held = keyed.join(
        F.broadcast(groups) if few else groups, (F.col("same") == F.col("of_same")) & (F.col("size") >= REVISIT_FROM), "left"
    ).select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"),
    )

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: list[bytes] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            name, written = write_whole(to, f"part-{part:06d}-{number:06d}.warc", waiting)
            row = {"file": name, "size": written, "records": len(waiting)}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(column.to_pylist() for column in batch.columns)):
                waiting.append(record(url, page_id, payload, digest, refers_to))
                size += len(waiting[-1])
                if size >= file_bytes:
                    yield flush()
                    waiting, size, number = [], 0, number + 1
        if waiting:
            yield flush()

    schema = pa.schema([("file", pa.string()), ("size", pa.int64()), ("records", pa.int64())])
    files = kept(held.mapInArrow(store, "file string, size long, records long"))
    return files.withColumn("folder", F.lit(to))


def read(spark: SparkSession, folder: str, range_bytes: int = RANGE) -> DataFrame:
    """The records of all ``.warc`` files in a folder, a row each (see RECORD).

    Files are read in ranges. What looks like a record's beginning may be part of a payload, so each
    range first lists its candidates, and for each where the chain of lengths from it leaves the
    range. Jumping these pointers from the beginning of each file, twice as far each round, gives
    the places where the true chain enters ranges; from there the records are read. What follows
    a damaged record cannot be told from payload and is left out, a record cut off by the end of its
    file too; an empty file or folder has no records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc").load(folder)
    ranges = kept(
        files.filter("length > 0").selectExpr(
            "path as file", "length", f"explode(sequence(0L, length - 1, {range_bytes}L)) as begin"
        ),
        0,
    )
    longest, number = ranges.agg(F.coalesce(F.max("length"), F.lit(0)), F.count("*")).first()
    # A range is a task's work; a chain enters each range at one place, of few that look like one.
    tasks = max(1, min(number, MOST_TASKS))
    dealt = ranges.repartition(tasks)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length, begin in zip(*(column.to_pylist() for column in batch.columns)):
                end = min(begin + range_bytes, length)
                places, exits = _exits(file, length, begin, end)
                columns = [pa.array([file] * len(places), pa.string()), pa.array(places), pa.array(exits)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "at", "exit"])

    found = kept(dealt.mapInArrow(candidates, "file string, at long, exit long"))
    # Only places that some chain enters matter between ranges.
    entered = found.filter("exit >= 0").selectExpr("file", "exit as at").distinct()
    jumps = kept(
        found.join(entered, ["file", "at"], "left_semi").union(found.filter("at = 0")).distinct().coalesce(tasks)
    )
    reached = jumps.filter("at = 0").select("file", "at")
    for _ in range(max(0, -(-longest // range_bytes) - 1).bit_length()):
        onward = jumps.selectExpr("file as to_file", "at as to_at", "exit as to_exit")
        there = F.expr("file = to_file and exit = to_at")
        reached = kept(
            reached.union(reached.join(jumps, ["file", "at"]).select("file", F.col("exit").alias("at")).filter("at >= 0")).distinct(),
            number,
        )
        farther = jumps.join(onward, there, "left").selectExpr("file", "at", "coalesce(to_exit, -1L) as exit")
        jumps = kept(farther.coalesce(tasks))
    entries = reached.selectExpr("file as in_file", "at", f"at div {range_bytes}L * {range_bytes}L as in_begin")
    starts = ranges.join(entries, F.expr("file = in_file and begin = in_begin")).select("file", "length", "begin", "at")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length, begin, at in zip(*(column.to_pylist() for column in batch.columns)):
                yield from _records(file, length, min(begin + range_bytes, length), at)

    return starts.repartition(tasks).mapInArrow(records, RECORD)


class _File:
    """Bytes of a file by offset, a part at a time."""

    def __init__(self, file: str) -> None:
        system, path = file_system(file)
        self.handle = system.open_input_file(path)

    def bytes(self, begin: int, end: int) -> bytes:
        return self.handle.read_at(max(0, end - begin), begin)

    def header(self, at: int, length: int, there: bytes) -> tuple[bytes, int] | None:
        """A record's header and its content's length, if a whole header begins at ``at``.

        ``there`` are the file's bytes from ``at`` on, as far as they are at hand.
        """
        size = len(there)
        while True:
            end = there.find(b"\r\n\r\n")
            if end >= 0 or at + len(there) >= length or size >= _LONGEST_HEADER:
                break
            size = max(_HEADER, 2 * size)
            there = self.bytes(at, min(at + size, length))
        match = _LENGTH.search(there, 0, end + 2) if end >= 0 else None
        return (there[:end], int(match[1])) if match else None


def _exits(file: str, length: int, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Where records may begin in a range, and where the chain from each leaves it (-1: nowhere)."""
    source = _File(file)
    content = source.bytes(begin, min(end + _HEADER, length))
    places, successors = [], []
    for match in MAGIC.finditer(content, 0):
        if match.start() >= end - begin:
            break
        at = begin + match.start()
        header = source.header(at, length, content[match.start() : match.start() + _HEADER])
        if header:
            places.append(at)
            successors.append(at + len(header[0]) + 4 + header[1] + 4)
    at, after = np.array(places, np.int64), np.array(successors, np.int64)
    after[after > length] = -1
    # Within the range, all candidates jump together, twice as far each time.
    slot = np.searchsorted(at, after)
    inside = (after >= 0) & (after < end)
    hits = inside & (slot < len(at)) & (at[np.minimum(slot, len(at) - 1)] == after) if len(at) else inside
    pointer = np.where(hits, slot, np.arange(len(at)))
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            break
        pointer = further
    last = after[pointer]
    return at, np.where((last >= end) | (last == length), last, -1)


def _records(file: str, length: int, end: int, at: int) -> Iterator[pa.RecordBatch]:
    """The records whose chain enters a range at ``at``."""
    source = _File(file)
    content, base = source.bytes(at, min(end + _HEADER, length)), at
    rows: list[tuple] = []
    held = 0
    while at < end:
        there = content[at - base : at - base + _HEADER]
        header = source.header(at, length, there) if MAGIC.match(there) else None
        if header is None:
            break
        body = at + len(header[0]) + 4
        after = body + header[1] + 4
        if after > length:
            break
        block = content[body - base : body - base + header[1]]
        if len(block) < header[1]:
            block = source.bytes(body, body + header[1])
        rows.append((file, at, *_fields(header[0], block)))
        held += header[1]
        if held >= 4_000_000:
            yield _batch(rows)
            rows, held = [], 0
        at = after
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    columns = [column.split() for column in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(zip(*rows), columns)], [name for name, _ in columns]
    )


def _fields(header: bytes, block: bytes) -> tuple:
    lines = header.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    http, _, payload = block.partition(b"\r\n\r\n")
    size = _LENGTH.search(http + b"\r\n")
    digest = fields.get("warc-payload-digest", "")
    is_sha1 = digest.startswith("sha1:") and len(digest) == 37
    return (
        fields.get("warc-type"),
        fields.get("warc-record-id"),
        fields.get("warc-target-uri"),
        _number(fields.get("page-id")),
        _number(fields.get("refers-to-page")),
        base64.b32decode(digest[5:]).hex() if is_sha1 else None,
        int(size[1]) if size else None,
        None if fields.get("warc-type") == "revisit" else payload,
    )


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("-?[0-9]{1,19}", text) else None
