"""Token ids in files of Simple-8b words, in order of document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Derive, in_slices, kept, new_folder, or_empty, write_whole
from ledgerloom.llm.word_cache import ByteWords, encoder, with_ends

# Ids of a block, which is coded by itself, and of a file, which a task holds whole.
BLOCK = 4_096
FILE_IDS = 4_000_000

# Selector of a 64-bit word (its lowest four bits) and the ids it packs: how many, of how many bits.
# Selector 0 is the escape: the next word is one id of up to 64 bits.
SELECTORS = {
    2: (60, 1),
    3: (30, 2),
    4: (20, 3),
    5: (15, 4),
    6: (12, 5),
    7: (10, 6),
    8: (8, 7),
    9: (7, 8),
    10: (6, 10),
    11: (5, 12),
    12: (4, 15),
    13: (3, 20),
    14: (2, 30),
    15: (1, 60),
}
ESCAPE = 0
MAGIC = b"TOKS8B01"
_COUNTS = np.array([SELECTORS.get(s, (1, 64))[0] for s in range(16)], np.int64)
_LONGEST = 60
# Blocks coded side by side.
_TOGETHER = 512


def pack_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) of all blocks, and the first word of each block with the end of the last."""
    words, sizes = [], []
    for at in range(0, len(ids), BLOCK * _TOGETHER):
        some, counts = _pack_blocks(np.asarray(ids[at : at + BLOCK * _TOGETHER], np.uint64))
        words.append(some)
        sizes.append(counts)
    sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    return (
        np.concatenate(words) if words else np.empty(0, np.uint64),
        np.concatenate(([0], np.cumsum(sizes))).astype(np.uint64),
    )


def _pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blocks = -(-len(ids) // BLOCK)
    # Past its end a block reads zeros, which fit any word.
    wide = BLOCK + _LONGEST
    grid = np.zeros((blocks, wide), np.uint64)
    full = len(ids) // BLOCK
    grid[:full, :BLOCK] = ids[: full * BLOCK].reshape(full, BLOCK)
    grid[full:, : len(ids) - full * BLOCK] = ids[full * BLOCK :]
    need = np.zeros((blocks, wide), np.uint8)
    largest = int(ids.max())
    # Ids of up to 32 bits are compared in half the memory.
    compared = grid.astype(np.uint32) if largest < 2**32 else grid
    for _, bits in SELECTORS.values():
        if largest >= 1 << bits:
            need += compared >= compared.dtype.type(1 << bits)
    # The widest id among as many as each selector takes, from every place on.
    chosen = np.zeros((blocks, BLOCK), np.uint8)
    widest, seen = need, 1
    for selector, (count, _) in sorted(SELECTORS.items(), reverse=True):
        while seen < count:
            step = min(seen, count - seen)
            widest = np.maximum(widest[:, : widest.shape[1] - step], widest[:, step:])
            seen += step
        np.copyto(chosen, np.uint8(selector), where=widest[:, :BLOCK] <= selector - 2)
    chosen = chosen.reshape(-1)
    # All blocks walk from word to word together.
    begins = np.zeros(blocks * BLOCK, bool)
    at = np.arange(0, blocks * BLOCK, BLOCK)
    end = np.minimum(at + BLOCK, len(ids))
    while len(at):
        begins[at] = True
        at = at + _COUNTS[chosen[at]]
        inside = at < end
        at, end = at[inside], end[inside]
    starts = np.flatnonzero(begins)
    selectors = chosen[starts]
    in_grid = starts + starts // BLOCK * _LONGEST
    escaped = selectors == ESCAPE
    position = np.cumsum(1 + escaped) - (1 + escaped)
    words = np.zeros(int((1 + escaped).sum()), np.uint64)
    flat = grid.reshape(-1)
    for selector, (count, bits) in SELECTORS.items():
        mine = np.flatnonzero(selectors == selector)
        if len(mine):
            first = in_grid[mine]
            word = np.full(len(mine), selector, np.uint64)
            for j in range(count):
                word |= flat[first + j] << np.uint64(4 + j * bits)
            words[position[mine]] = word
    words[position[escaped] + 1] = flat[in_grid[escaped]]
    return words, np.bincount(starts // BLOCK, weights=1 + escaped).astype(np.int64)


def unpack_ids(words: np.ndarray, offsets: np.ndarray, total: int) -> np.ndarray:
    """The ``total`` ids of ``words``, all words of a selector at a time."""
    selectors = (words & np.uint64(15)).astype(np.int64)
    raw = np.zeros(len(words) + 1, bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():
        # A word after an escape is an id, whatever it looks like.
        raw[at + 1] = not raw[at]
    raw = raw[: len(words)]
    counts = np.where(raw, 1, np.where(selectors == ESCAPE, 0, _COUNTS[selectors]))
    # The last word of a block may have room left, so each block writes into a row of its own.
    wide = BLOCK + _LONGEST
    first = offsets[:-1].astype(np.int64)
    before = np.cumsum(counts) - counts
    shift = np.arange(len(first)) * wide - (before[first] if len(words) else 0)
    place = before + np.repeat(shift, np.diff(offsets.astype(np.int64)))
    selectors[raw] = -1
    used = np.bincount(selectors + 1, minlength=17)[1:]
    narrow = not used[ESCAPE] and not any(used[s] for s, (_, bits) in SELECTORS.items() if bits > 32)
    grid = np.zeros(len(first) * wide, np.uint32 if narrow else np.uint64)
    for selector, (count, bits) in SELECTORS.items():
        if used[selector]:
            mine = np.flatnonzero(selectors == selector)
            at, rest = place[mine], words[mine] >> np.uint64(4)
            for _ in range(count):
                grid[at] = rest & np.uint64((1 << bits) - 1)
                at += 1
                rest >>= np.uint64(bits)
    grid[place[raw]] = words[raw]
    return grid.reshape(-1, wide)[:, :BLOCK].reshape(-1)[:total]


def file_parts(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
    """A file: magic, counts, document ids and whether they are null, their lengths, the blocks'
    offsets, the words, and a crc32 of these."""
    words, offsets = pack_ids(ids)
    yield MAGIC
    yield np.array([len(doc_ids), len(ids), len(words), BLOCK], "<u8").tobytes()
    yield np.array([i or 0 for i in doc_ids], "<i8").tobytes()
    yield np.array([i is None for i in doc_ids], np.uint8).tobytes()
    yield lengths.astype("<u8").tobytes()
    yield offsets.astype("<u8").tobytes()
    body = words.astype("<u8").tobytes()
    yield body
    yield zlib.crc32(body).to_bytes(4, "little")


def parse_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and all ids of a file."""
    if content[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    docs, total, n_words, block = (int(n) for n in np.frombuffer(content, "<u8", 4, 8))
    if block != BLOCK:
        raise ValueError(f"blocks of {block} ids")
    at = 40
    doc_ids = np.frombuffer(content, "<i8", docs, at).tolist()
    null = np.frombuffer(content, np.uint8, docs, at := at + 8 * docs)
    lengths = np.frombuffer(content, "<u8", docs, at := at + docs).astype(np.int64)
    n_blocks = -(-total // BLOCK)
    offsets = np.frombuffer(content, "<u8", n_blocks + 1, at := at + 8 * docs)
    words = np.frombuffer(content, "<u8", n_words, at := at + 8 * (n_blocks + 1))
    if zlib.crc32(words) != int.from_bytes(content[at + 8 * n_words :], "little"):
        raise ValueError("damaged words")
    return [None if gone else i for i, gone in zip(doc_ids, null)], lengths, unpack_ids(words, offsets, total)


def write(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write all documents' ids, each with ``end_id`` appended, and return the list of files.

    Files and the documents in them are in ascending order of ``doc_id``, nulls first, equal ids by
    text; a file ends with the document that brings it to ``file_ids``. Null texts are empty texts,
    which have the end id alone; an empty table has no files; other columns are not looked at. The
    list has one row per file: ``file``, ``part``, ``number``, ``n_docs``, ``n_ids``, and ``start``,
    the number of ids in all files before it.
    """
    spark = documents.sparkSession
    to = folder or new_folder(spark, "token-files")
    # The hash deals out rows that share an id.
    ordered = (
        documents.select("doc_id", or_empty(F.col("text")).alias("text"))
        .withColumn("salt", F.xxhash64("text"))
        .repartitionByRange("doc_id", "salt")
        .sortWithinPartitions("doc_id", "salt", "text")
        .drop("salt")
    )

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        codec = encoder(tokenizer_path, ByteWords)
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        number = 0

        def flush() -> pa.RecordBatch:
            size = np.concatenate(lengths)
            name, _ = write_whole(to, f"part-{part:06d}-{number:06d}.toks", file_parts(doc_ids, size, np.concatenate(ids)))
            row = {"file": name.rsplit("/", 1)[1], "part": part, "number": number, "n_docs": len(size), "n_ids": int(size.sum())}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for some in in_slices(batch, 1, min(3_000_000, 2 * file_ids)):
                flat, counts = codec.encode(some.column(1))
                doc_ids += some.column(0).to_pylist()
                lengths.append(counts + 1)
                ids.append(with_ends(flat, counts, end_id))
                if sum(map(len, ids)) >= file_ids:
                    yield flush()
                    number += 1
                    doc_ids, lengths, ids = [], [], []
        if doc_ids:
            yield flush()

    schema = pa.schema(
        [("file", pa.string())] + [(name, pa.int64()) for name in ("part", "number", "n_docs", "n_ids")]
    )
    files = kept(ordered.mapInArrow(store, "file string, part long, number long, n_docs long, n_ids long"))
    # One row per file.
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumns(
        {"start": F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)), "folder": F.lit(to)}
    )


def read(spark: SparkSession, folder: str, derive: Derive | None = None) -> DataFrame:
    """Rows ``file``, ``doc_id``, ``offset`` (ids before it in its file) and ``ids`` (binary:
    little-endian unsigned 32-bit integers) of all documents in a folder of token files.

    With ``derive``, the columns it makes of ``ids`` are returned instead of them, and no ids leave
    the tasks that read the files.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, lengths, ids = parse_file(content.as_buffer().to_pybytes())
                ends = np.concatenate(([0], np.cumsum(lengths)))
                flat = ids.astype("<u4", copy=False)
                for at in range(0, len(doc_ids), 4_096):
                    bounds = ends[at : at + 4_097]
                    inside = [None, pa.py_buffer((4 * (bounds - bounds[0])).astype(np.int32)), pa.py_buffer(flat[bounds[0] : bounds[-1]])]
                    found = [pa.Array.from_buffers(pa.binary(), len(bounds) - 1, inside)]
                    columns = [
                        pa.array([path.rsplit("/", 1)[1]] * (len(bounds) - 1)),
                        pa.array(doc_ids[at : at + 4_096], pa.int64()),
                        pa.array(bounds[:-1]),
                        *(derive.columns(found) if derive else found),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"file string, doc_id long, offset long, {derive.schema if derive else 'ids binary'}"
    names = [column.split()[0] for column in schema.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.toks").load(folder)
    return files.select("path", "content").mapInArrow(parse, schema)
