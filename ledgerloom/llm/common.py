"""What the operators share: the shared folder, files in it, and Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Narrow rows of one file.
FILE_ROWS = 100_000


@dataclass(frozen=True)
class Derive:
    """Columns made of what an operator found for a batch of documents, in its tasks, with their schema."""

    schema: str
    columns: Callable[[list[pa.Array]], list[pa.Array]]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; one of this machine only where no cluster names one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get(CHECKPOINT_DIR, "") or f"file://{tempfile.gettempdir()}/ledgerloom")
    return spark.conf.get(CHECKPOINT_DIR, "") or context.getCheckpointDir()


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh place in the shared folder, as a URI."""
    return f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def kept(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows of ``df`` as files in the shared folder, which outlive an executor.

    ``rows`` is about how many narrow rows there are, if that is known: few rows need few files.
    """
    shared_folder(df.sparkSession)
    return (df if rows is None else df.coalesce(1 + rows // FILE_ROWS)).checkpoint()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, in Java's spelling (file:/x) too, and the path in it."""
    scheme, _, path = uri.partition(":")
    if path.startswith("/") and not path.startswith("//"):
        uri = f"{scheme}://{path}"
    return fs.FileSystem.from_uri(uri)


def write_whole(folder: str, name: str, parts: Iterable[bytes]) -> tuple[str, int]:
    """Write a file that appears under its name only when complete, so that a task may run twice."""
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    attempt = f"{root}/.{name}.{uuid.uuid4().hex}"
    size = 0
    with system.open_output_stream(attempt) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    system.move(attempt, f"{root}/{name}")
    return f"{folder}/{name}", size


# What tasks have left in this worker process for the next ones, by operator, and how to let go of it.
_HELD: dict[str, Callable[[], object]] = {}


def hold(operator: str, drop: Callable[[], object]) -> None:
    """Called where a task begins: a worker goes from one operator's tasks to another's, and what it
    remembers of the others would stay beside what this one needs."""
    for other in [name for name in _HELD if name != operator]:
        _HELD.pop(other)()
    _HELD[operator] = drop


def give_back() -> None:
    """Hand memory that is free again back to the machine, where the C library can; a worker that waits for
    its next task counts with what it keeps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Strings of an Arrow column, null as the empty text."""
    return [text or "" for text in column.to_pylist()]


def in_slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts with about ``most`` bytes or elements of one column, at least a row each."""
    values = batch.column(column)
    lengths = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    sizes = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def ragged_take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]`` one after another."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
