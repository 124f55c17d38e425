"""Byte-level BPE: texts to ids and back, long texts in overlapping chunks."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Derive, in_slices, kept, or_empty, ragged_take, texts_of

# Characters of a chunk, and those it shares with the next one.
CHUNK = 16_384
OVERLAP = 1_024
# Bytes of text, and ids, a task works on at once.
SLICE = 4_000_000


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _splitter(pattern: str) -> regex.Pattern:
    # The library's white space is Unicode's, without the separators that Python adds.
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _ids(codec: tiktoken.Encoding, texts: pa.Array) -> pa.ListArray:
    # No special tokens are known, so this is ordinary encoding.
    ids = [codec.encode_to_numpy(text, disallowed_special=()) for text in texts_of(texts)]
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


@lru_cache(maxsize=4)
def _bytes_of_ids(ranks_path: str, pattern: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids in a row, and where those of each id start and how many they are."""
    codec = encoding(ranks_path, pattern)
    tokens = [codec.decode_single_token_bytes(i) for i in range(codec.n_vocab)]
    lengths = np.array([len(token) for token in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _decoded(column: pa.ListArray, ranks_path: str, pattern: str) -> pa.Array:
    """The bytes of all ids of each list one after another; those of a null list are none."""
    flat, starts, lengths = _bytes_of_ids(ranks_path, pattern)
    ids = column.flatten().to_numpy()
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(lengths[ids])))[np.concatenate(([0], np.cumsum(counts)))]
    parts = [ragged_take(flat, starts[some], lengths[some]) for some in np.array_split(ids, 1 + len(ids) // 500_000)]
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.concatenate(parts))]
    return pa.Array.from_buffers(pa.binary(), len(column), buffers)


def encode(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    decoded: bool = False,
    derive: Derive | None = None,
) -> DataFrame:
    """One row per document: its id and ``ids`` (array of int), without special tokens.

    With ``decoded``, the tasks that encode decode the ids again, as :func:`decode` does; ids sent on
    to another Python worker for this would need twice as many workers in memory. With ``derive``,
    the columns it makes of these are returned instead.

    A text of more than ``chunk`` characters is cut into chunks that overlap. Each is split into
    pre-tokens by itself; two neighbours are stitched at the first place in their overlap where both
    begin a pre-token, since from there on both see the same, and the character before is no white
    space: where a run of it ends depends on what follows, which the piece before no longer sees. The
    pieces between stitches are encoded in parallel. A text with neighbours that nowhere agree (a run longer than the overlap without
    any boundary) is encoded whole. Null and empty texts have no ids; rows that repeat an id are
    rows of their own; an empty table gives no rows; other columns are not looked at.
    """
    texts = documents.select(F.col(id_column).alias("id"), or_empty(F.col(text_column)).alias("text"))
    is_long = F.char_length("text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(ranks_path, pattern)
        for batch in batches:
            for part in in_slices(batch, 1, SLICE):
                columns = finish(_ids(codec, part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["id", *names])

    def finish(ids: pa.ListArray) -> list[pa.Array]:
        found = [ids, *([_decoded(ids, ranks_path, pattern)] if decoded else [])]
        return derive.columns(found) if derive else found

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, 1, SLICE // 4):
                yield pa.RecordBatch.from_arrays([part.column(0), *finish(part.column(1))], ["id", *names])

    kind = documents.schema[id_column].dataType.simpleString()
    made = derive.schema if derive else "ids array<int>" + (", decoded binary" if decoded else "")
    names = [column.split()[0] for column in made.split(", ")]
    schema = f"id {kind}, {made}"
    short = texts.filter(~is_long).mapInArrow(whole, schema)
    long = _encode_long(texts.filter(is_long), ranks_path, pattern, chunk, overlap)
    if decoded or derive:
        long = long.mapInArrow(finished, schema)
    return short.union(long).withColumnRenamed("id", id_column)


def _encode_long(texts: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    kind = texts.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py()
                bodies = [text[at : at + chunk + overlap] for at in range(0, len(text), chunk)]
                same = [batch.column(i).take(pa.array([row] * len(bodies))) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(range(len(bodies)), pa.int64()), pa.array(bodies)], ["id", "row", "k", "body"]
                )

    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    chunks = kept(numbered.mapInArrow(cut, f"id {kind}, row long, k long, body string"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where pre-tokens begin in the part shared with the chunk before and with the one after."""
        pattern_, white = _splitter(pattern), _splitter(r"\s")
        for batch in batches:
            heads, tails = [], []
            for k, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                begins = [match.start() for match in pattern_.finditer(body)]
                heads.append([k * chunk + at for at in begins if at < overlap])
                tails.append([k * chunk + at for at in begins if at >= chunk and not white.match(body, at - 1)])
            lists = [pa.array(part, pa.list_(pa.int64())) for part in (heads, tails)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["row", "k", "head", "tail"])

    begins = chunks.select("row", "k", "body").mapInArrow(
        split, "row long, k long, head array<long>, tail array<long>"
    )
    # One document's boundaries at a time, of the overlaps only.
    stitches = begins.selectExpr(
        "row",
        "k",
        "case when k = 0 then 0 else array_min(array_intersect(head, lag(tail) over (partition by row order by k))) end"
        " as begin",
    ).selectExpr(
        "row as of_row",
        "k as of_k",
        "begin",
        "lead(begin) over (partition by row order by k) as end",
        "bool_and(begin is not null) over (partition by row) as agree",
    )
    placed = chunks.join(kept(stitches, chunks.count()), F.expr("row = of_row and k = of_k"))
    first = F.col("begin") - F.col("k") * chunk
    pieces = placed.filter("agree").select(
        "id",
        "row",
        "k",
        F.when(
            F.col("end").isNull(), F.col("body").substr((first + 1).cast("int"), F.char_length("body"))
        ).otherwise(F.col("body").substr((first + 1).cast("int"), (F.col("end") - F.col("begin")).cast("int"))).alias("body"),
    )
    # The rest: every chunk's own characters, put together again.
    apart = (
        placed.filter("not agree")
        .groupBy("row")
        .agg(
            F.first("id").alias("id"),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("k", F.substring("body", 1, chunk).alias("own")))),
                    lambda piece: piece["own"],
                ),
                "",
            ).alias("body"),
        )
        .select("id", "row", F.lit(0).cast("long").alias("k"), "body")
    )

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(ranks_path, pattern)
        for batch in batches:
            for part in in_slices(batch, 3, SLICE):
                ids = _ids(codec, part.column(3))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], ids], ["id", "row", "k", "ids"])

    encoded = pieces.union(apart).mapInArrow(encode_pieces, f"id {kind}, row long, k long, ids array<int>")
    whole = encoded.groupBy("row").agg(
        F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("pieces")
    )
    return whole.select("id", F.flatten(F.transform("pieces", lambda piece: piece["ids"])).alias("ids"))


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes of its ``ids`` one after another."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema)}, decoded binary"
    at = encoded.columns.index("ids")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, at, SLICE // 8):
                whole = _decoded(part.column(at), ranks_path, pattern)
                yield pa.RecordBatch.from_arrays([*part.columns, whole], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(join, schema)
