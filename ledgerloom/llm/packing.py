"""Packing documents into sequences of bounded length: dominance reduction, then best fit."""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import FILE_ROWS, crc32_of, give_back, hold, in_slices, kept, or_empty
from ledgerloom.llm.word_cache import SpacedWords, encoder, with_ends

# Bytes of text encoded together: beyond it a worker takes more memory and no less time.
SLICE = 700_000
CAPACITY = 4_096
# Pieces of one length numbered in one task.
NUMBERED = 50_000


def pieces(documents: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece`` (from 0), ``start``, ``length`` and ``ids_crc32`` of all pieces.

    A document is its text's ids and ``end_id``; only one longer than ``capacity`` is cut. A null or
    empty text is the end id alone. Rows that repeat an id are documents of their own, an empty
    table has no pieces, and other columns are not looked at.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("packing", encoder.cache_clear)
        codec = encoder(tokenizer_path, SpacedWords)
        for batch in batches:
            for some in in_slices(batch, 1, SLICE):
                flat, counts = codec.encode(some.column(1))
                flat = with_ends(flat, counts, end_id)
                counts = counts + 1
                number = -(-counts // capacity)
                document = np.repeat(np.arange(len(counts)), number)
                piece = np.arange(len(document)) - np.repeat(np.cumsum(number) - number, number)
                length = np.minimum(capacity, counts[document] - piece * capacity)
                at = np.repeat(np.cumsum(counts) - counts, number) + piece * capacity
                crcs = [crc32_of(flat[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
                columns = [
                    some.column(0).take(pa.array(document)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array(length),
                    pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", or_empty(F.col("text")).alias("text"))
    return texts.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``: each row's place in as few sequences as found.

    Rows need a ``length`` from 1 to ``capacity``; rows of equal length are interchangeable, so the
    packing is made for the count of each length, at most ``capacity`` numbers however many rows
    there are, and says which sequences the n-th row of a length goes to. Rows are numbered within
    their length by shares of NUMBERED rows, so that no length weighs on one task.
    """
    spark = parts.sparkSession
    rows = kept(parts)
    counts = {row["length"]: row["count"] for row in rows.groupBy("length").count().collect()}
    if not counts:
        return rows.selectExpr("*", "0L as sequence_id", "0L as offset")
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    others = [name for name in rows.columns if name != "length"]
    shares = F.array(*[F.lit(-(-counts.get(n, 0) // NUMBERED)) for n in range(capacity + 1)])
    dealt = rows.withColumn(
        "_share", F.pmod(F.xxhash64(*others), F.element_at(shares, (F.col("length") + 1).cast("int"))).cast("int")
    )
    # A row per length and share.
    bases = kept(
        dealt.groupBy("length", "_share")
        .count()
        .selectExpr(
            "length as _of_length",
            "_share as _of_share",
            "sum(count) over (partition by length order by _share) - count as _before",
        ),
        capacity + sum(counts.values()) // NUMBERED,
    )
    numbered = dealt.selectExpr(
        "*", f"row_number() over (partition by length, _share order by {', '.join(f'`{c}`' for c in others)}) as _rank"
    )
    at = numbered.join(bases, F.expr("length = _of_length and _share = _of_share")).withColumn(
        "_number", F.col("_before") + F.col("_rank") - 1
    )
    runs = plan(counts, capacity)
    key = runs[:, 0] * (max(counts.values()) + 1) + runs[:, 1]
    order = np.argsort(key)
    runs, key, width = runs[order], key[order], max(counts.values()) + 1
    columns = parts.columns
    length_at, number_at = columns.index("length"), len(columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(length_at).to_numpy(zero_copy_only=False)
            number = batch.column(number_at).to_numpy(zero_copy_only=False)
            run = np.searchsorted(key, length * width + number, side="right") - 1
            sequence = runs[run, 3] + number - runs[run, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(runs[run, 4])], [*columns, "sequence_id", "offset"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    at = at.coalesce(1 + sum(counts.values()) // FILE_ROWS)
    return at.select(*[f"`{c}`" for c in columns], "_number").mapInArrow(
        place, f"{schema}, sequence_id long, offset long"
    )


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first number, rows, first sequence, offset): the rows of that length from that
    number on go one each to the sequences from that one on, at that offset."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    used = np.zeros_like(left)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, times: int, sequence: int, offset: int) -> None:
        runs.append((length, int(used[length]), times, sequence, offset))
        used[length] += times

    for members, times in dominating_sets(left, capacity):
        for i, length in enumerate(members):
            put(length, times, sequences, sum(members[:i]))
        sequences += times
    # The rest, longest first, each into the fullest sequence that has room for it.
    open_runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []

    def add(room: int, first: int, count: int) -> None:
        if not open_runs[room]:
            bisect.insort(rooms, room)
        open_runs[room].append((first, count))

    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fresh = -(-count // (capacity // length))
                add(capacity, sequences, fresh)
                sequences += fresh
                at = len(rooms) - 1
            room = rooms[at]
            first, there = open_runs[room].pop()
            times = min(count, there)
            put(length, times, first, capacity - room)
            if times < there:
                open_runs[room].append((first + times, there - times))
            elif not open_runs[room]:
                del rooms[at]
            if room > length:
                add(room - length, first, times)
            count -= times
    return np.array(runs, np.int64).reshape(-1, 5)


def dominating_sets(left: np.ndarray, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Sets of lengths, with how often, that some best packing holds; taken out of ``left``.

    A set dominates another with the same longest member if the other's members can be exchanged for
    parts of it; a set that dominates all others with a member may be fixed.
    """
    changed = True
    while changed:
        changed = False
        for length in range(capacity, 0, -1):
            while left[length]:
                members = _dominating(left, length, capacity - length)
                if not members:
                    break
                times = min(int(left[m]) // members.count(m) for m in members)
                for m in members:
                    left[m] -= times
                yield members, times
                changed = True


def _dominating(left: np.ndarray, length: int, room: int) -> tuple[int, ...] | None:
    """The set of up to three lengths that dominates all sets with ``length``, if there is one.

    Taking rows away only takes away alternatives, so a set holds as often as its members last.
    """
    left[length] -= 1
    lengths = np.flatnonzero(left)
    smallest = np.repeat(lengths[:3], np.minimum(left[lengths[:3]], 3))[:3].tolist()
    fits = lengths[lengths <= room]
    sets: tuple[int, ...] | None = None
    if not len(fits):
        sets = (length,)
    else:
        best = int(fits[-1])
        second = fits[fits <= room - best]
        if best == room or len(smallest) < 2 or sum(smallest[:2]) > room:
            # It leaves nothing, or nothing fits beside a second member.
            sets = (length, best)
        elif len(smallest) < 3 or sum(smallest) > room:
            # Two more members at most.
            pairs = _pairs(left, fits, room)
            if not pairs or best >= max(a + b for a, b in pairs):
                sets = (length, best)
            else:
                second = [int(b) for b in second if b != best or left[best] > 1]
                if second and all(min(pair) <= second[-1] for pair in pairs):
                    sets = (length, best, second[-1])
    left[length] += 1
    return sets


def _pairs(left: np.ndarray, fits: np.ndarray, room: int) -> list[tuple[int, int]]:
    """For each length the longest that fits beside it, two different rows each."""
    found = []
    for a in fits.tolist():
        beside = fits[fits <= room - a]
        if len(beside) and beside[-1] == a and left[a] < 2:
            beside = beside[:-1]
        if len(beside):
            found.append((a, int(beside[-1])))
    return found
