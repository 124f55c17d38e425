from __future__ import annotations

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import empty_documents, odd_documents, rows_of
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(rows):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4_096)):
            part = ids[start : start + 4_096]
            yield doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


def sound(rows, capacity):
    """Sequences hold no more than they may, without gap or overlap; their number."""
    sequences = defaultdict(list)
    for length, sequence, offset in rows:
        sequences[sequence].append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def place(counts, capacity):
    return [
        (length, sequence + i, offset)
        for length, first, times, sequence, offset in packing.plan(counts, capacity).tolist()
        for i in range(times)
    ]


def fewest(lengths, capacity):
    """The least number of sequences, by trying all."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= lengths[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - lengths[i]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_fixed_sets_keep_a_best_packing(seed):
    rng = random.Random(seed)
    capacity = 20
    lengths = sorted((rng.randrange(rng.choice([1, 4, 7]), 20) for _ in range(9)), reverse=True)
    left = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    fixed = sum(times for _, times in packing.dominating_sets(left, capacity))
    rest = [n for n in range(capacity, 0, -1) for _ in range(int(left[n]))]
    assert fixed + fewest(rest, capacity) == fewest(lengths, capacity)
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows = place(counts, capacity)
    assert sorted(n for n, _, _ in rows) == sorted(lengths)
    assert sound(rows, capacity) <= fewest(lengths, capacity) + 1


def test_close_to_the_bound():
    rng = np.random.default_rng(3)
    lengths = np.minimum(4_096, rng.lognormal(6, 1, 50_000).astype(int) + 1)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    rows = place(counts, 4_096)
    assert len(rows) == len(lengths)
    for length, same in itertools.groupby(sorted(packing.plan(counts, 4_096).tolist()), key=lambda r: r[0]):
        at = 0
        for _, first, times, _, _ in same:
            assert first == at
            at += times
        assert at == counts[length]
    assert sound(rows, 4_096) <= 1.01 * lengths.sum() / 4_096 + 1


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 3)
    frame = odd_documents(spark)
    found = packing.pack(packing.pieces(frame, PATH, 1)).collect()
    expected = sorted(plain_pieces([(r["doc_id"], r["text"]) for r in frame.collect()]), key=repr)
    assert sorted((tuple(r)[:5] for r in found), key=repr) == expected
    sound([(r["length"], r["sequence_id"], r["offset"]) for r in found], 4_096)
    assert packing.pack(packing.pieces(empty_documents(spark), PATH, 1)).count() == 0


def test_query(spark, data):
    found = QUERIES["op5_best_fit_packing"](spark, data)
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(plain_pieces(map(tuple, rows)), key=repr)
    assert rows_of(found.select("doc_id", "piece", "start", "length", "ids_crc32")) == expected
    placed = [tuple(r) for r in found.select("length", "sequence_id", "offset").collect()]
    total = sum(length for length, _, _ in placed)
    assert sound(placed, 4_096) <= max(1.02 * total / 4_096, -(-total // 4_096))
