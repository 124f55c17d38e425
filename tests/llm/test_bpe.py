from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from cases import documents, empty_documents, odd_documents, rows_of

from ledgerloom.llm import bpe
from ledgerloom.llm.queries import QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def plain(frame):
    codec = bpe.encoding(RANKS, PATTERN)
    return sorted(((r["doc_id"], codec.encode_ordinary(r["text"] or "")) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("chunk, overlap", [(16_384, 1_024), (50, 20), (7, 5)])
def test_ids_and_round_trip(spark, chunk, overlap):
    """Chunks of all sizes, among them such that never agree with the next, give the same ids."""
    for frame in (odd_documents(spark), documents(spark, ["don't  stop \n\n it's 12345 " * 9, "x" * 400, " " * 90])):
        frame = frame.filter("length(text) < 2000 or text is null" if chunk < 100 else "true")
        encoded = bpe.encode(frame, RANKS, PATTERN, chunk=chunk, overlap=overlap)
        assert rows_of(encoded) == plain(frame)
        decoded = bpe.decode(encoded, RANKS, PATTERN)
        at_once = bpe.encode(frame, RANKS, PATTERN, chunk=chunk, overlap=overlap, decoded=True)
        assert rows_of(at_once) == rows_of(decoded)
        decoded = decoded.drop("ids")
        texts = sorted(((r["doc_id"], bytearray((r["text"] or "").encode())) for r in frame.collect()), key=repr)
        assert rows_of(decoded) == texts


def test_chunks_that_end_after_white_space(spark):
    """A chunk may start on the letter after a run of white space, or beside it."""
    runs = ["\n\n", "\t\t", "\n \n", "  ", "\u00a0\n", "\n\n\n\n"]
    frame = documents(spark, [f"{('word ' * 8).ljust(45 - len(run), 'x')}{run}bar {'more words ' * 9}" for run in runs])
    for chunk in (44, 45, 46):
        assert rows_of(bpe.encode(frame, RANKS, PATTERN, chunk=chunk, overlap=20)) == plain(frame)


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(empty_documents(spark), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_query(spark, data):
    found = rows_of(QUERIES["op7_byte_level_bpe"](spark, data))
    frame = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    expected = [
        (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
         hashlib.sha256((texts[i] or "").encode()).hexdigest())
        for i, ids in plain(frame)
    ]
    assert found == sorted(expected, key=repr)
