from __future__ import annotations

import random
from hashlib import sha256

import pytest
import xxhash
from cases import documents, empty_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprints, neighbours
from ledgerloom.llm.queries import QUERIES

MASK = 2**64 - 1


def shingles(text, words=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = [p for p in (text or "").translate(lower).translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if p]
    if len(parts) < words:
        return {tuple(parts)} if parts else set()
    return {tuple(parts[i : i + words]) for i in range(len(parts) - words + 1)}


def plain_hash(shingle):
    value = 0
    for word in shingle:
        value = (value * 0x9E3779B97F4A7C15 + xxhash.xxh64_intdigest(word, 42)) & MASK
    for shift, factor in fingerprints._MIX:
        value = ((value ^ (value >> shift)) * factor) & MASK
    return value


def plain_sketch(text, size=128):
    return sorted({plain_hash(one) for one in shingles(text)})[:size]


def in_bytes(hashes):
    return b"".join(one.to_bytes(8, "big") for one in hashes)


def plain_resemblance(a, b, size=128):
    both = sorted(set(a) | set(b))[:size]
    return len([one for one in both if one in set(a) and one in set(b)]) / len(both) if both else 1.0


def test_sketches(spark):
    frame = odd_documents(spark)
    found = fingerprints.fingerprints(frame)
    assert found.columns == ["doc_id", "sketch", "distinct_shingles"]
    rows = sorted(((r["doc_id"], bytes(r["sketch"])) for r in found.collect()), key=repr)
    texts = frame.select("doc_id", "text").collect()
    assert rows == sorted(((r["doc_id"], in_bytes(plain_sketch(r["text"]))) for r in texts), key=repr)
    assert fingerprints.fingerprints(empty_documents(spark)).count() == 0


def word_texts(rng, many, words):
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(many)]


def test_estimates(spark):
    """Resemblance, containment and the number of shingles, near the truth over texts that share words."""
    rng = random.Random(3)
    texts = []
    for first, second, own in zip(word_texts(rng, 60, 700), word_texts(rng, 60, 300), word_texts(rng, 60, 200)):
        texts += [(f"{first} {second}", f"{first} {own}")]
    frame = spark.createDataFrame(texts, "a string, b string").select(
        "a", "b", fingerprints.sketches([F.col("a"), F.col("b")]).alias("of")
    )
    a, b = F.col("of.sketch_0"), F.col("of.sketch_1")
    rows = frame.select(
        "a", "b", fingerprints.resemblance(a, b).alias("r"), fingerprints.containment(a, b).alias("c"),
        fingerprints.distinct_shingles(a).alias("n"),
    ).collect()
    off = {"r": 0.0, "c": 0.0, "n": 0.0}
    for row in rows:
        left, right = shingles(row["a"]), shingles(row["b"])
        off["r"] += row["r"] - len(left & right) / len(left | right)
        off["c"] += row["c"] - len(left & right) / len(left)
        off["n"] += row["n"] / len(left) - 1
        assert abs(row["r"] - len(left & right) / len(left | right)) < 0.2
    assert all(abs(total / len(rows)) < 0.02 for total in off.values())


def test_merging(spark):
    """The sketch of a group is that of all its shingles, however the rows are dealt out."""
    rng = random.Random(5)
    texts = word_texts(rng, 40, 60) + ["", None, "one"]
    frame = documents(spark, texts).withColumn("group", F.when(F.col("doc_id") < 35, "hot").when(F.col("doc_id") < 41, "b"))
    sketches = frame.select("group", fingerprints.sketch(F.col("text")).alias("sketch"))
    merged = {r["group"]: bytes(r["sketch"]) for r in fingerprints.merged(sketches.repartition(7), ["group"]).collect()}
    expected = {}
    for row in frame.collect():
        expected.setdefault(row["group"], set()).update(plain_hash(one) for one in shingles(row["text"]))
    assert merged == {group: in_bytes(sorted(hashes)[:128]) for group, hashes in expected.items()}
    one = fingerprints.merged(sketches.filter("length(sketch) = 0"), ["group"]).collect()
    assert [bytes(row["sketch"]) for row in one] == [b""] * len(one) and one


def plain_next(rows):
    """Descending ids, nulls last; the order among equal ids is checked apart."""
    rows = sorted(rows, key=lambda row: (row[0] is None, -(row[0] or 0)))
    return [(i, t or "", rows[(n + 1) % len(rows)][1] or "") for n, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("parts", ["1", "2", "7", "40"])
def test_next_document(spark, parts):
    ids = [5, -3, 2**62, -(2**63), 11, 12, 13, 14, 15, 16, 2**63 - 1, 0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for some in (ids, ids[:2], ids[:1], []):
            rows = [(i, f"text {i}" if i != 12 else None) for i in some]
            frame = spark.createDataFrame(rows, "doc_id long, text string")
            assert rows_of(neighbours.with_next(frame)) == sorted(plain_next(rows), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_next_of_equal_ids(spark):
    """Whatever the parts, all rows follow each other in one circle."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = [(7, f"t{i % 5}") for i in range(60)] + [(None, f"n{i % 3}") for i in range(20)] + [(i, f"o{i}") for i in range(9)]
    for parts in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = neighbours.with_next(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
        assert sorted((r["doc_id"], r["text"]) for r in found if r["doc_id"] is not None) == sorted(r for r in rows if r[0] is not None)
        assert sorted(r["next_text"] for r in found) == sorted(r["text"] for r in found)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    odd = odd_documents(spark)
    assert neighbours.with_next(odd).count() == odd.count()


def test_query(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text, following in plain_next([tuple(r) for r in rows]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = plain_sketch(text), plain_sketch(edited), plain_sketch(following)
        expected.append(
            (doc_id, len(text), sha256(edited.encode()).hexdigest(), in_bytes(own).hex(), in_bytes(other).hex(),
             plain_resemblance(own, other), plain_resemblance(own, after))
        )
    assert rows_of(QUERIES["op12_document_fingerprints"](spark, data)) == sorted(expected, key=repr)
