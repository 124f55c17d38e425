from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from cases import documents, empty_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components
from ledgerloom.llm.queries import QUERIES


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [word for word in lowered.split(" ") if word]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(prints, ids, distance=3):
    """Component by brute force: smallest id reachable, per row."""
    own = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance and own[i] != own[j]:
                gone, stays = own[i], own[j]
                own = [stays if x == gone else x for x in own]
    lowest = {g: min((ids[k] for k in range(len(ids)) if own[k] == g and ids[k] is not None), default=None) for g in own}
    return [lowest[g] for g in own]


def expected(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    ids = [i for i, _ in rows]
    return sorted(((i, f"{p:016x}", g) for i, p, g in zip(ids, prints, groups(prints, ids))), key=repr)


def near_copies(rng, count):
    base = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 5) for _ in range(200)) for _ in range(8)]
    texts = []
    for _ in range(count):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    return texts


def test_matches_brute_force(spark):
    texts = near_copies(random.Random(1), 150) + ["Same Text here"] * 5 + ["same text HERE", None, "", " "]
    frame = documents(spark, texts, first=10)
    found = simhash.near_duplicates(frame)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    assert rows_of(found.select("doc_id", digits, "component_id")) == expected(list(enumerate(texts, 10)))


def test_odd_rows(spark):
    frame = odd_documents(spark)
    found = simhash.near_duplicates(frame).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")), "component_id"
    )
    assert rows_of(found) == expected([(r["doc_id"], r["text"]) for r in frame.collect()])
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


def test_keeps_one_of_each_group(spark):
    frame = odd_documents(spark)
    stays = simhash.keep_one(frame)
    assert stays.columns == frame.columns
    groups_there = simhash.near_duplicates(frame).select("root").distinct().count()
    assert stays.count() == groups_there
    assert simhash.keep_one(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("nodes", [3, 40])
def test_trees_of_a_large_shard(spark, monkeypatch, nodes):
    """Many fingerprints in one shard, cut into several trees, and forests of few rows."""
    monkeypatch.setattr(simhash, "TREE_NODES", nodes)
    rng = random.Random(nodes)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(48)
        for _ in range(30):
            value = centre
            for _ in range(rng.randrange(5)):
                value ^= 1 << rng.randrange(48)
            prints.add(value)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p,) for p in prints], "print long").repartition(3)
    links = simhash.fingerprint_links(frame)
    for a, b in rows_of(links):
        assert a > b or b > a
    roots = {row["node"]: row["root"] for row in components(links).collect()}
    assert [roots.get(p, p) for p in prints] == groups(prints, prints)


def test_forest_in_small_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "FOREST_ROWS", 10)
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = np.random.default_rng(2)
    prints = np.unique(rng.integers(0, 2**8, 60))
    order = [prints, np.zeros_like(prints), np.zeros_like(prints), np.zeros_like(prints), np.arange(len(prints)) >= 20]
    batches = pa.table(order, names=list("pbvtq")).to_batches(max_chunksize=7)
    parent = {int(p): int(p) for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in simhash._search(iter(batches), 1):
        for x, y in zip(a.tolist(), b.tolist()):
            parent[top(x)] = top(y)
    for i in prints[:20].tolist():
        for j in prints.tolist():
            if bin(i ^ j).count("1") <= 1:
                assert top(i) == top(j)


def test_query(spark, data):
    found = QUERIES["op1_simhash_near_duplicates"](spark, data)
    documents_there = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(found.select("doc_id", "fingerprint", "component_id")) == expected([tuple(r) for r in documents_there])
