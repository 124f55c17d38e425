from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from cases import documents, empty_documents, odd_documents, rows_of

from ledgerloom.llm import lexical
from ledgerloom.llm.queries import QUERIES, SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, best=10):
    """All scores of all pairs, ranked."""
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    rows = []
    for item, terms in wanted.items():
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * len(counts) // total
            parts = [
                math.floor(1000 * math.log((2.0 * len(counts) + 2) / (2.0 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms if t in c
            ]
            scores.append((-sum(parts), i is None, i or 0, i))
        rows += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(s for s in scores if s[0] < 0)[:best])]
    return sorted(rows, key=repr)


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def words(rng, n, vocabulary):
    return " ".join(f"{rng.choice(['w', 'W', 'é'])}{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}" for _ in range(n))


@pytest.mark.parametrize("seed, tree, cells", [(1, 4_096, 4_000_000), (2, 37, 300), (3, 5, 40)])
def test_against_brute_force(spark, monkeypatch, seed, tree, cells):
    """Trees and blocks of several sizes, ties, copies and documents without terms."""
    monkeypatch.setattr(lexical, "TREE_DOCUMENTS", tree)
    monkeypatch.setattr(lexical, "CELLS", cells)
    rng = random.Random(seed)
    texts = [words(rng, rng.randrange(30), 40) for _ in range(400)] + ["same words here w1"] * 30 + [None, "", "?!"]
    rng.shuffle(texts)
    asked = [words(rng, rng.randrange(12), 60) for _ in range(30)] + ["SAME words", "", None, "nothing of this"]
    found = lexical.search(documents(spark, texts).repartition(3), items_of(spark, asked))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == plain(list(enumerate(texts)), list(enumerate(asked)))


def test_levels_hold_the_largest():
    rows = np.random.default_rng(4).integers(0, 50, (70, 9))
    for level, nodes in enumerate(lexical.levels(rows)):
        wide = lexical.FAN**level
        assert all((nodes[i] == rows[i * wide : (i + 1) * wide].max(axis=0)).all() for i in range(len(nodes)))


def test_whole_numbers_beyond_doubles(spark, monkeypatch):
    monkeypatch.setattr(lexical, "EXACT", 0)
    rng = random.Random(8)
    texts, asked = [words(rng, 20, 30) for _ in range(80)], [words(rng, 6, 30) for _ in range(9)]
    assert rows_of(lexical.search(documents(spark, texts), items_of(spark, asked))) == plain(
        list(enumerate(texts)), list(enumerate(asked))
    )


def test_a_document_met_twice_counts_once():
    """A task that runs again in the same worker must not raise what an item has already."""
    known = lexical.Found(1, 2)
    known.add(0, 50, 1)
    known.add(0, 50, 1)
    assert known.weakest[0] == 0
    known.add(0, 40, 2)
    assert known.weakest[0] == 40 and known.weakest_id[0] == 2


def test_odd_rows_and_empty_tables(spark):
    frame = odd_documents(spark)
    items = items_of(spark, ["word", "two words", "東京 emoji", None, "no id here"]).selectExpr("*", "1 as doc", "2 as item", "3 as score")
    docs = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    assert rows_of(lexical.search(frame, items)) == plain(docs, asked)
    assert lexical.search(empty_documents(spark), items).count() == 0
    assert lexical.search(frame, items.limit(0)).count() == 0


def test_query(spark, data):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"create view {table} as select * from '{data}/{table}.parquet'")
    expected = sorted(duck.sql(SQL["op13_ranked_search"]).fetchall(), key=repr)
    assert rows_of(QUERIES["op13_ranked_search"](spark, data)) == expected
    read = {t: [tuple(r) for r in spark.read.parquet(f"{data}/{t}.parquet").select(k, "text").collect()]
            for t, k in (("documents", "doc_id"), ("benchmark", "item_id"))}
    assert expected == plain(read["documents"], read["benchmark"])
