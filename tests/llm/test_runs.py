from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from cases import documents, empty_documents, odd_documents, rows_of

from ledgerloom.llm import runs
from ledgerloom.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(words):
    """Every run by comparing all words at every lag."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.array([numbers[word] for word in words], np.int64)
    found = []
    for lag in range(1, len(words) // 4 + 1):
        same = np.concatenate(([False], ids[lag:] == ids[:-lag], [False]))
        begins, ends = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
        for start, end in zip(begins.tolist(), ends.tolist()):
            length = end - start + lag
            inside = ids[start : start + length]
            if length >= max(6, 4 * lag) and not any((inside[p:] == inside[:-p]).all() for p in range(1, lag)):
                found.append((start, length, lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def expected(doc_id, text):
    words = words_of(text)
    found = plain(words)
    return doc_id, len(words), found, plain_collapsed(words, found)


def found_rows(frame):
    rows = runs.periodic_runs(frame).collect()
    return sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows), key=repr)


def made_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        alphabet = rng.choice([1, 2, 3, 9])
        words = [chr(97 + rng.randrange(alphabet)) for _ in range(rng.randrange(50))]
        for _ in range(rng.randrange(3)):
            unit = [chr(97 + rng.randrange(alphabet)) for _ in range(1 + rng.randrange(9))]
            words += (unit * 6)[: rng.randrange(len(unit) * 6)] + ["x"] * rng.randrange(2)
        texts.append(rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t", " \n "]).join(words) + rng.choice(["", " "]))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    texts = made_texts(seed)
    assert found_rows(documents(spark, texts)) == sorted((expected(i, t) for i, t in enumerate(texts)), key=repr)


def test_runs_that_share_words(spark):
    texts = ["a a a a a a b a a a a a a b a a a a a a b a a a a a a b a", "a b a b a b a b a c a c a c a c a", "p q r " * 4]
    assert found_rows(documents(spark, texts)) == sorted((expected(i, t) for i, t in enumerate(texts)), key=repr)


def test_long_texts(spark):
    """One word a million times, a long period, and no repeats: in proportion to the words."""
    period = " ".join(str(i) for i in range(50_000))
    texts = ["a " * 1_000_000, f"{period} " * 5, " ".join(str(i) for i in range(300_000))]
    rows = found_rows(documents(spark, texts))
    assert [row[2] for row in rows] == [[(0, 1_000_000, 1)], [(0, 250_000, 50_000)], []]
    assert rows[0][3] == "a" and rows[1][3] == period


def test_odd_rows_and_empty_table(spark):
    frame = odd_documents(spark)
    rows = [expected(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    assert found_rows(frame) == sorted(rows, key=repr)
    assert found_rows(empty_documents(spark)) == []


def edited(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query(spark, data):
    rows = []
    for doc_id, text in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        words = edited(doc_id, text)
        found = plain(words)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        s, n, q = min(found, key=lambda run: (-run[1], run[0], run[2])) if found else (None,) * 3
        rows.append(
            (doc_id, len(found), s, n, q, None if s is None else 1000 * n // q, sha256(lines.encode()).hexdigest(),
             sha256(plain_collapsed(words, found).encode()).hexdigest())
        )
    assert rows_of(QUERIES["op11_periodic_runs"](spark, data)) == sorted(rows, key=repr)
    assert any(row[1] for row in rows)
