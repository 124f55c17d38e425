from __future__ import annotations

import math
import random

import numpy as np
import pytest
from cases import rows_of
from pyspark.sql import functions as F

from ledgerloom.llm import embeddings, hnsw
from ledgerloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, cosine=0.93):
    def good(vector, label):
        finite = vector is not None and all(x is not None and math.isfinite(x) for x in vector)
        return label is not None and finite and any(vector)

    own = list(range(len(rows)))
    links = [0] * len(rows)
    units = [np.array(v) / np.linalg.norm(v) if good(v, label) else None for _, v, label in rows]
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is None or units[j] is None or rows[i][2] != rows[j][2] or len(units[i]) != len(units[j]):
                continue
            if units[i] @ units[j] >= cosine:
                links[i] += 1
                links[j] += 1
                gone, stays = own[i], own[j]
                own = [stays if x == gone else x for x in own]
    lowest = {}
    for (i, _, _), g in zip(rows, own):
        lowest[g] = min((x for x in (lowest.get(g), i) if x is not None), default=None)
    return sorted(((i, n, lowest[g], i is not None and i == lowest[g]) for (i, _, _), n, g in zip(rows, links, own)), key=repr)


def clustered(rng, count, size=12):
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(12)]
    rows = []
    for i in range(count):
        spread = rng.choice([0, 0.02, 0.2, 0.3, 1])
        rows.append((i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([1, 1, 2])))
    return rows


@pytest.mark.parametrize("shard_rows", [1_000, 40, 7])
def test_matches_brute_force(spark, shard_rows):
    rows = clustered(random.Random(shard_rows), 240)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit("x"), "shard": F.lit(1), "size": F.lit(2)})
    assert rows_of(embeddings.near_duplicates(frame, shard_rows=shard_rows)) == plain(rows)


def test_pairs_of_shards_are_dealt_out(spark, tmp_path, monkeypatch):
    """Few vectors, but several pairs of shards: the search is not one task."""
    links, folder = embeddings._links, str(tmp_path)

    def noted(*given):
        from pathlib import Path

        from pyspark import TaskContext

        Path(folder, str(TaskContext.get().partitionId())).touch()
        return links(*given)

    monkeypatch.setattr(embeddings, "_links", noted)
    kept = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        for name, value in zip(kept, ("false", "8")):
            spark.conf.set(name, value)
        rows = clustered(random.Random(3), 200)
        found = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), shard_rows=20)
        assert rows_of(found) == plain(rows)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert len(list(tmp_path.iterdir())) > 2


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [1.0, 0.0], None)]
    rows += [(5, [0.0, 0.0], 1), (6, [0.0, 0.0], 1), (7, None, 1), (8, [nan, 1.0], 1), (9, [None, 1.0], 1), (10, [inf, 1.0], 1)]
    rows += [(None, [2.0, 0.01], 1), (None, [0.0, 1.0], 1), (None, None, None), (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 2)]
    rows += [(13, [], 1), (14, [1e300, 1e300], 3), (15, [1e-300, 1e-300], 3), (16, [-1.0, -1.0], 3), (17, [-0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    scaled = [(i, [x * 1e-200 if abs(x) > 1e200 else x * 1e200 if 0 < abs(x) < 1e-200 else x for x in v] if i in (14, 15) else v, label) for i, v, label in rows]
    assert rows_of(embeddings.near_duplicates(frame)) == plain(scaled)
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def big_group(rng):
    """Many more links than a beam holds, beside vectors that link with little."""
    centre = rng.normal(size=24)
    close = centre + rng.normal(size=(700, 24)) * 0.12
    return np.concatenate([close, rng.normal(size=(1_500, 24))])


def test_links_beyond_the_beam():
    vectors = big_group(np.random.default_rng(3))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = hnsw.build(unit.astype(np.float32))
    row = {"graph": graph.to_bytes(), "nodes": np.arange(len(unit)).tobytes(), "shard": 0, "of": 0,
           "weights": np.ones(len(unit), np.int64).tobytes(), "vectors": vectors.tobytes()}
    found = embeddings._links(row, row, 0.93, 32)
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    counts = np.zeros(len(unit), np.int64)
    counts[found["node"]] = found["links"]
    assert near.sum() > 20_000
    assert np.minimum(counts, near.sum(axis=1)).sum() >= 0.99 * near.sum()
    assert (counts <= near.sum(axis=1)).all()


@pytest.mark.parametrize("beam, least", [(16, 0.8), (64, 0.95)])
def test_recall_of_the_graph(beam, least):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3_000, 16))
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    graph = hnsw.Graph.from_bytes(hnsw.build(unit).to_bytes())
    found, near = graph.search(unit[:500], beam)
    best = np.argsort(-(unit[:500] @ unit.T), axis=1)[:, :5]
    assert np.mean([len(set(b) & set(f)) / 5 for b, f in zip(best.tolist(), found.tolist())]) >= least
    assert (found >= 0).all() and np.allclose(near, np.einsum("qd,qkd->qk", unit[:500], unit[found]), atol=1e-5)
    for few in (0, 1, 2, 5):
        small = hnsw.build(unit[:few])
        if few:
            assert set(small.search(unit[:3], few)[0].ravel().tolist()) == set(range(few))


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows_of(QUERIES["op3_embedding_near_duplicates"](spark, data)) == plain(rows)
