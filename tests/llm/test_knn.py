from __future__ import annotations

import math
import random

import pytest
from cases import rows_of
from pyspark.sql import functions as F

from ledgerloom.llm import knn
from ledgerloom.llm.queries import QUERIES, SQL

VECTORS = "vec_id long, embedding array<double>, label int"


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def plain(rows, is_query, k=5):
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for query, q in rows:
        if is_query(query):
            scored = sorted(
                (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), i)
                for i, v in rows
                if i != query and len(v) == len(q)
            )
            out += [(query, rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, every=3, **options):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).repartition(3)
    clash = frame.withColumns({"cell": F.lit("x"), "rows": F.lit(1), "score": F.lit(1)})
    vectors = clash.withColumn("vector", knn.quantised(F.col("embedding")))
    return sorted(rows_of(knn.nearest(vectors, F.col("vec_id") % every == 0, **options)))


@pytest.mark.parametrize("seed", range(4))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 3) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(250):
        spread = rng.choice([0, 0.01, 0.3, 2])
        rows.append((i, [round(c + rng.gauss(0, spread), 2) for c in rng.choice(centres)]))
    assert found(spark, rows, pivots=[1, 4, 16, 60][seed]) == plain(rows, lambda i: i % 3 == 0)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 2)
    rng = random.Random(9)
    rows = [(i, [rng.random() for _ in range(3)]) for i in range(80)]
    assert found(spark, rows, pivots=2) == plain(rows, lambda i: i % 3 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(20)] + [(0, same), (6, same), (6, [0.0, 0.0, 0.0]), (None, same), (21, None)]
    rows += [(24, [nan, 1.0, 1.0]), (27, [None, 1.0, 1.0]), (30, [inf, 1.0, 1.0]), (33, [1.0, 2.0]), (34, [2.0, 1.0])]
    rows += [(36, []), (39, []), (42, [1e30, 1.0, 1.0]), (45, [-1e30, 3.0, 0.5]), (48, [1.0] * 9)]
    # Components beyond a long are the nearest long, as the sum of products is.
    near = [(i, v if v is None else [x if x is None or not math.isfinite(x) else max(-(2.0**55), min(2.0**55, x)) for x in v]) for i, v in rows]
    expected = [row for row in plain(near, lambda i: i % 3 == 0) if row[0] not in (42, 45)]
    assert [row for row in found(spark, rows) if row[0] not in (42, 45)] == expected
    assert found(spark, []) == []
    assert found(spark, [(1, same), (2, same)]) == []
    assert found(spark, [(3, same)]) == []


def test_scores_beyond_doubles():
    import numpy as np

    left, right = np.array([[2**31 - 1, 3]]), np.array([[2**31 - 1, 1], [-(2**31), 5]])
    assert knn._products(left, right).tolist() == [[(2**31 - 1) ** 2 + 3, -(2**31) * (2**31 - 1) + 15]]
    huge = np.array([[2**62, 2**62]])
    assert knn._products(huge, huge).tolist() == [[2**63 - 1]]


def test_query(spark, data, duck):
    duck.execute(f"create view embeddings as select * from '{data}/embeddings.parquet'")
    expected = sorted(duck.sql(SQL["op2_exact_top_k"]).fetchall())
    assert sorted(rows_of(QUERIES["op2_exact_top_k"](spark, data))) == expected
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert expected == plain(rows, lambda i: i % 50 == 0)
