from __future__ import annotations

import random

import numpy as np
import pytest
from cases import rows_of

from ledgerloom.llm.components import components, merge


def plain(links):
    own = {}
    for a, b in links:
        if a is None or b is None or a == b:
            continue
        own.setdefault(a, a), own.setdefault(b, b)
        low, high = sorted((own[a], own[b]))
        own = {node: low if root == high else root for node, root in own.items()}
    return sorted(own.items(), key=repr)


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(1, 1), (None, 2), (3, None)],
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 50)] + [(100, i) for i in range(101, 140)],
        [(-5, 2**62), (7, -5), (7, 8), (8, 7), (7, 8)],
    ],
)
def test_shapes(spark, links):
    assert rows_of(components(spark.createDataFrame(links, "a long, b long"))) == plain(links)


def test_random(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    assert rows_of(components(spark.createDataFrame(links, "a long, b long"))) == plain(links)


def test_merge():
    rng = np.random.default_rng(1)
    left, right = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    parent = np.arange(200)
    merge(parent, left[:70], right[:70])
    merge(parent, left[70:], right[70:])
    expected = dict(plain(list(zip(left.tolist(), right.tolist()))))
    assert parent.tolist() == [expected.get(i, i) for i in range(200)]
