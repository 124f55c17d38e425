"""Near-duplicate embeddings: a small-world graph per shard, audited, and components of the links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import hnsw
from ledgerloom.llm.common import kept
from ledgerloom.llm.components import components, merge

COSINE = 0.93
# Distinct vectors of a shard: one graph, which a task holds whole.
SHARD_ROWS = 20_000
# Nodes looked for per query at first, and by how much that is widened before all nodes are compared.
BEAM = 64
WIDER = (1, 4)
# Queries per pair of shards whose links are also found by comparing all, and the share to be found.
AUDITED = 64
RECALL = 0.98


def usable(vector: Column) -> Column:
    """Whether all components are there and finite, and not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS, beam: int = BEAM
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vec_id``, ``embedding``
    (array of numbers) and ``label``.

    Rows of equal label and length whose cosine, in double precision, is at least ``cosine`` are
    linked; ``n_links`` counts a row's links and ``component_id`` is the smallest id reachable, null
    ids left out. Rows with a null label or a vector that is null, zero or holds null or non-finite
    components link with nothing, not even their copies, and are their own component. Rows that
    repeat an id are rows of their own; ``kept`` is ``vec_id = component_id``, false for a null id.
    An empty table gives no rows, and other columns are not looked at.

    Equal vectors are one node with a weight. A label's nodes are cut into shards by hash; each shard
    has a graph, and each pair of shards is a task: one's vectors query the other's graph. Links
    are counted there; what leaves the task are counts and a forest of the links.
    """
    rows = embeddings.select(
        F.col("vec_id"),
        F.when(F.col("label").isNotNull() & usable(F.col("embedding")), F.col("embedding").cast("array<double>")).alias("vector"),
        F.col("label"),
    )
    linkable = rows.filter(F.col("vector").isNotNull())
    classes = kept(
        linkable.groupBy("label", "vector")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    number = classes.count()
    sized = classes.select("label", F.size("vector").alias("size"), "node", "weight", "vector")
    shards = (
        sized.groupBy(F.col("label").alias("of_label"), F.col("size").alias("of_size"))
        .count()
        .withColumn("shards", F.ceil(F.col("count") / shard_rows).cast("int"))
        .drop("count")
    )
    placed = sized.join(shards, F.expr("label = of_label and size = of_size")).withColumn(
        "shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")
    )
    label = embeddings.schema["label"].dataType.simpleString()

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        vectors = np.stack(group["vector"].to_numpy()).astype(np.float64)
        # Scaled first, so that the length of a very large or small vector can be taken.
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        graph = hnsw.build((vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32))
        first = group.iloc[0]
        row = {name: first[name] for name in ("label", "size", "shards", "shard")}
        row |= {
            "graph": graph.to_bytes(),
            "nodes": group["node"].to_numpy(np.int64).tobytes(),
            "weights": group["weight"].to_numpy(np.int64).tobytes(),
            "vectors": vectors.tobytes(),
        }
        return pd.DataFrame([row])

    schema = f"label {label}, size int, shards int, shard int, graph binary, nodes binary, weights binary, vectors binary"
    graphs = kept(placed.groupBy("label", "size", "shard").applyInPandas(build, schema))
    # Every pair of shards once, a shard with itself too.
    held = graphs.withColumn("of", F.explode(F.sequence(F.col("shard"), F.col("shards") - 1)))
    asking = graphs.select(
        "label", "size", F.explode(F.sequence(F.lit(0), F.col("shard"))).alias("shard"), F.col("shard").alias("of"),
        "nodes", "weights", "vectors",
    )
    keys = ["label", "size", "shard", "of"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _links(left.iloc[0], right.iloc[0], cosine, beam)

    # Pairs of shards are the work: as many tasks as the exchange has, whatever the number of rows.
    found = kept(
        held.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(search, "node long, links long, other long")
    )
    counted = found.groupBy(F.col("node").alias("of_node")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = kept(
        classes.select("node", "first_id")
        .join(roots.withColumnRenamed("node", "named"), F.col("node") == F.col("named"), "left")
        .select("node", "first_id", F.coalesce("root", "node").alias("root")),
        number,
    )
    smallest = kept(rooted.groupBy(F.col("root").alias("top")).agg(F.min("first_id").alias("component_id")), number)
    named = rooted.join(smallest, F.col("root") == F.col("top")).select(F.col("node").alias("its"), "component_id")
    answers = kept(
        classes.join(kept(named, number), F.col("node") == F.col("its"))
        .join(counted, F.col("node") == F.col("of_node"), "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("vector").alias("of_vector"),
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            "component_id",
        )
    )
    return (
        rows.join(answers, F.expr("vector = of_vector and label = of_label"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _links(held: pd.Series, asking: pd.Series, cosine: float, beam: int) -> pd.DataFrame:
    """Links between the nodes of two shards, or within one: for each node how many rows it is linked
    to, and for each node that is not the first of what it is connected with here, that first."""
    graph = hnsw.Graph.from_bytes(held["graph"])
    nodes, weights = (np.frombuffer(held[name], np.int64) for name in ("nodes", "weights"))
    vectors = _unit(np.frombuffer(held["vectors"], np.float64).reshape(len(nodes), -1))
    own = held["shard"] == asking["of"]
    other_nodes, other_weights = (np.frombuffer(asking[name], np.int64) for name in ("nodes", "weights"))
    queries = _unit(np.frombuffer(asking["vectors"], np.float64).reshape(len(other_nodes), -1))
    # In one shard the queries are the nodes; else they come after them.
    shift = 0 if own else len(nodes)
    parent = np.arange(shift + len(queries))
    counts = np.zeros(len(parent), np.int64)
    todo = np.arange(len(queries))
    audited = np.random.default_rng(len(queries)).permutation(len(queries))[:AUDITED]
    pairs = [(todo[:0], todo[:0])]
    for factor in WIDER:
        # Those whose whole beam is linked may have more links; the others are audited.
        asked, hit, full = _beam_links(graph, vectors, queries, todo, cosine, beam * factor, own)
        checked = np.setdiff1d(np.intersect1d(audited, todo), full)
        if _share_found(asked, vectors, queries[checked], checked, cosine, own) >= RECALL:
            pairs.append((asked, hit))
            todo = full
    left, right = (np.concatenate(side) for side in zip(*pairs))
    if own:
        # Both may have found the link, or one; and what is compared with all finds its links below.
        apart = ~(np.isin(left, todo) | np.isin(right, todo))
        code = np.unique(np.minimum(left, right)[apart] * len(nodes) + np.maximum(left, right)[apart])
        left, right = np.divmod(code, max(1, len(nodes)))
    np.add.at(counts, left + shift, weights[right])
    np.add.at(counts, right, other_weights[left])
    merge(parent, left + shift, right)
    compared = np.zeros(len(nodes), bool)
    if own:
        compared[todo] = True
    for at in range(0, len(todo), 256):
        some = todo[at : at + 256]
        near = queries[some] @ vectors.T >= cosine
        if own:
            near[np.arange(len(some)), some] = False
        line, right = np.nonzero(near)
        left = some[line]
        np.add.at(counts, left + shift, weights[right])
        once = ~compared[right]
        np.add.at(counts, right[once], other_weights[left[once]])
        merge(parent, left + shift, right)
    every = nodes if own else np.concatenate([nodes, other_nodes])
    moved = parent != np.arange(len(parent))
    some = np.flatnonzero((counts > 0) | moved)
    others = pd.array(np.where(moved, every[parent], 0)[some], "Int64")
    others[~moved[some]] = pd.NA
    return pd.DataFrame({"node": every[some], "links": counts[some], "other": others})


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _beam_links(
    graph: hnsw.Graph, vectors: np.ndarray, queries: np.ndarray, todo: np.ndarray, cosine: float, width: int, own: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links that beams find, as queries and nodes, and the queries whose whole beam is linked."""
    left, right, full = [todo[:0]], [todo[:0]], [todo[:0]]
    for at in range(0, len(todo), hnsw.BATCH):
        some = todo[at : at + hnsw.BATCH]
        found, near = graph.search(queries[some].astype(np.float32), min(width, len(vectors)))
        linked = near >= cosine - 1e-4
        whole = linked.all(axis=1) & (width < len(vectors))
        full.append(some[whole])
        line, column = np.nonzero(linked & ~whole[:, None])
        asked, hit = some[line], found[line, column].astype(np.int64)
        exact = np.einsum("kd,kd->k", queries[asked], vectors[hit]) >= cosine
        exact &= ~((asked == hit) & own)
        left.append(asked[exact])
        right.append(hit[exact])
    return np.concatenate(left), np.concatenate(right), np.concatenate(full)


def _share_found(
    asked: np.ndarray, vectors: np.ndarray, queries: np.ndarray, numbers: np.ndarray, cosine: float, own: bool
) -> float:
    """The share of all links of the queries with these numbers that are among those found."""
    near = queries @ vectors.T >= cosine
    if own:
        near[np.arange(len(numbers)), numbers] = False
    there = int(near.sum())
    return int(np.isin(asked, numbers).sum()) / there if there else 1.0
