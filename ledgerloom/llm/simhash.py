"""SimHash near-duplicates: fingerprints, and BK-trees over shards of them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import FILE_ROWS, give_back, hold, kept
from ledgerloom.llm.components import components, merge

WORDS = 3
DISTANCE = 3
SEED = 42
# Nodes of one BK-tree, whose size no key can exceed: a larger shard becomes several trees.
TREE_NODES = 20_000
# Rows of trees and queries searched together, and pairs of a query and a node held at once.
FOREST_ROWS = 50_000
PAIRS = 4_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def text_fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits as a signed long; a bit is 1 if set in over half the shingles' hashes.

    A shingle is ``words`` lower-cased (A-Z) words joined by spaces; a text of fewer words is one
    shingle, one without words (null included) has the fingerprint zero.
    """
    parts = _WORD.findall((text or "").encode().translate(_LOWER))
    if not parts:
        return 0
    # Shingles are slices of the joined words.
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[s:e], SEED) for s, e in zip(starts.tolist(), ends[width - 1 :].tolist())),
        np.uint64,
        len(parts) - width + 1,
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """The fingerprint of a text column as a long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        hold("simhash", lambda: None)
        found = pd.Series([text_fingerprint(text, words) for text in texts], dtype="int64")
        give_back()
        return found

    return of(text)


def near_duplicates(
    documents: DataFrame,
    words: int = WORDS,
    distance: int = DISTANCE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (long) and ``component_id``.

    Fingerprints that differ in at most ``distance`` bits are linked; ``component_id`` is the
    smallest id reachable, null ids left out (null if a component has no other); ``root`` is one
    fingerprint of the component, the same for all its rows. Texts without words
    are linked like any other with the fingerprint zero. Rows that repeat an id are rows of their
    own. An empty table gives no rows; other columns are not looked at.
    """
    total = documents.count()
    prints = documents.select(F.col(id_column).alias("id"), fingerprint(F.col(text_column), words).alias("print"))
    rows = kept(prints.repartition(1 + total // FILE_ROWS))
    # Copies, however many, are one row from here on.
    classes = kept(rows.groupBy("print").agg(F.min("id").alias("first_id")), total)
    number = classes.count()
    roots = components(fingerprint_links(classes.select("print"), distance))
    rooted = kept(
        classes.join(roots, classes["print"] == roots["node"], "left").select(
            F.col("print").alias("own"), "first_id", F.coalesce("root", "print").alias("root")
        ),
        number,
    )
    smallest = kept(rooted.groupBy(F.col("root").alias("top")).agg(F.min("first_id").alias("component_id")), number)
    named = kept(rooted.join(smallest, rooted["root"] == smallest["top"]).select("own", "root", "component_id"), number)
    return rows.join(named, F.col("print") == F.col("own")).select(
        F.col("id").alias(id_column), F.col("print").alias("fingerprint"), "component_id", "root"
    )


def keep_one(documents: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The documents (``doc_id``, ``text``, others) that stay: one of each group of near-duplicates.

    The one with the smallest id stays; of rows that share it the one with the smallest fingerprint,
    and of those the one with the smallest text, then with the smallest hash of all its columns. A
    group without ids keeps its smallest fingerprint. All columns stay as they are, whatever their names.
    """
    stays = (
        near_duplicates(documents, words, distance)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("fingerprint").alias("stay_print"), F.min("doc_id").alias("stay_id"))
        .drop("root")
    )
    # A row travels as one column, so that its columns' names meet no others.
    packed = documents.select(F.struct("*").alias("row"), fingerprint(F.col("text"), words).alias("print"))
    order = F.struct("row.text", F.xxhash64("row"))
    rows = packed.groupBy(F.col("row.doc_id").alias("id"), "print").agg(F.min_by("row", order).alias("row"))
    same = (F.col("print") == F.col("stay_print")) & F.col("id").eqNullSafe(F.col("stay_id"))
    return rows.join(kept(stays), same, "left_semi").select("row.*")


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints (``print``) within ``distance`` bits.

    Cut into ``distance`` + 1 blocks of bits, two such fingerprints agree in a block at least, so a
    fingerprint has neighbours only in the trees of the shards (block, value) it is in itself: every
    shard is a BK-tree, and goes to the task its queries go to. A shard of more than TREE_NODES
    is several trees, each searched by the queries of the others as well. Rather than all pairs, a
    task returns links to the smallest member of what it has found connected.
    """
    blocks = distance + 1
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    shards = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned(F.shiftleft("print", 64 - cuts[i + 1]), 64 - cuts[i + 1] + cuts[i]).alias("value"),
        )
        for i in range(blocks)
    ]
    members = prints.select("print", F.inline(F.array(*shards)))
    large = (
        members.groupBy(F.col("block").alias("of_block"), F.col("value").alias("of_value"))
        .count()
        .filter(F.col("count") > TREE_NODES)
    )
    trees = F.coalesce(F.ceil(F.col("count") / TREE_NODES).cast("int"), F.lit(1))
    placed = members.join(
        large, (F.col("block") == F.col("of_block")) & (F.col("value") == F.col("of_value")), "left"
    ).select("print", "block", "value", F.pmod(F.xxhash64("print"), trees).cast("int").alias("own_tree"))
    # A fingerprint is a node of its own tree and a query to the trees before it.
    searched = placed.select(
        "print", "block", "value", "own_tree", F.explode(F.sequence(F.lit(0), "own_tree")).alias("tree")
    ).withColumn("is_query", F.col("tree") != F.col("own_tree"))
    dealt = (
        searched.drop("own_tree")
        .repartition("block", "value", "tree")
        .sortWithinPartitions("block", "value", "tree", "is_query", "print")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _search(batches, distance):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(search, "a long, b long").distinct()


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among the rows of a partition, a bounded number of rows at a time."""
    held: list[np.ndarray] = []

    def rows() -> int:
        return sum(len(part) for part in held)

    for batch in batches:
        shard = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3)], axis=1)
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        query = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
        # print, block, value, tree, is a query, may still be a query to others
        held.append(np.column_stack([prints, shard, query, np.ones_like(query)]))
        if rows() >= FOREST_ROWS:
            table = np.concatenate(held)
            last = np.flatnonzero((table[:, 1:4] == table[-1, 1:4]).all(axis=1))[0]
            if last:
                yield from _links(table[:last], radius)
                held = [table[last:]]
            else:
                # One tree with many queries: these are done, the tree waits for the next.
                yield from _links(table, radius)
                tree = table[table[:, 4] == 0]
                tree[:, 5] = 0
                held = [tree]
    if rows():
        yield from _links(np.concatenate(held), radius)


def _links(table: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    prints = table[:, 0].view(np.uint64)
    changes = np.flatnonzero(np.any(table[1:, 1:4] != table[:-1, 1:4], axis=1)) + 1
    first = np.concatenate(([0], changes))
    sizes = np.diff(np.concatenate((first, [len(table)])))
    nodes = np.flatnonzero(table[:, 4] == 0)
    forest = BkForest(prints, np.repeat(first, sizes), nodes)
    asking = np.flatnonzero((table[:, 5] == 1) & np.repeat(sizes > 1, sizes))
    weight = np.cumsum(np.repeat(sizes, sizes)[asking])
    parent = np.arange(len(table))
    start = 0
    while start < len(asking):
        before = weight[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(weight, before + PAIRS, side="right")))
        merge(parent, *forest.within(asking[start:stop], radius))
        start = stop
    moved = np.flatnonzero(parent != np.arange(len(table)))
    if len(moved):
        yield table[moved, 0], table[parent[moved], 0]


class BkForest:
    """BK-trees over rows of fingerprints: a child hangs below its parent at their bit distance.

    All trees are built and searched level by level together. ``root`` has for each row the first
    row of its shard, which is that tree's root; ``nodes`` are the rows that trees hold.
    """

    def __init__(self, prints: np.ndarray, root: np.ndarray, nodes: np.ndarray) -> None:
        self.prints = prints
        self.root = root
        self.child = np.full((len(prints), 65), -1, np.int32)
        rest = nodes[nodes != root[nodes]]
        at = root[rest]
        while len(rest):
            step = np.bitwise_count(prints[rest] ^ prints[at])
            slot = at * 65 + step
            taken, chosen = np.unique(slot, return_index=True)
            free = self.child.reshape(-1)[taken] < 0
            self.child.reshape(-1)[taken[free]] = rest[chosen[free]]
            below = self.child.reshape(-1)[slot]
            onward = below != rest
            rest, at = rest[onward], below[onward]

    def within(self, rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a row of ``rows`` and a node at most ``radius`` bits away, following only the
        edges whose distance differs from the row's own distance by ``radius`` or less."""
        found_rows, found_nodes = [], []
        asks, at = rows, self.root[rows]
        while len(asks):
            apart = np.bitwise_count(self.prints[asks] ^ self.prints[at]).astype(np.int64)
            near = (apart <= radius) & (asks != at)
            found_rows.append(asks[near])
            found_nodes.append(at[near])
            next_asks, next_at = [], []
            for edge in range(-radius, radius + 1):
                label = apart + edge
                fits = np.flatnonzero((label >= 0) & (label <= 64))
                below = self.child[at[fits], label[fits]]
                there = below >= 0
                next_asks.append(asks[fits[there]])
                next_at.append(below[there])
            asks, at = np.concatenate(next_asks), np.concatenate(next_at).astype(np.int64)
        return np.concatenate(found_rows), np.concatenate(found_nodes)
