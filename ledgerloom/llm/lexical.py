"""Ranked lexical search: the best documents per item, by a dual-tree search over both."""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.llm.common import file_system, in_slices, kept, new_folder
from ledgerloom.llm.words import cut, term_text

BEST = 10
# Bytes of text and documents of one tree; a longer text is a tree by itself.
SLICE = 4_000_000
TREE_DOCUMENTS = 4_096
# Items times terms of a block of items, which is searched for together.
CELLS = 4_000_000
# Documents of a leaf, and nodes below a node.
LEAF = 32
FAN = 8
# Sums below this are exact in doubles.
EXACT = 2**53
_NO_ID = 2**63 - 1


def search(
    documents: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Rows ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: each item's best documents.

    Terms are stretches of letters, digits and characters beyond ASCII, only A-Z lower-cased. N counts
    the documents with a term, L all their terms, n a document's terms, df the documents with a term
    and tf its occurrences in one. A term's weight w is floor(1000 ln((2N + 2) / (2df + 1))); a
    document's m is 10 + (90 n N) div L; its score sums w ((10^9 tf) div (1000 tf + 8m)) over the item's
    distinct terms. Only scores above 0 count; of equal scores the smaller id goes first, null ids last.

    Null and empty texts have no terms: such a document is found by no item, and such an item finds
    none. Rows that repeat are documents of their own; rows that share an item id are one item with
    all their terms. Texts are taken whole, a long one as a tree by itself. Empty tables give no rows;
    other columns are not looked at.

    A first pass counts terms; the items' weighted terms are written in the shared folder. In the second
    each task builds trees over its documents and searches them for one block of items after another.
    """
    spark = documents.sparkSession
    item_kind = items.schema[item_column].dataType.simpleString()
    wanted = kept(
        items.select(F.col(item_column).alias("item"), F.col(item_text_column).alias("text"))
        .mapInArrow(_item_terms, f"item {item_kind}, term string")
        .distinct()
    )
    counted = documents.select(F.col(text_column).alias("text")).mapInArrow(
        _counts, "term string, documents long, terms long"
    )
    # The row without a term has the totals; of the terms only those of items are exchanged.
    needed = wanted.select("term").distinct().unionByName(spark.range(1).select(F.lit(None).cast("string").alias("term")))
    needed = needed.withColumnRenamed("term", "of")
    found = kept(
        counted.join(needed, F.col("term").eqNullSafe(F.col("of")), "left_semi")
        .groupBy("term")
        .agg(F.sum("documents").alias("df"), F.sum("terms").alias("terms"))
    )
    totals = found.filter("term is null").first()
    n_documents, n_terms = (totals["df"], totals["terms"]) if totals else (0, 0)
    weight = F.floor(1000 * F.log((2.0 * n_documents + 2) / (2.0 * F.col("df") + 1)))
    weighted = (
        wanted.join(found.select("term", weight.alias("weight")).filter("weight > 0"), "term")
        .groupBy("item")
        .agg(F.sort_array(F.collect_list(F.struct("weight", "term")), asc=False).alias("terms"))
        # Items with the same heaviest term are neighbours in the tree.
        .select("item", F.col("terms.term").alias("terms"), F.col("terms.weight").alias("weights"))
    )
    folder = new_folder(spark, "search-items")
    heaviest = F.col("terms")[0]
    blocks = weighted.repartitionByRange(heaviest, "item").sortWithinPartitions(heaviest, "item")
    shape = f"items array<{item_kind}>, terms array<array<string>>, weights array<array<bigint>>"
    blocks.mapInArrow(_as_blocks(to_arrow_type(items.schema[item_column].dataType)), shape).write.parquet(folder)

    run = uuid.uuid4().hex
    kind = documents.schema[id_column].dataType.simpleString()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in in_slices(batch, 1, SLICE):
                for at in range(0, some.num_rows, TREE_DOCUMENTS):
                    part = some.slice(at, TREE_DOCUMENTS)
                    yield from _matches(part, folder, run, best, n_documents, n_terms)

    scored = documents.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text")).mapInArrow(
        match, f"item {item_kind}, doc {kind}, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select(F.col("item").alias(item_column), "rank", F.col("doc").alias(id_column), "score")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in in_slices(batch, 1, SLICE):
            terms, counts = cut(term_text(some.column(1)))
            item = some.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            spelt = pc.cast(terms.dictionary, pa.string()).take(terms.indices)
            yield pa.RecordBatch.from_arrays([item, spelt], names=["item", "term"])


def _term_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms; text, term and occurrences of each pair of them; and how many terms a text has."""
    terms, counts = cut(term_text(texts))
    many = max(1, len(terms.dictionary))
    pairs = np.repeat(np.arange(len(counts)), counts) * many + terms.indices.to_numpy()
    found, often = np.unique(pairs, return_counts=True)
    return terms.dictionary, found // many, found % many, often, counts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["term", "documents", "terms"]
    for batch in batches:
        for some in in_slices(batch, 0, SLICE):
            terms, _, term, often, counts = _term_counts(some.column(0))
            within = np.bincount(term, minlength=len(terms))
            total = np.bincount(term, often, minlength=len(terms)).astype(np.int64)
            spelt = pc.cast(terms, pa.string())
            yield pa.RecordBatch.from_arrays([spelt, pa.array(within), pa.array(total)], names=names)
            totals = [[None], [int((counts > 0).sum())], [int(counts.sum())]]
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(totals, kinds)], names=names)


class Block:
    """Items searched for together: their weights, and the hierarchy of largest weights over them."""

    def __init__(self, items: pa.Array, terms: list[list[str]], weights: list[list[int]]) -> None:
        self.items = items
        flat = pa.array([term for some in terms for term in some], pa.large_string()).dictionary_encode()
        self.terms = flat.dictionary
        values = np.array([weight for some in weights for weight in some], np.int64)
        # A score is below the sum of weights times 10^6, the most a term counts.
        kind = np.float64 if max(map(sum, weights)) * 10**6 < EXACT else np.int64
        self.weights = np.zeros((len(terms), len(self.terms)), kind)
        self.weights[np.repeat(np.arange(len(terms)), list(map(len, terms))), flat.indices.to_numpy()] = values
        self.levels = levels(self.weights)


def levels(rows: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of nodes, level by level, from ``rows`` up to a single node."""
    found = [rows]
    while len(found[-1]) > 1:
        found.append(np.maximum.reduceat(found[-1], np.arange(0, len(found[-1]), FAN), axis=0))
    return found


def _as_blocks(item_kind: pa.DataType):
    """Rows of items, as Spark sorted them, to rows of blocks, each of about CELLS weights at most."""
    texts, numbers = pa.list_(pa.list_(pa.string())), pa.list_(pa.list_(pa.int64()))
    schema = pa.schema([("items", pa.list_(item_kind)), ("terms", texts), ("weights", numbers)])

    def whole(rows: list[dict]) -> pa.RecordBatch:
        columns = [[[row[name] for row in rows]] for name in ("item", "terms", "weights")]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, schema.types)], schema=schema)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        wide = 0
        for batch in batches:
            for row in batch.to_pylist():
                more = len(row["terms"])
                if held and (len(held) + 1) * (wide + more) > CELLS:
                    yield whole(held)
                    held, wide = [], 0
                held.append(row)
                wide += more
        if held:
            yield whole(held)

    return of


# Blocks a worker keeps from one tree to the next; others are read again.
_BLOCKS: dict[tuple[str, int], Block] = {}
_MOST_BLOCKS = 2


@lru_cache(maxsize=1)
def _files(folder: str) -> list[str]:
    system, path = file_system(folder)
    return sorted(ds.dataset(path, filesystem=system, format="parquet").files)


def _blocks(folder: str) -> Iterator[tuple[tuple[str, int], Block]]:
    """The blocks of items in a folder, one after another."""
    system = file_system(folder)[0]
    for file in _files(folder):
        rows = ds.dataset(file, filesystem=system, format="parquet").to_batches(batch_size=1)
        for number, row in enumerate(row for row in rows if row.num_rows):
            key = (file, number)
            if key not in _BLOCKS:
                if len(_BLOCKS) >= _MOST_BLOCKS:
                    _BLOCKS.clear()
                _BLOCKS[key] = Block(row.column(0).flatten(), row.column(1)[0].as_py(), row.column(2)[0].as_py())
            yield key, _BLOCKS[key]


class Found:
    """The best documents met so far for the items of a block, each document once.

    They are kept by the worker as long as it searches for the same items. What k documents of the
    table reach is reached by an item's kth best, so whatever stays below it is of no interest, in
    whichever task, and also if a task runs twice.
    """

    def __init__(self, items: int, best: int) -> None:
        self.best = best
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(items)]
        self.weakest = np.zeros(items, np.int64)
        self.weakest_id = np.full(items, _NO_ID)

    def add(self, item: int, score: int, doc: int) -> None:
        heap = self.heaps[item]
        if doc == _NO_ID:
            return
        for i, (other, negative) in enumerate(heap):
            if -negative == doc:
                if other >= score:
                    return
                heap[i] = (score, negative)
                heapq.heapify(heap)
                break
        else:
            (heapq.heappush if len(heap) < self.best else heapq.heappushpop)(heap, (score, -doc))
        if len(heap) == self.best:
            self.weakest[item], self.weakest_id[item] = heap[0][0], -heap[0][1]

    def may_enter(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray) -> np.ndarray:
        weakest = self.weakest[items]
        return (scores > weakest) | ((scores == weakest) & (scores > 0) & (docs <= self.weakest_id[items]))


_KNOWN: dict[str, dict[tuple[str, int], Found]] = {}


def _matches(
    rows: pa.RecordBatch, folder: str, run: str, best: int, n_documents: int, n_terms: int
) -> Iterator[pa.RecordBatch]:
    terms, doc, term, often, counts = _term_counts(rows.column(1))
    if not len(doc):
        return
    ids = pc.fill_null(pc.cast(rows.column(0), pa.int64()), _NO_ID).to_numpy(zero_copy_only=False)
    m = np.array([10 + 90 * n * n_documents // n_terms for n in counts.tolist()], np.int64)
    impact = 10**9 * often // (1000 * often + 8 * m[doc])
    if run not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[run] = {}
    for key, block in _blocks(folder):
        known = _KNOWN[run].setdefault(key, Found(len(block.items), best))
        column = pc.fill_null(pc.index_in(terms, value_set=block.terms), -1).to_numpy(zero_copy_only=False)[term]
        there = column >= 0
        score, item, at = dual_search(block, doc[there], column[there], impact[there], ids, known)
        stays = known.may_enter(item, score, ids[at])
        if stays.any():
            yield pa.RecordBatch.from_arrays(
                [block.items.take(pa.array(item[stays])), rows.column(0).take(pa.array(at[stays])), pa.array(score[stays])],
                names=["item", "doc", "score"],
            )


def dual_search(
    block: Block, doc: np.ndarray, column: np.ndarray, impact: np.ndarray, ids: np.ndarray, known: Found
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, item and document of what may be among the best.

    ``doc``, ``column`` (a term of the block) and ``impact`` (what it counts there, before the weight)
    say what documents hold, by document. Documents with the same weightiest term are neighbours in the
    tree, whose nodes hold the largest impact of each term. A pair of nodes is bounded by the sum over
    terms of largest weight times largest impact; if that is below what the weakest of the node's
    items already has, no pair of an item and a document below can matter. Leaves come in the order of
    their bounds, so that items soon have good documents.
    """
    empty = (np.empty(0, np.int64),) * 3
    if not len(doc):
        return empty
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    heavy = block.levels[-1][0, column] * impact
    top = np.maximum.reduceat(heavy, first)
    is_top = heavy == np.repeat(top, np.diff(np.append(first, len(doc))))
    weightiest = np.full(len(first), -1)
    group = np.cumsum(np.concatenate(([False], doc[1:] != doc[:-1])))
    weightiest[group[is_top]] = column[is_top]
    order = np.lexsort((-top, weightiest))
    place = np.empty(len(first), np.int64)
    place[order] = np.arange(len(first))
    leaf = place[group] // LEAF
    largest = np.zeros((int(leaf.max()) + 1, len(block.terms)), block.weights.dtype)
    np.maximum.at(largest, (leaf, column), impact)
    docs = levels(largest)

    bounds = _descend(block.levels, docs, known.weakest)
    by_leaf = np.argsort(leaf, kind="stable")
    ends = np.searchsorted(leaf[by_leaf], np.arange(len(largest) + 1))
    original = doc[first]
    scores, items, found = [], [], []
    for node in np.argsort(-bounds.max(axis=0)).tolist():
        asking = np.flatnonzero(bounds[:, node] >= np.maximum(known.weakest, 1))
        if not len(asking):
            continue
        mine = by_leaf[ends[node] : ends[node + 1]]
        used, narrow = np.unique(column[mine], return_inverse=True)
        held = np.zeros((min(LEAF, len(first) - node * LEAF), len(used)), block.weights.dtype)
        held[place[group[mine]] - node * LEAF, narrow] = impact[mine]
        reached = (block.weights[np.ix_(asking, used)] @ held.T).astype(np.int64)
        at = original[order[node * LEAF : node * LEAF + len(held)]]
        rows, columns = np.nonzero(reached >= np.maximum(known.weakest[asking], 1)[:, None])
        item, document, score = asking[rows], at[columns], reached[rows, columns]
        # The best first, so that most others are left out at once.
        enters = np.flatnonzero(known.may_enter(item, score, ids[document]))
        for i in enters[np.argsort(-score[enters], kind="stable")].tolist():
            one = slice(i, i + 1)
            if known.may_enter(item[one], score[one], ids[document[one]])[0]:
                scores.append(int(score[i]))
                items.append(int(item[i]))
                found.append(int(document[i]))
                known.add(items[-1], scores[-1], int(ids[found[-1]]))
    return tuple(np.array(values, np.int64) for values in (scores, items, found)) if scores else empty


def _descend(items: list[np.ndarray], docs: list[np.ndarray], weakest: np.ndarray) -> np.ndarray:
    """Bounds of all pairs of an item and a leaf, -1 where a pair of nodes above them was pruned."""
    needed = [np.maximum(weakest, 1)]
    for _ in items[1:]:
        needed.append(np.minimum.reduceat(needed[-1], np.arange(0, len(needed[-1]), FAN)))
    depth = max(len(items), len(docs))
    alive = np.ones((1, 1), bool)
    bounds = None
    for level in range(depth - 1, -1, -1):
        i, d = min(level, len(items) - 1), min(level, len(docs) - 1)
        # Children of the pairs that are left; a tree that is not as deep waits at its root.
        if i < len(items) - 1:
            alive = np.repeat(alive, FAN, axis=0)[: len(items[i])]
        if d < len(docs) - 1:
            alive = np.repeat(alive, FAN, axis=1)[:, : len(docs[d])]
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        bounds = np.full((len(items[i]), len(docs[d])), -1, items[i].dtype)
        bounds[np.ix_(rows, columns)] = items[i][rows] @ docs[d][columns].T
        alive = alive & (bounds >= needed[i][:, None])
        bounds[~alive] = -1
    return bounds
