"""Exact top-k search by inner product: a Voronoi join of queries and rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import kept

NEAREST = 5
# Rows taken as pivots, the most there are.
PIVOTS = 16
# Rows of data, and queries, that are moved and multiplied together.
BLOCK_ROWS = 2_048
BLOCK_QUERIES = 512


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    usable = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


@dataclass(frozen=True)
class Group:
    """Queries of one Voronoi cell: no query is farther from the centre than the radius."""

    number: int
    centre: np.ndarray
    radius: float
    queries: int


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, pivots: int = PIVOTS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` rows with the largest integer
    inner product with each query, ties to the smaller id; all rows if there are fewer.

    ``vectors`` has ``vec_id`` and ``vector`` (array of long); ``is_query`` is a condition on its
    columns. Candidates are the rows of the same length whose id is not the query's. Rows with a null
    id or vector take no part; a row that occurs several times counts as often, also as a query.
    An empty table gives no rows, and other columns are not looked at.

    A query within ``radius`` of its pivot scores a row d at least <pivot, d> - radius |d| and at
    most <pivot, d> + radius |d|. So the k-th largest lower bound over all rows, combined from the
    largest of each task, is a score all queries of the cell reach, and only rows whose upper bound
    reaches it go to that cell. All pivots, radii and bounds together are a few numbers per cell.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    queries = rows.filter(is_query).select("vec_id", "vector")
    rows = rows.select("vec_id", "vector")
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(pivots).collect()
    centres: dict[int, np.ndarray] = {}
    for size in {len(row["vector"]) for row in chosen}:
        same = [row["vector"] for row in chosen if len(row["vector"]) == size]
        centres[size] = np.unique(np.array(same, np.float64).reshape(len(same), size), axis=0)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cell of each query, as its length and pivot in one number, and the distance."""
        for batch in batches:
            for size, at, matrix in _by_size(batch.column(1)):
                cell, far = _nearest_pivot(matrix, centres.get(size))
                ids = batch.column(0).take(pa.array(at))
                vector = batch.column(1).take(pa.array(at))
                numbers = pa.array(size * (pivots + 1) + cell)
                yield pa.RecordBatch.from_arrays([ids, vector, numbers, pa.array(far)], ["vec_id", "vector", "cell", "far"])

    # A number for each query row, which may repeat another's id.
    placed = kept(
        queries.mapInArrow(cells, "vec_id long, vector array<long>, cell long, far double").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    groups = []
    for row in placed.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():
        size, cell = divmod(row["cell"], pivots + 1)
        centre = centres[size][cell - 1] if cell else np.zeros(size)
        groups.append(Group(row["cell"], centre, row["far"] * (1 + 1e-9) + 1e-6, row["n"]))
    bounds = _lower_bounds(rows, groups, pivots, k)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(_needed(batches, groups, pivots, bounds), "cell", "rows")

    data = rows.mapInArrow(replicate, "cell long, rows binary")
    shares = F.create_map(*[F.lit(x) for g in groups for x in (g.number, -(-g.queries // BLOCK_QUERIES))]) if groups else None
    if shares is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    share = F.pmod(F.xxhash64("row"), F.element_at(shares, F.col("cell"))).cast("int")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((c, i, v) for batch in batches for c, i, v in _by_cell(batch))
        yield from _blocks(parts, "of_cell", "asked", BLOCK_QUERIES)

    asked = (
        placed.withColumn("share", share)
        .repartition("cell", "share")
        .sortWithinPartitions("cell")
        .select("cell", "vec_id", "vector", "row")
        .mapInArrow(gather, "of_cell long, asked binary")
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, against in zip(batch.column(0), batch.column(1)):
                yield _best(some.as_buffer(), against.as_buffer(), k)

    found = (
        data.join(asked, F.col("cell") == F.col("of_cell"))
        .select("asked", "rows")
        .mapInArrow(solve, "query_row long, query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _by_size(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vector, the rows that have it and their components."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        same = column if len(at) == len(sizes) else column.take(pa.array(at))
        yield size, at, same.flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)


def _by_cell(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    cells = batch.column(0).to_numpy()
    for cell in np.unique(cells).tolist():
        mine = pa.array(np.flatnonzero(cells == cell))
        for _, at, matrix in _by_size(batch.column(2).take(mine)):
            ids = np.column_stack([batch.column(i).take(mine).to_numpy()[at] for i in (1, 3)])
            yield cell, ids, matrix


def _nearest_pivot(matrix: np.ndarray, centres: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot, counted from 1, and the distance; without pivots 0 and the length."""
    vectors = matrix.astype(np.float64)
    if centres is None:
        return np.zeros(len(matrix), np.int64), np.sqrt((vectors**2).sum(axis=1))
    cell = np.argmin((centres**2).sum(axis=1) - 2 * (vectors @ centres.T), axis=1)
    return cell + 1, np.sqrt(((vectors - centres[cell]) ** 2).sum(axis=1))


def _scores(
    matrix: np.ndarray, groups: list[Group], size: int, pivots: int
) -> Iterator[tuple[Group, np.ndarray, np.ndarray]]:
    """For each group of queries of this length, the least and the largest score of each row.

    Both are widened by more than rounding can amount to.
    """
    vectors = matrix.astype(np.float64)
    length = np.sqrt((vectors**2).sum(axis=1))
    for group in groups:
        if group.number // (pivots + 1) == size:
            middle = vectors @ group.centre
            reach = group.radius * length
            slack = 1e-9 * (length * (np.sqrt((group.centre**2).sum()) + group.radius)) + 1e-6
            yield group, middle - reach - slack, middle + reach + slack


def _lower_bounds(rows: DataFrame, groups: list[Group], pivots: int, k: int) -> dict[int, float]:
    """A score that k rows other than the query itself reach, for each group that has so many."""

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict[int, float]] = {group.number: {} for group in groups}
        for batch in batches:
            for size, at, matrix in _by_size(batch.column(1)):
                ids = batch.column(0).to_numpy()[at]
                for group, low, _ in _scores(matrix, groups, size, pivots):
                    mine = best[group.number]
                    for i in np.argsort(-low, kind="stable").tolist():
                        # A query's own id may be among them, so one more than k ids.
                        if len(mine) > k and low[i] <= min(mine.values()):
                            break
                        mine[int(ids[i])] = max(float(low[i]), mine.get(int(ids[i]), -np.inf))
                        if len(mine) > k + 1:
                            del mine[min(mine, key=mine.get)]
        found = [(cell, i, low) for cell, mine in best.items() for i, low in mine.items()]
        columns = zip(*found) if found else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["cell", "vec_id", "low"])

    if not groups:
        return {}
    found = rows.mapInArrow(largest, "cell long, vec_id long, low double").groupBy("cell", "vec_id").agg(F.max("low").alias("low"))
    order = Window.partitionBy("cell").orderBy(F.desc("low"))
    kth = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") == k + 1)
    return {row["cell"]: row["low"] for row in kth.collect()}


def _needed(
    batches: Iterator[pa.RecordBatch], groups: list[Group], pivots: int, bounds: dict[int, float]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for size, at, matrix in _by_size(batch.column(1)):
            ids = batch.column(0).to_numpy()[at]
            for group, _, high in _scores(matrix, groups, size, pivots):
                near = high >= bounds.get(group.number, -np.inf)
                if near.any():
                    yield group.number, ids[near].reshape(-1, 1), matrix[near]


def _blocks(
    parts: Iterator[tuple[int, np.ndarray, np.ndarray]], cell: str, rows: str, most: int = BLOCK_ROWS
) -> Iterator[pa.RecordBatch]:
    """Rows of a cell in blocks: the ids, then the components in as few bytes as they need."""
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def block(number: int) -> pa.RecordBatch:
        ids, vectors = (np.concatenate(part) for part in zip(*waiting.pop(number)))
        small = vectors.size == 0 or (vectors.min() >= -(2**15) and vectors.max() < 2**15)
        head = np.array([*ids.shape, vectors.shape[1], small], "<i8").tobytes()
        packed = head + ids.astype("<i8").tobytes() + vectors.astype("<i2" if small else "<i8").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed], pa.binary())], [cell, rows])

    for number, ids, vectors in parts:
        for at in range(0, len(ids), most):
            waiting.setdefault(number, []).append((ids[at : at + most], vectors[at : at + most]))
            if sum(len(part[0]) for part in waiting[number]) >= most:
                yield block(number)
    for number in list(waiting):
        yield block(number)


def _unpacked(block: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    n, width, size, small = np.frombuffer(block, "<i8", 4).tolist()
    ids = np.frombuffer(block, "<i8", n * width, 32)
    vectors = np.frombuffer(block, "<i2" if small else "<i8", n * size, 32 + 8 * n * width)
    return ids.reshape(n, width), vectors.reshape(n, size)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond a long they are the nearest long."""
    largest = [max((abs(int(x)) for x in (m.min(), m.max())), default=0) if m.size else 0 for m in (left, right)]
    most = largest[0] * largest[1] * left.shape[1]
    if most < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return left.astype(np.int64) @ right.astype(np.int64).T
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(asked: pa.Buffer, rows: pa.Buffer, k: int) -> pa.RecordBatch:
    """The k best rows of a block for each query of a block."""
    query_ids, queries = _unpacked(asked)
    ids, vectors = _unpacked(rows)
    if queries.shape[1] != vectors.shape[1]:
        query_ids = query_ids[:0]
    else:
        scores = _products(queries, vectors)
    # In the order of ids, of which a stable sort leaves the smallest first.
    order = np.argsort(ids[:, 0], kind="stable")
    ids = ids[order, 0]
    out: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 4]
    for i, (query, row) in enumerate(query_ids.tolist()):
        others = np.flatnonzero(ids != query)
        mine = scores[i, order[others]]
        if len(mine) > k:
            # All that tie with the k-th largest stay in until the ids decide.
            good = mine >= np.partition(mine, len(mine) - k)[len(mine) - k]
            others, mine = others[good], mine[good]
        # The complement turns the order around without leaving a long.
        top = np.argsort(~mine, kind="stable")[:k]
        out.append((np.full(len(top), row), np.full(len(top), query), ids[others[top]], mine[top]))
    columns = [np.concatenate(part).astype(np.int64) for part in zip(*out)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_row", "query_id", "vec_id", "score"])
