"""Hierarchical navigable small-world graphs over unit vectors, built and searched in batches."""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

# Links of a node on a layer (twice as many on the lowest), and the beam while building.
LINKS = 12
BUILD_BEAM = 48
# Nodes that enter, or queries that are answered, together; and beam entries expanded at once.
BATCH = 256
EXPANDED = 4


@dataclass
class Graph:
    """Vectors and, per layer from the lowest, its nodes and their neighbours (-1: none)."""

    vectors: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]
    entry: int

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        parts = {"vectors": self.vectors, "entry": np.array(self.entry)}
        for i, (nodes, links) in enumerate(self.layers):
            parts |= {f"nodes{i}": nodes, f"links{i}": links}
        np.savez(out, **parts)
        return out.getvalue()

    @staticmethod
    def from_bytes(content: bytes) -> Graph:
        with np.load(io.BytesIO(content), allow_pickle=False) as parts:
            number = sum(name.startswith("nodes") for name in parts.files)
            layers = [(parts[f"nodes{i}"], parts[f"links{i}"]) for i in range(number)]
            return Graph(parts["vectors"], layers, int(parts["entry"]))

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the ``beam`` nearest nodes found (-1: none) and their cosines, in no order."""
        start = np.full((len(queries), 1), self.entry)
        near = np.einsum("qd,qkd->qk", queries, self.vectors[start])
        for layer in range(len(self.layers) - 1, -1, -1):
            width = beam if layer == 0 else 1
            start, near = _beam(self.vectors, _rows(self, layer), self.layers[layer][1], queries, start, near, width)
        return start, near


def _rows(graph: Graph, layer: int) -> np.ndarray:
    """The row of each node in the layer's table of links."""
    nodes = graph.layers[layer][0]
    rows = np.full(len(graph.vectors), -1, np.int32)
    rows[nodes] = np.arange(len(nodes))
    return rows


def _beam(
    vectors: np.ndarray,
    rows: np.ndarray,
    links: np.ndarray,
    queries: np.ndarray,
    found: np.ndarray,
    near: np.ndarray,
    width: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search on one layer from the nodes ``found``, for all queries step by step."""
    n = len(queries)
    visited = np.zeros((n, len(vectors)), bool)
    lines = np.arange(n)[:, None]
    visited[lines, found] = True
    open_ = np.ones_like(found, bool)
    active = np.arange(n)
    out_found, out_near = np.full((n, width), -1), np.full((n, width), -np.inf, np.float32)
    while len(active):
        # The best entries not yet expanded.
        rank = np.where(open_, near, -np.inf)
        take = min(EXPANDED, rank.shape[1])
        best = np.argpartition(-rank, take - 1, axis=1)[:, :take] if rank.shape[1] > take else np.tile(np.arange(take), (len(active), 1))
        own = np.arange(len(active))[:, None]
        expand = np.where(rank[own, best] > -np.inf, found[own, best], -1)
        open_[own, best] = False
        done = (expand < 0).all(axis=1)
        if done.any():
            out_found[active[done], : found.shape[1]] = found[done]
            out_near[active[done], : near.shape[1]] = near[done]
            stays = ~done
            active, found, near, open_, expand = active[stays], found[stays], near[stays], open_[stays], expand[stays]
            if not len(active):
                break
        new = np.where(expand[:, :, None] >= 0, links[rows[expand]], -1).reshape(len(active), -1)
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[visited[active[:, None], new] & (new >= 0)] = -1
        some = new >= 0
        line, column = np.nonzero(some)
        nodes = new[line, column]
        visited[active[line], nodes] = True
        cosine = np.full(new.shape, -np.inf, np.float32)
        cosine[line, column] = np.einsum("kd,kd->k", vectors[nodes], queries[active[line]])
        found, near, open_ = (np.concatenate(both, axis=1) for both in ((found, new), (near, cosine), (open_, some)))
        if found.shape[1] > width:
            top = np.argpartition(-near, width - 1, axis=1)[:, :width]
            own = np.arange(len(active))[:, None]
            found, near, open_ = found[own, top], near[own, top], open_[own, top]
    return out_found, out_near


def build(vectors: np.ndarray, seed: int = 7) -> Graph:
    """A graph of unit vectors (float32), entered in batches that grow with the graph.

    A node is on layer l with probability LINKS ** -l. A batch searches the graph so far, and itself,
    for candidates, and keeps for each node those that are nearer to it than to another one kept,
    so that links lead in all directions out of a dense group. The same holds for the neighbours'
    lists, which the new links may overflow.
    """
    n = len(vectors)
    levels = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(np.int64)
    if not n:
        return Graph(vectors, [], 0)
    # High nodes first, so that the upper layers are there when the others enter.
    order = np.argsort(-levels, kind="stable")
    top = int(levels.max())
    layers = []
    for layer in range(top + 1):
        nodes = order[levels[order] >= layer]
        layers.append((nodes.astype(np.int32), np.full((len(nodes), LINKS * (2 if layer == 0 else 1)), -1, np.int32)))
    graph = Graph(vectors, layers, int(order[0]))
    rows = [_rows(graph, layer) for layer in range(top + 1)]
    entered = 1
    while entered < n:
        batch = order[entered : entered + min(BATCH, entered)]
        entered += len(batch)
        _enter(graph, rows, levels, batch)
    return graph


def _enter(graph: Graph, rows: list[np.ndarray], levels: np.ndarray, batch: np.ndarray) -> None:
    vectors = graph.vectors
    queries = vectors[batch]
    found = np.full((len(batch), 1), graph.entry)
    near = np.einsum("qd,qkd->qk", queries, vectors[found])
    within = queries @ queries.T
    np.fill_diagonal(within, -np.inf)
    for layer in range(len(graph.layers) - 1, -1, -1):
        links = graph.layers[layer][1]
        mine = levels[batch] >= layer
        width = BUILD_BEAM if mine.any() else 1
        found, near = _beam(vectors, rows[layer], links, queries, found, near, width)
        if not mine.any():
            continue
        # Nodes of the same batch do not find each other in the graph.
        others = np.where(mine[None, :], within, -np.inf)[mine]
        take = min(2 * LINKS, len(batch))
        beside = np.argpartition(-others, take - 1, axis=1)[:, :take]
        beside_near = np.take_along_axis(others, beside, axis=1)
        candidates = np.concatenate([found[mine], np.where(beside_near > -np.inf, batch[beside], -1)], axis=1)
        nearness = np.concatenate([near[mine], beside_near], axis=1).astype(np.float32)
        nearness[candidates < 0] = -np.inf
        kept = _spread(vectors, candidates, nearness, LINKS)
        nodes = batch[mine]
        links[rows[layer][nodes], : kept.shape[1]] = kept
        line, column = np.nonzero(kept >= 0)
        _link_back(vectors, rows[layer], links, kept[line, column], nodes[line])


def _link_back(vectors: np.ndarray, rows: np.ndarray, links: np.ndarray, to: np.ndarray, new: np.ndarray) -> None:
    """Add each node of ``new`` to the links of the node of ``to`` beside it."""
    order = np.argsort(to, kind="stable")
    to, new = to[order], new[order]
    targets, first, counts = np.unique(to, return_index=True, return_counts=True)
    width = links.shape[1]
    for at in range(0, len(targets), 512):
        some = slice(at, at + 512)
        most = int(counts[some].max())
        column = np.arange(most)[None, :]
        there = column < counts[some][:, None]
        added = np.where(there, new[np.minimum(first[some][:, None] + column, len(new) - 1)], -1)
        lists = np.concatenate([links[rows[targets[some]]], added], axis=1)
        # A node that both sides chose is there already.
        lists.sort(axis=1)
        lists[:, 1:][lists[:, 1:] == lists[:, :-1]] = -1
        full = (lists >= 0).sum(axis=1) > width
        fits = ~full
        if fits.any():
            links[rows[targets[some][fits]]] = -np.sort(-lists[fits], axis=1)[:, :width]
        if full.any():
            # Of very many new links the nearest are looked at, four times what there is room for.
            nodes = targets[some][full]
            wide = lists[full]
            nearness = np.einsum("nd,nkd->nk", vectors[nodes], vectors[wide])
            nearness[wide < 0] = -np.inf
            if wide.shape[1] > 4 * width:
                top = np.argpartition(-nearness, 4 * width - 1, axis=1)[:, : 4 * width]
                wide, nearness = np.take_along_axis(wide, top, axis=1), np.take_along_axis(nearness, top, axis=1)
            chosen = _spread(vectors, wide, nearness, width)
            links[rows[nodes]] = -1
            links[rows[nodes], : chosen.shape[1]] = chosen


def _spread(vectors: np.ndarray, candidates: np.ndarray, nearness: np.ndarray, most: int) -> np.ndarray:
    """For each line up to ``most`` candidates, none nearer to one chosen before than to the node;
    room that is left goes to the nearest of the others."""
    order = np.argsort(-nearness, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    nearness = np.take_along_axis(nearness, order, axis=1)
    points = vectors[candidates]
    between = np.einsum("nkd,njd->nkj", points, points)
    valid = nearness > -np.inf
    chosen = np.zeros(candidates.shape, bool)
    number = np.zeros(len(candidates), np.int64)
    for k in range(candidates.shape[1]):
        blocked = np.where(chosen, between[:, k], -np.inf).max(axis=1) > nearness[:, k]
        take = valid[:, k] & ~blocked & (number < most)
        chosen[:, k] = take
        number += take
    # First those chosen, then the rest by nearness.
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * candidates.shape[1] + np.arange(candidates.shape[1])
    best = np.argsort(rank, axis=1, kind="stable")[:, :most]
    return np.where(np.take_along_axis(valid, best, axis=1), np.take_along_axis(candidates, best, axis=1), -1)
