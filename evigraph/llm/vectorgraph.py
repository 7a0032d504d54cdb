"""A robust-pruned directed graph over the vectors of one shard, and beam search in it.

All functions work on many vectors at once: rows of unit length, cosine as similarity.
"""

from __future__ import annotations

import numpy as np

#: Trees and rows of a leaf that give searches their first candidates; edges of a node;
#: relaxation of the pruning; list length of a search and nodes that it expands at a time.
TREES, LEAF, EDGES, ALPHA, BEAM, WIDTH = 6, 192, 20, 1.2, 20, 4
_BATCH = 1024


class Trees:
    """Random-projection trees with leaves of at most LEAF rows: where searches enter the graph."""

    def __init__(self, x: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> None:
        self.x, self.leaf, rng = x, leaf, np.random.default_rng(seed)
        self.trees = [self._grow(rng) for _ in range(trees)]

    def _grow(self, rng):
        nodes: list = []  # (direction, cut, left, right) or an array of rows

        def grow(rows: np.ndarray) -> int:
            at = len(nodes)
            nodes.append(None)
            if len(rows) <= self.leaf:
                nodes[at] = rows
                return at
            a, b = self.x[rows[rng.integers(len(rows))]], self.x[rows[rng.integers(len(rows))]]
            d = a - b if not np.array_equal(a, b) else rng.standard_normal(self.x.shape[1]).astype(np.float32)
            p = self.x[rows] @ d
            half = len(rows) // 2
            order = np.argpartition(p, half)
            nodes[at] = (d, float(p[order[half]]), grow(rows[order[:half]]), grow(rows[order[half:]]))
            return at

        grow(np.arange(len(self.x)))
        return nodes

    def leaves(self, q: np.ndarray):
        """For each tree and leaf reached: (numbers of the queries, rows of the leaf)."""
        for nodes in self.trees:
            todo = [(0, np.arange(len(q)))]
            while todo:
                at, who = todo.pop()
                if not len(who):
                    continue
                if isinstance(nodes[at], np.ndarray):
                    yield who, nodes[at]
                    continue
                d, cut, left, right = nodes[at]
                go = q[who] @ d >= cut
                todo += [(left, who[~go]), (right, who[go])]

    def own_leaves(self):
        for nodes in self.trees:
            for n in nodes:
                if isinstance(n, np.ndarray):
                    yield n, n


def _best(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, best first, an id once; missing ones are -1 with similarity -2."""
    order = np.argsort(ids, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    sims = np.where(again | (ids < 0), np.float32(-2), sims)
    if ids.shape[1] > k:
        part = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        ids, sims = np.take_along_axis(ids, part, 1), np.take_along_axis(sims, part, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    return np.where(sims <= -2, -1, ids), sims


def entries(x: np.ndarray, groups, q: np.ndarray, k: int, trees: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of the leaves that each query falls into; same: queries are the rows themselves."""
    n = len(q)
    ids = np.full((n, trees * k), -1, np.int32)
    sims = np.full((n, trees * k), -2, np.float32)
    used = np.zeros(n, np.int64)
    for who, rows in groups:
        for i in range(0, len(who), 4096):
            w = who[i : i + 4096]
            s = q[w] @ x[rows].T
            if same:
                s[np.arange(len(w)), np.arange(i, i + len(w))] = -2
            m = min(k, len(rows))
            top = np.argpartition(-s, m - 1, axis=1)[:, :m] if len(rows) > m else np.tile(np.arange(m), (len(w), 1))
            at = used[w][:, None] + np.arange(m)
            ids[w[:, None], at] = rows[top]
            sims[w[:, None], at] = np.take_along_axis(s, top, 1)
            used[w] += m
    ids[sims <= -2] = -1
    return _best(ids, sims, k)


def robust_prune(x: np.ndarray, of: np.ndarray, ids: np.ndarray, sims: np.ndarray, edges: int = EDGES, alpha: float = ALPHA) -> np.ndarray:
    """Diverse edges of rows `of`: of the candidates, nearest first, one is kept and those drop out
    that lie nearer to it, by the factor alpha, than to the row."""
    out = np.full((len(of), edges), -1, np.int32)
    width = ids.shape[1]
    for i in range(0, len(of), 2048):
        c, s = ids[i : i + 2048], sims[i : i + 2048]
        v = x[np.maximum(c, 0)]
        to_row = np.sqrt(np.maximum(2 - 2 * s, 0))
        between = np.sqrt(np.maximum(2 - 2 * np.matmul(v, v.transpose(0, 2, 1)), 0)) * np.float32(alpha)
        alive, kept = c >= 0, np.zeros(len(c), np.int64)
        rows = np.arange(len(c))
        for j in range(width):
            take = alive[:, j] & (kept < edges)
            r = rows[take]
            out[i + r, kept[r]] = c[r, j]
            kept[r] += 1
            alive[take] &= between[take, j] > to_row[take]
    return out


def with_reverse(x: np.ndarray, graph: np.ndarray, edges: int = EDGES) -> np.ndarray:
    """The graph with its edges in both directions, pruned again where a node has too many."""
    n = len(graph)
    src = np.repeat(np.arange(n, dtype=np.int64), graph.shape[1])
    dst = graph.ravel().astype(np.int64)
    src, dst = src[dst >= 0], dst[dst >= 0]
    key = np.unique(np.concatenate((src * n + dst, dst * n + src)))
    src, dst = key // n, key % n
    sims = np.concatenate([np.einsum("ij,ij->i", x[src[i : i + 65536]], x[dst[i : i + 65536]]) for i in range(0, len(src), 65536)]) if len(src) else np.zeros(0, np.float32)
    order = np.lexsort((-sims, src))
    src, dst, sims = src[order], dst[order], sims[order]
    first = np.searchsorted(src, np.arange(n))
    at = np.arange(len(src)) - first[src]
    most = 2 * edges
    src, dst, sims, at = (v[at < most] for v in (src, dst, sims, at))
    ids, s = np.full((n, most), -1, np.int32), np.full((n, most), -2, np.float32)
    ids[src, at], s[src, at] = dst, sims
    full = np.flatnonzero((ids >= 0).sum(1) > edges)
    out = ids[:, :edges].copy()
    if len(full):
        out[full] = robust_prune(x, full, ids[full], s[full], edges)
    return out


def beam_search(x: np.ndarray, graph: np.ndarray, q: np.ndarray, ids: np.ndarray, sims: np.ndarray, beam: int = BEAM, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The beam best rows met from the entries (ids, sims) of each query, best first.

    Each step expands the best nodes not yet expanded; a query ends when its whole list is.
    """
    out_ids, out_sims = np.full((len(q), beam), -1, np.int32), np.full((len(q), beam), -2, np.float32)
    for b in range(0, len(q), _BATCH):
        rows = np.arange(b, min(b + _BATCH, len(q)))
        i, s = _best(ids[rows], sims[rows], beam)
        if i.shape[1] < beam:
            pad = beam - i.shape[1]
            i, s = np.pad(i, ((0, 0), (0, pad)), constant_values=-1), np.pad(s, ((0, 0), (0, pad)), constant_values=-2)
        done = np.zeros(i.shape, bool)
        while len(rows):
            open_ = ~done & (i >= 0)
            pick = open_ & (np.cumsum(open_, axis=1) <= width)
            active = pick.any(axis=1)
            if not active.all():
                out_ids[rows[~active]], out_sims[rows[~active]] = i[~active], s[~active]
                rows, i, s, done, pick = rows[active], i[active], s[active], done[active], pick[active]
                if not len(rows):
                    break
            at = np.argsort(~pick, axis=1, kind="stable")[:, :width]
            chosen = np.where(np.take_along_axis(pick, at, 1), np.take_along_axis(i, at, 1), -1)
            done |= pick
            new = np.where(chosen[:, :, None] >= 0, graph[chosen], -1).reshape(len(rows), -1)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[(new[:, :, None] == i[:, None, :]).any(axis=2)] = -1
            r, c = np.nonzero(new >= 0)
            near = np.full(new.shape, -2, np.float32)
            near[r, c] = np.einsum("ij,ij->i", q[rows[r]], x[new[r, c]])
            all_i, all_s = np.concatenate((i, new), 1), np.concatenate((s, near), 1)
            all_d = np.concatenate((done, np.zeros(new.shape, bool)), 1)
            part = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            part = np.take_along_axis(part, np.argsort(-np.take_along_axis(all_s, part, 1), axis=1, kind="stable"), 1)
            i, s, done = (np.take_along_axis(v, part, 1) for v in (all_i, all_s, all_d))
            i = np.where(s <= -2, -1, i)
    return out_ids, out_sims


def build(x: np.ndarray, edges: int = EDGES, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, Trees]:
    """(graph, ids, sims, trees): the pruned graph, the nearest rows that each row's search met,
    and the trees where searches enter."""
    n = len(x)
    trees = Trees(x)
    if n == 1:
        return np.full((1, edges), -1, np.int32), np.full((1, 1), -1, np.int32), np.full((1, 1), -2, np.float32), trees
    k = min(max(n - 1, 1), beam)
    ids, sims = entries(x, trees.own_leaves(), x, k, len(trees.trees), True)
    graph = with_reverse(x, robust_prune(x, np.arange(n), ids, sims, edges), edges)
    # greedy searches from what is known propose neighbours; pruning keeps the diverse ones
    ids, sims = beam_search(x, graph, x, ids, sims, beam)
    me = ids == np.arange(n)[:, None]
    ids, sims = np.where(me, -1, ids), np.where(me, np.float32(-2), sims)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    graph = with_reverse(x, robust_prune(x, np.arange(n), ids, sims, edges), edges)
    return graph, ids, sims, trees


def search(x: np.ndarray, graph: np.ndarray, q: np.ndarray, trees: Trees, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """The nearest rows of a built shard for queries from elsewhere."""
    ids, sims = entries(x, trees.leaves(q), q, min(len(x), 8), len(trees.trees), False)
    return beam_search(x, graph, q, ids, sims, beam)
