"""Navigable graphs over bounded sets of unit vectors: robust pruning and range search, in numpy."""

from __future__ import annotations

import numpy as np

_QUERY_ROWS = 256
_SAMPLE_ROWS = 2_048
_PAIR_ROWS = 200_000
_AT_ONCE = 4


def kmeans(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Unit centroids of unit vectors; starts are spread over the sample in its order."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
    for _ in range(rounds):
        own = np.concatenate([np.argmax(sample[lo : lo + _SAMPLE_ROWS] @ centres.T, axis=1) for lo in range(0, len(sample), _SAMPLE_ROWS)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    return np.unique(centres, axis=0)


def robust_prune(units: np.ndarray, degree: int, pool: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, neighbour) of a pruned graph, each in both directions.

    From its nearest ``pool`` vectors a node takes the nearest, drops those that are closer to
    the one taken than to itself by the factor ``alpha``, and goes on with the rest. Reverse edges
    keep the outer nodes of a dense clump within reach of its centre.
    """
    n = len(units)
    pool = min(pool, n - 1)
    sources, targets = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, n if pool else 0, _QUERY_ROWS):
        sims = units[start : start + _QUERY_ROWS] @ units.T
        rows = np.arange(len(sims))
        sims[rows, start + rows] = -np.inf
        near = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable"), 1)
        far = 1 - np.take_along_axis(sims, near, 1)
        among = 1 - np.matmul(units[near], units[near].transpose(0, 2, 1))
        alive = np.ones(near.shape, bool)
        for _ in range(min(degree, pool)):
            has = alive.any(axis=1)
            if not has.any():
                break
            pick = np.argmax(alive, axis=1)
            sources.append(start + rows[has])
            targets.append(near[rows[has], pick[has]])
            alive &= ~(alpha * among[rows, pick] <= far)
            alive[rows, pick] = False
    one, other = np.concatenate(sources), np.concatenate(targets)
    pairs = np.unique(np.concatenate([one * n + other, other * n + one]))
    return pairs // max(n, 1), pairs % max(n, 1)


class Graph:
    """Adjacency lists one behind the other."""

    def __init__(self, n: int, source: np.ndarray, target: np.ndarray) -> None:
        order = np.argsort(source, kind="stable")
        self._target = target[order]
        self._start = np.searchsorted(source[order], np.arange(n + 1))

    def neighbours(self, owner: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, neighbour) for all neighbours of each node."""
        count = self._start[node + 1] - self._start[node]
        skip = np.cumsum(count) - count
        at = np.arange(count.sum()) + np.repeat(self._start[node] - skip, count)
        return np.repeat(owner, count), self._target[at]


def medoid(units: np.ndarray) -> int:
    return int(np.argmax(units @ units.sum(axis=0)))


def range_search(units: np.ndarray, graph: Graph, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with cosine ``least`` or more that a search over ``graph`` meets."""
    return np.nonzero(range_matches(units, graph, least, beam))


def range_matches(units: np.ndarray, graph: Graph, least: float, beam: int) -> np.ndarray:
    """Query by node: whether a search over ``graph`` meets the node at cosine ``least`` or more.

    Every vector is a query. Greedy search starts at the medoid and at the query's own node and
    expands until the best ``beam`` nodes are done; then every node in range is expanded until
    none is new.
    """
    n = len(units)
    entry = medoid(units)
    hit = np.zeros((n, n), bool)
    for start in range(0, n, _QUERY_ROWS):
        mine = np.arange(start, min(start + _QUERY_ROWS, n))
        hit[mine] = _search(units, graph, mine, entry, least, min(beam, n))
    return hit


def _search(units: np.ndarray, graph: Graph, mine: np.ndarray, entry: int, least: float, beam: int) -> np.ndarray:
    count, n = len(mine), len(units)
    done = np.zeros((count, n), bool)
    near = np.full((count, n), -np.inf)  # -inf: not seen
    # The best ``beam`` nodes seen by each query: a node that leaves them never comes back.
    held, top = np.full((count, beam), -np.inf), np.zeros((count, beam), np.int64)
    rows = np.arange(count)

    def visit(q: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.isneginf(near[q, node])
        flat = np.unique(q[new] * n + node[new])
        q, node = flat // n, flat % n
        for at in range(0, len(q), _PAIR_ROWS):
            part = slice(at, at + _PAIR_ROWS)
            near[q[part], node[part]] = np.einsum("pd,pd->p", units[mine[q[part]]], units[node[part]])
        return q, node

    def hold(q: np.ndarray, node: np.ndarray) -> None:
        """Newly seen nodes, by query, enter the best ones."""
        owner, first, size = np.unique(q, return_index=True, return_counts=True)
        sims = np.full((len(owner), size.max(initial=0)), -np.inf)
        names = np.zeros(sims.shape, np.int64)
        line = np.repeat(np.arange(len(owner)), size)
        place = np.arange(len(q)) - np.repeat(first, size)
        sims[line, place], names[line, place] = near[q, node], node
        sims, names = np.hstack([held[owner], sims]), np.hstack([top[owner], names])
        best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
        held[owner], top[owner] = np.take_along_axis(sims, best, 1), np.take_along_axis(names, best, 1)

    hold(*visit(np.concatenate([rows, rows]), np.concatenate([np.full(count, entry), mine])))
    active = rows
    while len(active):
        waiting = np.where(done[active[:, None], top[active]], -np.inf, held[active])
        best = np.argsort(-waiting, axis=1)[:, :_AT_ONCE]
        going = np.isfinite(np.take_along_axis(waiting, best, 1))
        owner, slot = np.nonzero(going)
        q, node = active[owner], top[active[owner], best[owner, slot]]
        done[q, node] = True
        hold(*visit(*graph.neighbours(q, node)))
        active = active[going.any(axis=1)]
    q, node = np.nonzero((near >= least) & ~done)
    while len(q):
        done[q, node] = True
        q, node = visit(*graph.neighbours(q, node))
        keep = near[q, node] >= least
        q, node = q[keep], node[keep]
    return near >= least


def audited_search(
    units: np.ndarray, graph: Graph, least: float, beam: int, recall: float, every: int
) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(audited_matches(units, graph, least, beam, recall, every))


def audited_matches(units: np.ndarray, graph: Graph, least: float, beam: int, recall: float, every: int) -> np.ndarray:
    """``range_matches`` checked against all vectors for each ``every``-th query; the beam doubles
    until the audited recall is met (at the full width the search is exhaustive)."""
    audit = np.arange(0, len(units), every)
    truth = units[audit] @ units.T >= least
    while True:
        hit = range_matches(units, graph, least, beam)
        if beam >= len(units) or (hit[audit] & truth).sum() >= recall * truth.sum():
            return hit
        beam *= 2


def local_roots(hit: np.ndarray) -> np.ndarray:
    """Smallest index each node reaches over a symmetric matrix of matches; a row is read once."""
    root = np.where(hit.any(axis=1), -1, np.arange(len(hit)))
    for start in np.flatnonzero(root < 0):
        if root[start] >= 0:
            continue
        fresh = np.array([start])
        while len(fresh):
            root[fresh] = start
            reached = np.zeros(len(hit), bool)
            for at in range(0, len(fresh), _QUERY_ROWS):
                reached |= hit[fresh[at : at + _QUERY_ROWS]].any(axis=0)
            fresh = np.flatnonzero(reached & (root < 0))
    return root
