"""Navigable small-world graphs for unit vectors, searched for many queries at once.

Nodes are ordered so that the upper levels are prefixes of the numbering: level 0 holds all n
nodes, each level above a share of ``1 / STEP`` of the one below. Nodes join a level in batches.
A batch finds its neighbours by beam search among the nodes that are in already and by comparison
with one another; of the candidates a node keeps those that are nearer to it than to a neighbour
already kept, so that clusters stay reachable.
"""

from __future__ import annotations

import numpy as np

STEP = 16
DEGREE = 24
BUILD_BEAM = 48
BATCH = 512
_OPEN = 4  # nodes that each query opens at a time


def products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products of each row of ``q`` with its own list of vectors."""
    return (v @ q[:, :, None])[:, :, 0]


def beam_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that each query reaches from its ``entries``, nearest first, and
    their similarities; -1 and -inf where it reaches fewer."""
    n_queries = len(queries)
    ids = np.full((n_queries, beam), -1, np.int32)
    sims = np.full((n_queries, beam), -np.inf, np.float32)
    for at in range(0, n_queries, BATCH):
        stop = min(n_queries, at + BATCH)
        ids[at:stop], sims[at:stop] = _beam(x, links, queries[at:stop], entries[at:stop], beam)
    return ids, sims


def _best(ids: np.ndarray, sims: np.ndarray, opened: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if ids.shape[1] > beam:
        at = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
        rows = np.arange(len(ids))[:, None]
        ids, sims, opened = ids[rows, at], sims[rows, at], opened[rows, at]
    return ids, sims, opened


def _beam(x, links, queries, entries, beam):
    n = len(links)
    b = len(queries)
    out_ids = np.full((b, beam), -1, np.int32)
    out_sims = np.full((b, beam), -np.inf, np.float32)
    live = np.arange(b)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # -1 points here: no node
    ids = np.where(entries < n, entries, -1).astype(np.int32)
    # an entry given twice counts once
    ids.sort(1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    sims = products(x[ids], queries)
    sims[ids < 0] = -np.inf
    seen[np.arange(b)[:, None], ids] = True
    opened = ids < 0
    q = queries
    while len(live):
        ids, sims, opened = _best(ids, sims, opened, beam)
        rows = np.arange(len(live))[:, None]
        waiting = np.where(opened, -np.inf, sims)
        k = min(_OPEN, waiting.shape[1])
        at = np.argpartition(-waiting, k - 1, axis=1)[:, :k] if waiting.shape[1] > k else np.tile(np.arange(k), (len(live), 1))
        some = waiting[rows, at] > -np.inf
        done = ~some.any(1)
        if done.any():
            w = ids.shape[1]
            out_ids[live[done], :w], out_sims[live[done], :w] = ids[done], sims[done]
            keep = ~done
            live, ids, sims, opened, q, seen, at, some = (v[keep] for v in (live, ids, sims, opened, q, seen, at, some))
            if not len(live):
                break
            rows = np.arange(len(live))[:, None]
        opened[rows, at] = True
        near = np.where(some[:, :, None], links[ids[rows, at]], -1).reshape(len(live), -1)
        near = np.where(seen[rows, near], -1, near)
        near.sort(1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[rows, near] = True
        found = products(x[near], q)
        found[near < 0] = -np.inf
        ids = np.concatenate([ids, near.astype(np.int32)], 1)
        sims = np.concatenate([sims, found], 1)
        opened = np.concatenate([opened, near < 0], 1)
    order = np.argsort(-out_sims, 1, kind="stable")
    rows = np.arange(b)[:, None]
    return out_ids[rows, order], out_sims[rows, order]


def spread(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1 for none) the neighbours to keep: those nearer to
    the row than to a neighbour kept before, then the nearest of the rest."""
    b, k = ids.shape
    v = x[ids]
    between = v @ v.transpose(0, 2, 1)
    kept = np.zeros((b, k), bool)
    valid = (ids >= 0) & (sims > -np.inf)
    for i in range(k):
        closest = np.where(kept, between[:, i, :], -np.inf).max(1)
        kept[:, i] = valid[:, i] & (closest < sims[:, i]) & (kept.sum(1) < degree)
    rank = np.where(kept, np.arange(k), np.where(valid, k + np.arange(k), 3 * k))
    order = np.argsort(rank, 1, kind="stable")[:, :degree]
    rows = np.arange(b)[:, None]
    out = np.where(valid[rows, order], ids[rows, order], -1)
    if out.shape[1] < degree:
        out = np.concatenate([out, np.full((b, degree - out.shape[1]), -1, out.dtype)], 1)
    return out.astype(np.int32)


def _sorted(ids: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, 1, kind="stable")[:, :most]
    rows = np.arange(len(ids))[:, None]
    return ids[rows, order], sims[rows, order]


def build(x: np.ndarray) -> list[np.ndarray]:
    """Links of the levels from 0 up, for unit vectors in an order without meaning."""
    sizes = [len(x)]
    while sizes[-1] > BATCH:
        sizes.append(-(-sizes[-1] // STEP))
    levels: list[np.ndarray] = []
    for size in reversed(sizes):
        links = np.full((size, DEGREE), -1, np.int32)
        begin = 0
        while begin < size:
            end = min(size, begin + (BATCH if begin else max(BATCH, min(size, len(levels[-1]) if levels else 0))))
            for at in range(begin, end, BATCH):
                _join(x, links, levels, at, min(end, at + BATCH))
            begin = end
        levels.append(links)
    return levels[::-1]


def _join(x: np.ndarray, links: np.ndarray, above: list[np.ndarray], begin: int, end: int) -> None:
    """Nodes ``begin`` to ``end`` join the level; all before are in."""
    own = np.arange(begin, end)
    q = x[begin:end]
    mutual = q @ q.T
    np.fill_diagonal(mutual, -np.inf)
    ids = np.broadcast_to(own.astype(np.int32), mutual.shape)
    sims = mutual
    if begin:
        entries = entry_points(x, above, q)
        entries = np.where(entries < begin, entries, 0)
        a, s = beam_search(x, links[:begin], q, entries, BUILD_BEAM)
        ids, sims = np.concatenate([a, ids], 1), np.concatenate([s, sims], 1)
    ids, sims = _sorted(ids, sims, BUILD_BEAM)
    links[begin:end] = spread(x, np.where(sims > -np.inf, ids, -1), sims, DEGREE)
    # links back: each node weighs the new ones against those it has
    source = np.repeat(own, DEGREE)
    target = links[begin:end].ravel()
    source, target = source[target >= 0], target[target >= 0]
    near = np.einsum("id,id->i", x[source], x[target])
    order = np.lexsort((-near, target))
    source, target, near = source[order], target[order], near[order]
    nodes, first = np.unique(target, return_index=True)
    place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
    some = place < DEGREE
    added = np.full((len(nodes), DEGREE), -1, np.int32)
    added_sims = np.full((len(nodes), DEGREE), -np.inf, np.float32)
    row = np.searchsorted(nodes, target[some])
    added[row, place[some]], added_sims[row, place[some]] = source[some], near[some]
    for at in range(0, len(nodes), BATCH):
        part = slice(at, at + BATCH)
        old = links[nodes[part]]
        old_sims = products(x[old], x[nodes[part]])
        old_sims[old < 0] = -np.inf
        new, new_sims = added[part], added_sims[part]
        twice = (new[:, :, None] == old[:, None, :]).any(2)
        ids, sims = _sorted(np.concatenate([old, np.where(twice, -1, new)], 1), np.concatenate([old_sims, np.where(twice, -np.inf, new_sims)], 1), 2 * DEGREE)
        links[nodes[part]] = spread(x, np.where(sims > -np.inf, ids, -1), sims, DEGREE)


def entry_points(x: np.ndarray, above: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Nodes to start from: the levels ``above``, from the top, are searched with a small beam."""
    if not above:
        return np.zeros((len(queries), 1), np.int32)
    # the top level is small: all its nodes are looked at
    top = queries @ x[:len(above[0])].T
    k = min(4, top.shape[1])
    entries = np.argpartition(-top, k - 1, axis=1)[:, :k] if top.shape[1] > k else np.tile(np.arange(k), (len(queries), 1))
    for links in above[1:]:
        ids, _ = beam_search(x, links, queries, entries, 8)
        entries = np.where(ids[:, :4] >= 0, ids[:, :4], 0)
    return entries


def search(x: np.ndarray, levels: list[np.ndarray], queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    entries = entry_points(x, levels[:0:-1], queries)
    return beam_search(x, levels[0], queries, entries, min(beam, len(x)))
