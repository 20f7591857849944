"""A hierarchical navigable small-world graph in numpy, many queries at a step.

Nodes are ordered by level, highest first, so that the nodes of a layer are a prefix of
those of the layer below, and a layer is one matrix of neighbours.  Layers are built from
the top; nodes enter in growing batches, find candidates by searching the layer as it
stands from where the layers above lead, and by comparison within their batch, and keep
those that no kept one is closer to than the node itself.
"""

from __future__ import annotations

import numpy as np

DEGREE = 10
BUILD_BEAM = 28
#: Candidates of a query that are expanded in one step.
_WIDE = 4
_BATCH = 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, as float64."""
    x = np.asarray(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _beam(layer: np.ndarray, x: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and similarities (best first, -1 where none) of about the ef nearest of the first n nodes."""
    rows = len(q)
    ids = np.full((rows, ef), -1, dtype=np.int64)
    sims = np.full((rows, ef), -3.0, dtype=np.float32)
    closed = np.ones((rows, ef), dtype=bool)
    seen = np.zeros(rows * n, dtype=bool)
    ids[:, 0], closed[:, 0] = entry, False
    sims[:, 0] = np.einsum("ij,ij->i", x[entry], q)
    seen[np.arange(rows) * n + entry] = True
    active = np.arange(rows)
    wide = min(_WIDE, ef)
    while len(active):
        open_sims = np.where(closed[active], -9.0, sims[active])
        pick = np.argpartition(-open_sims, wide - 1, axis=1)[:, :wide] if ef > wide else np.broadcast_to(np.arange(ef), (len(active), ef))
        good = np.take_along_axis(open_sims, pick, axis=1) > -9.0
        some = good.any(axis=1)
        active, pick, good = active[some], pick[some], good[some]
        if not len(active):
            break
        chosen = ids[active[:, None], pick]
        closed[active[:, None], pick] = True
        near = np.where(good[:, :, None], layer[chosen], -1).reshape(len(active), -1)
        flat = near + np.arange(len(active))[:, None] * n
        flat = np.unique(flat[near >= 0])
        at, node = np.divmod(flat, n)
        fresh = ~seen[active[at] * n + node]
        at, node = at[fresh], node[fresh]
        seen[active[at] * n + node] = True
        if not len(at):
            continue
        found = np.einsum("ij,ij->i", x[node], q[active[at]])
        count = np.bincount(at, minlength=len(active))
        place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        more_ids = np.full((len(active), count.max()), -1, dtype=np.int64)
        more_sims = np.full((len(active), count.max()), -3.0, dtype=np.float32)
        more_ids[at, place], more_sims[at, place] = node, found
        all_ids = np.concatenate((ids[active], more_ids), axis=1)
        all_sims = np.concatenate((sims[active], more_sims), axis=1)
        all_closed = np.concatenate((closed[active], more_ids < 0), axis=1)
        top = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
        ids[active] = np.take_along_axis(all_ids, top, axis=1)
        sims[active] = np.take_along_axis(all_sims, top, axis=1)
        closed[active] = np.take_along_axis(all_closed, top, axis=1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def _diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of candidates (best first, -1 where none) those to which no kept one is closer; then the best others."""
    rows, width = ids.shape
    kept = np.full((rows, keep), -1, dtype=np.int64)
    count = np.zeros(rows, dtype=np.int64)
    closest = np.full((rows, width), -3.0, dtype=np.float32)  # to any kept one
    used = ids < 0
    vectors = x[np.maximum(ids, 0)]
    every = np.arange(rows)
    for k in range(width):
        take = ~used[:, k] & (closest[:, k] < sims[:, k]) & (count < keep)
        at = every[take]
        if len(at):
            kept[at, count[at]] = ids[at, k]
            count[at] += 1
            used[at, k] = True
            closest[at] = np.maximum(closest[at], np.einsum("rwd,rd->rw", vectors[at], vectors[at, k]))
    for k in range(width):
        take = ~used[:, k] & (count < keep)
        at = every[take]
        kept[at, count[at]] = ids[at, k]
        count[at] += 1
    return kept


class Graph:
    """Index of float32 unit vectors; ``search`` numbers nodes as they were given."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 11):
        n = len(vectors)
        height = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(degree)).astype(np.int64)
        self.order = np.argsort(-height, kind="stable")
        self.x = np.ascontiguousarray(vectors[self.order], dtype=np.float32)
        self.layers: list[np.ndarray] = []  # from the top
        sizes = [int((height >= level).sum()) for level in range(int(height.max(initial=0)), -1, -1)]
        for k, size in enumerate(sizes):
            self._build(size, sizes[k - 1] if k else 0, degree * (2 if k == len(sizes) - 1 else 1), degree, beam)

    def _build(self, size: int, above: int, width: int, degree: int, beam: int) -> None:
        layer = np.full((size, width), -1, dtype=np.int64)
        start, step = 0, max(above, 32)
        while start < size:
            stop = min(size, start + step)
            own = self.x[start:stop]
            within = own @ own.T
            np.fill_diagonal(within, -3.0)
            top = np.argsort(-within, axis=1, kind="stable")[:, :beam]
            ids, sims = top + start, np.take_along_axis(within, top, axis=1)
            ids = np.where(sims > -3.0, ids, -1)
            if start:
                parts = []
                for a in range(start, stop, _BATCH):
                    q = self.x[a : min(stop, a + _BATCH)]
                    parts.append(_beam(layer, self.x, q, self._descend(q), beam, start))
                old_ids, old_sims = (np.concatenate(p) for p in zip(*parts, strict=True))
                ids, sims = np.concatenate((ids, old_ids), axis=1), np.concatenate((sims, old_sims), axis=1)
                order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
                ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
            kept = _diverse(self.x, ids, sims, degree)
            layer[start:stop, :degree] = kept
            self._link_back(layer, start, kept)
            start, step = stop, min(2 * step, 1024)
        self.layers.append(layer)

    def _link_back(self, layer: np.ndarray, start: int, kept: np.ndarray) -> None:
        """Adds the batch's nodes to the neighbours of those they chose."""
        source = np.repeat(np.arange(start, start + len(kept)), kept.shape[1])
        target = kept.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        width = layer.shape[1]
        old = np.unique(target)
        # Links there are already, then new ones, all as pairs, without repetition.
        was = layer[old]
        t = np.concatenate((np.repeat(old, width)[was.reshape(-1) >= 0], target))
        s = np.concatenate((was.reshape(-1)[was.reshape(-1) >= 0], source))
        pair = np.unique(t * len(self.x) + s)
        t, s = np.divmod(pair, len(self.x))
        sims = np.einsum("ij,ij->i", self.x[t], self.x[s])
        order = np.lexsort((-sims, t))
        t, s, sims = t[order], s[order], sims[order]
        count = np.bincount(np.searchsorted(old, t), minlength=len(old))
        row = np.searchsorted(old, t)
        place = np.arange(len(t)) - np.repeat(np.cumsum(count) - count, count)
        use = place < 3 * width  # the best by far; the others are not kept anyhow
        ids = np.full((len(old), min(3 * width, int(count.max(initial=1)))), -1, dtype=np.int64)
        near = np.full(ids.shape, -3.0, dtype=np.float32)
        ids[row[use], place[use]], near[row[use], place[use]] = s[use], sims[use]
        few = count <= width
        layer[old[few]] = -1
        layer[old[few], : min(width, ids.shape[1])] = ids[few, :width]
        if (~few).any():
            layer[old[~few]] = _diverse(self.x, ids[~few], near[~few], width)

    def _descend(self, q: np.ndarray) -> np.ndarray:
        entry = np.zeros(len(q), dtype=np.int64)
        for layer in self.layers:
            entry = _beam(layer, self.x, q, entry, 4, len(layer))[0][:, 0]
        return entry

    def search(self, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of about the ef nearest nodes of each query, best first, -1 where none."""
        ef = max(1, min(ef, len(self.x)))
        all_ids, all_sims = [], []
        for a in range(0, len(q), _BATCH):
            part = np.ascontiguousarray(q[a : a + _BATCH], dtype=np.float32)
            entry = np.zeros(len(part), dtype=np.int64)
            for layer in self.layers[:-1]:
                entry = _beam(layer, self.x, part, entry, 4, len(layer))[0][:, 0]
            ids, sims = _beam(self.layers[-1], self.x, part, entry, ef, len(self.x))
            all_ids.append(np.where(ids >= 0, self.order[np.maximum(ids, 0)], -1))
            all_sims.append(sims)
        if not all_ids:
            return np.zeros((0, ef), dtype=np.int64), np.zeros((0, ef), dtype=np.float32)
        return np.concatenate(all_ids), np.concatenate(all_sims)
