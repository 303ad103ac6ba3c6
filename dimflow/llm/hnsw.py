"""A hierarchical navigable small-world graph over unit vectors, in numpy.

Nodes get a level by a geometric law; every layer links the nodes of at least its
level.  A search goes down from the top and keeps a beam of the best nodes seen,
expanding the best that are not expanded yet.  Many searches advance together,
one numpy step at a time.  Nodes are inserted from the highest level down, in
batches that at most double the graph.
"""

from __future__ import annotations

import io

import numpy as np

LINKS = 16  # chosen for a new node
CAPACITY = 48  # held by a node; a full list is cut to half by the same choice
BUILD_BEAM = 48
BATCH = 1024
EXPAND = 4  # beam entries that one step expands
VISITED = 1 << 25  # bytes of the marks of nodes seen


class Graph:
    def __init__(self, vectors: np.ndarray, level: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.level, self.links = vectors, level, links
        self.rank = [np.cumsum(level >= k) - 1 for k in range(len(links))]
        self.entry = int(np.argmax(level)) if len(level) else -1

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 0) -> Graph:
        n = len(vectors)
        draw = np.random.default_rng(seed).random(n)
        level = (-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(np.int64)
        layers = int(level.max(initial=0)) + 1
        links = [np.full((int((level >= k).sum()), CAPACITY), -1, np.int32) for k in range(layers)]
        graph = cls(vectors.astype(np.float32), level, links)
        order = np.argsort(-level, kind="stable")
        graph.entry = int(order[0]) if n else -1
        done = 0
        while done < n:
            size = min(BATCH, max(done, 64), n - done)
            graph._insert(order[done : done + size], empty=done == 0)
            done += size
        return graph

    def to_bytes(self) -> bytes:
        """Levels and links; the vectors are kept by the caller."""
        out = io.BytesIO()
        layers = {f"layer{k}": x for k, x in enumerate(self.links)}
        np.savez(out, level=self.level, **layers)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes, vectors: np.ndarray) -> Graph:
        with np.load(io.BytesIO(raw)) as held:
            links = [held[f"layer{k}"] for k in range(len(held.files) - 1)]
            graph = cls(vectors.astype(np.float32), held["level"], links)
        graph.entry = int(np.argmax(graph.level)) if len(graph.level) else -1
        return graph

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and cosines of the best ``beam`` found for each query, best first;
        missing ones are -1."""
        at = np.full((len(queries), 1), self.entry)
        for layer in range(len(self.links) - 1, 0, -1):
            at = self._beam(layer, queries, at, 1)[0]
        return self._beam(0, queries, at, beam)

    def _beam(self, layer: int, queries: np.ndarray, entries: np.ndarray, beam: int):
        """Runs of queries whose marks of seen nodes fit in memory."""
        step = max(1, min(len(queries), VISITED // max(1, len(self.vectors)), (1 << 21) // beam))
        parts = [
            self._together(layer, queries[a : a + step], entries[a : a + step], beam)
            for a in range(0, len(queries), step)
        ]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _together(self, layer: int, queries: np.ndarray, entries: np.ndarray, beam: int):
        n, width = len(queries), max(beam, entries.shape[1])
        seen = np.zeros((n, len(self.vectors)), bool)
        ids = np.full((n, width), -1)
        ids[:, : entries.shape[1]] = entries
        near = np.full((n, width), -np.inf, np.float32)
        rows, columns = np.nonzero(ids >= 0)
        near[rows, columns] = self._cosines(queries[rows], ids[rows, columns])
        seen[rows, ids[rows, columns]] = True
        done = ids < 0
        rank, links = self.rank[layer], self.links[layer]
        active = np.arange(n)
        while True:
            pick = np.argsort(done[active], axis=1, kind="stable")[:, :EXPAND]
            fresh = ~np.take_along_axis(done[active], pick, axis=1)
            moving = fresh.any(axis=1)
            if not moving.any():
                break
            active, pick, fresh = active[moving], pick[moving], fresh[moving]
            done[active[:, None], pick] = True
            nodes = ids[active[:, None], pick]
            nexts = links[rank[nodes]]
            nexts[~fresh] = -1
            nexts = np.sort(nexts.reshape(len(active), -1), axis=1)
            new = nexts >= 0
            new[:, 1:] &= nexts[:, 1:] != nexts[:, :-1]
            new &= ~seen[active[:, None], nexts]
            rows, columns = np.nonzero(new)
            found = nexts[rows, columns]
            seen[active[rows], found] = True
            cosine = np.full(nexts.shape, -np.inf, np.float32)
            cosine[rows, columns] = self._cosines(queries[active[rows]], found)
            all_ids = np.concatenate([ids[active], nexts], axis=1)
            all_near = np.concatenate([near[active], cosine], axis=1)
            all_done = np.concatenate([done[active], ~new], axis=1)
            best = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            order = np.argsort(-np.take_along_axis(all_near, best, axis=1), axis=1, kind="stable")
            best = np.take_along_axis(best, order, axis=1)
            near[active] = np.take_along_axis(all_near, best, axis=1)
            ids[active] = np.take_along_axis(all_ids, best, axis=1)
            done[active] = np.take_along_axis(all_done, best, axis=1) | np.isneginf(near[active])
        ids[np.isneginf(near)] = -1
        return ids[:, :beam], near[:, :beam]

    def _cosines(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", queries, self.vectors[nodes])

    def _insert(self, batch: np.ndarray, empty: bool) -> None:
        vectors = self.vectors[batch]
        at = np.full((len(batch), 1), self.entry)
        for layer in range(len(self.links) - 1, -1, -1):
            mine = np.flatnonzero(self.level[batch] >= layer)
            if empty:
                ids = np.empty((len(batch), 0), np.int64)
                near = np.empty((len(batch), 0), np.float32)
            else:
                ids, near = self._beam(layer, vectors, at, BUILD_BEAM if layer == 0 else LINKS)
                at = ids[:, :4]
            if len(mine):
                ids, near = self._with_batch(batch[mine], vectors[mine], ids[mine], near[mine])
                self._link(layer, batch[mine], ids, near)

    def _with_batch(self, batch, vectors, ids, near):
        """Candidates found in the graph and the nearest of the same batch."""
        cosine = vectors @ vectors.T
        np.fill_diagonal(cosine, -np.inf)
        take = min(LINKS, max(len(batch) - 1, 0))
        best = np.argsort(-cosine, axis=1, kind="stable")[:, :take]
        ids = np.concatenate([ids, batch[best]], axis=1)
        near = np.concatenate([near, np.take_along_axis(cosine, best, axis=1)], axis=1)
        near = np.where(ids >= 0, near, -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)

    def _link(self, layer: int, batch: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
        links, rank = self.links[layer], self.rank[layer]
        chosen = self._choose(ids, near, LINKS)
        links[rank[batch], : chosen.shape[1]] = chosen
        rows, columns = np.nonzero(chosen >= 0)
        source, target = batch[rows], chosen[rows, columns]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        while len(target):  # one new link per target and round
            first = np.ones(len(target), bool)
            first[1:] = target[1:] != target[:-1]
            self._add(layer, target[first], source[first])
            source, target = source[~first], target[~first]

    def _add(self, layer: int, nodes: np.ndarray, new: np.ndarray) -> None:
        links, rank = self.links[layer], self.rank[layer]
        rows = rank[nodes]
        have = (links[rows] == new[:, None]).any(axis=1)
        nodes, new, rows = nodes[~have], new[~have], rows[~have]
        size = (links[rows] >= 0).sum(axis=1)
        full = size >= CAPACITY
        links[rows[~full], size[~full]] = new[~full]
        if full.any():
            nodes, new, rows = nodes[full], new[full], rows[full]
            ids = np.concatenate([links[rows], new[:, None]], axis=1).astype(np.int64)
            near = np.einsum("id,ikd->ik", self.vectors[nodes], self.vectors[ids])
            order = np.argsort(-near, axis=1, kind="stable")
            chosen = self._choose(
                np.take_along_axis(ids, order, axis=1),
                np.take_along_axis(near, order, axis=1),
                CAPACITY // 2,
            )
            links[rows] = -1
            links[rows, : chosen.shape[1]] = chosen

    def _choose(self, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """From candidates, best first, those nearer to the node than to any chosen
        one before them, then the best of the others."""
        out = []
        for a in range(0, len(ids), 256):
            some, close = ids[a : a + 256], near[a : a + 256]
            vectors = self.vectors[some]
            among = vectors @ vectors.transpose(0, 2, 1)
            chosen = np.zeros(some.shape, bool)
            for j in range(some.shape[1]):
                hidden = (chosen & (among[:, j] > close[:, j, None])).any(axis=1)
                chosen[:, j] = (some[:, j] >= 0) & ~hidden & (chosen.sum(axis=1) < most)
            order = np.argsort(np.where(chosen, 0, np.where(some >= 0, 1, 2)), axis=1, kind="stable")
            out.append(np.take_along_axis(some, order, axis=1)[:, :most])
        return np.concatenate(out) if out else np.empty((0, most), np.int64)
