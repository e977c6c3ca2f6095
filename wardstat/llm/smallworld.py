"""Hierarchical navigable small-world graphs over unit vectors, built and searched in blocks.

Points are put in the order of their levels, so that a layer is a prefix of them
and the layers above are whole when one is built. A block of points is searched
for at once: each point's beam holds the best points that it has met, and the
neighbours of a few of those that are not yet expanded are looked at together.
"""

from __future__ import annotations

import io

import numpy as np

#: Links that a new point asks for; a point keeps at most twice as many.
LINKS = 16
#: Points in the beam while the graph is built, points inserted together, beam points expanded together.
BEAM = 48
BLOCK = 256
EXPANDED = 4
#: Floats in a block of vectors that are compared with each other.
COMPARED = 1 << 22


def _top(ids, scores, done, size):
    """The best of each row, best first."""
    order = np.argsort(-scores, axis=1, kind="stable")[:, :size]
    return [np.take_along_axis(x, order, 1) for x in (ids, scores, done)]


def _padded(rows, values, scores, height):
    """Values and scores of sorted row numbers as matrices, filled with -1 and the least score."""
    counts = np.bincount(rows, minlength=height)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    ids = np.full((height, counts.max(initial=0)), -1, np.int64)
    best = np.full(ids.shape, -np.inf, np.float32)
    ids[rows, at], best[rows, at] = values, scores
    return ids, best


def held_by(matrix):
    """Rows and columns of the entries of a matrix that are set; much faster than ``nonzero`` where they are few."""
    return np.divmod(np.flatnonzero(matrix), max(1, matrix.shape[1]))


class Graph:
    """``points`` are unit vectors as floats, ``layers`` their links from the top layer down, -1 for none.

    To walk costs a query as much as some ten thousand comparisons at once. A graph
    of few points needs no layers: without them all points are looked at.
    """

    def __init__(self, points, layers=()):
        self.points, self.layers = points, list(layers)

    @classmethod
    def build(cls, points):
        """The graph of unit vectors and the order that it puts them in."""
        draw = np.random.default_rng(len(points)).random(len(points))
        level = np.floor(-np.log(1 - draw) / np.log(LINKS)).astype(np.int64)
        order = np.argsort(-level, kind="stable")
        graph = cls(points[order].astype(np.float32))
        for height in range(int(level.max(initial=0)), -1, -1):
            graph._add_layer(int((level >= height).sum()))
        return graph, order

    def _add_layer(self, size):
        links = np.full((size, 2 * LINKS), -1, np.int32)
        for first in range(0, size, BLOCK):
            block = np.arange(first, min(size, first + BLOCK))
            own = self.points[block] @ self.points[block].T
            np.fill_diagonal(own, -np.inf)
            ids, scores = np.tile(block, (len(block), 1)), own
            if first:
                found = self._search(self.points[block], self._entries(self.points[block], first), links, first, BEAM)
                ids, scores = np.hstack([ids, found[0]]), np.hstack([scores, found[1]])
            ids, scores, _ = _top(ids, scores, ids, BEAM)
            links[block, :LINKS] = self._diverse(ids, scores, LINKS)
            self._link_back(links, block)
        self.layers.append(links)

    def _diverse(self, ids, scores, keep):
        """Of each row's candidates, best first: those nearer to it than to any chosen one, then the best others."""
        made = np.full((len(ids), keep), -1, np.int64)
        step = max(1, COMPARED // (ids.shape[1] * (ids.shape[1] + self.points.shape[1]) + 1))
        for at in range(0, len(ids), step):
            some, score = ids[at:at + step], scores[at:at + step]
            there = (some >= 0) & (score > -np.inf)
            held = self.points[some]
            between = held @ held.transpose(0, 2, 1)
            covered, chosen = np.zeros(some.shape, bool), np.zeros(some.shape, bool)
            for c in range(some.shape[1]):
                take = there[:, c] & ~covered[:, c] & (chosen.sum(axis=1) < keep)
                chosen[:, c] = take
                covered |= take[:, None] & (between[:, c] > score)
            rank = np.where(chosen, 0, np.where(there, 1, 2))
            order = np.argsort(rank, axis=1, kind="stable")[:, :keep]
            picked = np.where(np.take_along_axis(there, order, 1), np.take_along_axis(some, order, 1), -1)
            made[at:at + step, :picked.shape[1]] = picked
        return made

    def _link_back(self, links, block):
        """Links to a block's points from those that they chose; who has too many keeps the diverse ones."""
        to, back = links[block, :LINKS].ravel().astype(np.int64), np.repeat(block, LINKS)
        new = (to >= 0) & ~(links[to] == back[:, None]).any(axis=1)
        order = np.argsort(to[new], kind="stable")
        to, back = to[new][order], back[new][order]
        who, first, counts = np.unique(to, return_index=True, return_counts=True)
        held = (links[who] >= 0).sum(axis=1)
        place = np.repeat(held - first, counts) + np.arange(len(to))
        fits = np.repeat(held + counts <= links.shape[1], counts)
        links[to[fits], place[fits]] = back[fits]
        full = np.flatnonzero(held + counts > links.shape[1])
        full = full[np.argsort(counts[full], kind="stable")]
        for some in np.array_split(full, max(1, len(full) // BLOCK)):
            if len(some):
                mine = np.isin(to, who[some])
                rows = np.searchsorted(np.sort(who[some]), to[mine])
                mates = np.sort(who[some])
                more, _ = _padded(rows, back[mine], np.zeros(len(rows)), len(mates))
                ids = np.hstack([links[mates].astype(np.int64), more])
                scores = np.where(ids >= 0, np.einsum("bcd,bd->bc", self.points[ids], self.points[mates]), -np.inf)
                ids, scores, _ = _top(ids, scores, ids, ids.shape[1])
                links[mates] = self._diverse(ids, scores, links.shape[1])

    def _entries(self, queries, upto):
        """Points below ``upto`` to start from, found in the layers above."""
        entries = np.zeros((len(queries), 1), np.int64)
        for links in self.layers:
            entries = self._search(queries, entries, links, len(links), EXPANDED)[0][:, :EXPANDED]
        return np.where((entries >= 0) & (entries < upto), entries, 0)

    def _search(self, queries, entries, links, upto, beam):
        """The best ``beam`` points that a search of one layer meets, and their scores, best first."""
        n = len(queries)
        ids, scores = np.full((n, beam), -1, np.int64), np.full((n, beam), -np.inf, np.float32)
        done, seen = np.ones((n, beam), bool), np.zeros((n, upto), bool)
        rows, met = np.repeat(np.arange(n), entries.shape[1]), entries.ravel()
        while len(rows):
            code = np.unique(rows * upto + met)
            rows, met = code // upto, code % upto
            seen[rows, met] = True
            score = np.einsum("ij,ij->i", queries[rows], self.points[met])
            better = score > scores[rows, -1]
            some, number = np.unique(rows[better], return_inverse=True)
            if len(some):
                more, best = _padded(number, met[better], score[better], len(some))
                ids[some], scores[some], done[some] = _top(
                    np.hstack([ids[some], more]), np.hstack([scores[some], best]), np.hstack([done[some], more < 0]), beam)
            rows, at = np.nonzero(~done & (np.cumsum(~done, axis=1) <= max(EXPANDED, beam // LINKS)))
            done[rows, at] = True
            met = links[ids[rows, at]].ravel().astype(np.int64)
            rows = np.repeat(rows, links.shape[1])
            there = met >= 0
            rows, met = rows[there], met[there]
            fresh = ~seen[rows, met]
            rows, met = rows[fresh], met[fresh]
        return ids, scores

    def nearest(self, queries):
        """The best point that a search finds for each query."""
        queries = queries.astype(np.float32)
        if not self.layers:
            return np.argmax(queries @ self.points.T, axis=1)
        n = len(self.points)
        return self._search(queries, self._entries(queries, n), self.layers[-1], n, BEAM)[0][:, 0]

    def near(self, queries, least, beam):
        """Rows of the queries and points with a score of ``least`` or more, as a search of this beam finds them.

        A beam that such points fill is widened, for its query alone, until one
        below ``least`` is in it. Without layers ``least`` may be a matrix.
        """
        queries = queries.astype(np.float32)
        if not self.layers:
            return held_by(queries @ self.points.T >= least)
        todo, found = np.arange(len(queries)), []
        while len(todo):
            some = queries[todo]
            ids, scores = self._search(some, self._entries(some, len(self.points)), self.layers[-1], len(self.points), beam)
            full = (scores[:, -1] >= least) & (beam < len(self.points))
            row, at = np.nonzero((scores >= least) & ~full[:, None])
            found.append((todo[row], ids[row, at]))
            todo, beam = todo[full], min(4 * beam, len(self.points))
        return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 2

    def dumped(self, **more):
        """Bytes that ``loaded`` reads, with more arrays."""
        held = io.BytesIO()
        np.savez(held, points=self.points, **{f"layer{i:02}": x for i, x in enumerate(self.layers)}, **more)
        return held.getvalue()

    @classmethod
    def loaded(cls, data):
        with np.load(io.BytesIO(data)) as held:
            layers = [held[k] for k in sorted(held.files) if k.startswith("layer")]
            return cls(held["points"], layers), {k: held[k] for k in held.files if not k.startswith(("layer", "points"))}
