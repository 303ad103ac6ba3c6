"""Metric trees over whole-number points, by the anchors hierarchy, in numpy.

A node is a ball: a centre, a radius, and the cached count and sum of its points.
A set of points is first dealt over about the square root of their number of
anchors: the point farthest from its anchor becomes the next one and takes the
points that lie nearer to it.  From these balls in the middle the tree grows up, by
joining the two balls with the smallest common ball, and down, by the same procedure
within each anchor.

To assign all points to the nearest of some entries, balls come down the tree with a
list of the entries that may own some of their points.  An entry that another one
beats on the whole ball leaves the list, and the children inherit what is left.  A
ball with one entry left goes to it whole, by its count and sum.
"""

from __future__ import annotations

import io

import numpy as np

LEAF = 16  # points
EXACT = 2.0**51  # whole numbers below this are exact in all sums and products here


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows, in doubles where these are exact."""
    most = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4.0 * float(most) ** 2 * points.shape[1] < EXACT:
        return squared_doubles(points.astype(np.float64), entries.astype(np.float64))
    out = np.empty((len(points), len(entries)), np.int64)
    for j, entry in enumerate(entries):
        out[:, j] = np.square(points - entry).sum(axis=1)
    return out


def squared_doubles(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    out = points @ (-2 * entries.T)
    out += np.square(points).sum(axis=1)[:, None]
    out += np.square(entries).sum(axis=1)
    return out


def spread(points: np.ndarray) -> list[np.ndarray]:
    """Places of the points of each anchor."""
    most = int(np.ceil(np.sqrt(len(points))))
    anchors = [0]
    owner = np.zeros(len(points), np.int64)
    distance = np.sqrt(np.square(points - points[0]).sum(axis=1))
    while len(anchors) < most:
        new = int(np.argmax(distance))  # of the widest ball, its farthest point
        if distance[new] == 0:
            break
        between = np.sqrt(np.square(points[anchors] - points[new]).sum(axis=1))
        near = np.flatnonzero(2 * distance > between[owner])  # others cannot lie nearer to it
        own = np.sqrt(np.square(points[near] - points[new]).sum(axis=1))
        taken = own < distance[near]
        owner[near[taken]], distance[near[taken]] = len(anchors), own[taken]
        anchors.append(new)
    order = np.argsort(owner, kind="stable")
    return [p for p in np.split(order, np.searchsorted(owner[order], np.arange(1, len(anchors)))) if len(p)]


def joined(centres: np.ndarray, radii: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls to join, each into the next number, until one is left."""
    n = len(centres)
    centre = np.concatenate([centres, np.zeros((n - 1, centres.shape[1]))])
    radius, count = np.append(radii, np.zeros(n - 1)), np.append(counts, np.zeros(n - 1))
    common = np.full((2 * n - 1, 2 * n - 1), np.inf)

    def widths(i: int, others: np.ndarray) -> np.ndarray:
        between = np.sqrt(np.square(centre[others] - centre[i]).sum(axis=1))
        both = (between + radius[others] + radius[i]) / 2
        return np.maximum(both, np.maximum(radius[others], radius[i]))

    for i in range(1, n):
        common[i, :i] = widths(i, np.arange(i))
    live, pairs = np.arange(2 * n - 1) < n, []
    for new in range(n, 2 * n - 1):
        i, j = np.unravel_index(np.argmin(common[:new, :new]), (new, new))
        pairs.append((int(i), int(j)))
        radius[new], count[new] = common[i, j], count[i] + count[j]
        centre[new] = (centre[i] * count[i] + centre[j] * count[j]) / count[new]
        live[[i, j]] = False
        common[[i, j], :] = common[:, [i, j]] = np.inf
        others = np.flatnonzero(live[:new])
        common[new, others] = widths(new, others)
        live[new] = True
    return pairs


class Tree:
    """``points`` in tree order and their ``place`` in the order given; each node has
    the points from ``first`` to ``last`` and two children, or -1."""

    FIELDS = ("points", "place", "first", "last", "left", "right", "centre", "radius", "total")

    def __init__(self, **fields: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, fields[name])

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        doubles = points.astype(np.float64)
        order: list[np.ndarray] = []
        nodes: list[list[int]] = []  # first, last, left, right; children come before their parent
        done = 0

        def leaf(places: np.ndarray) -> int:
            nonlocal done
            order.append(places)
            nodes.append([done, done + len(places), -1, -1])
            done += len(places)
            return len(nodes) - 1

        def grow(places: np.ndarray) -> int:
            mine = doubles[places]
            if len(places) <= LEAF or (mine == mine[0]).all():
                return leaf(places)
            groups = spread(mine)
            centres = np.array([mine[g].mean(axis=0) for g in groups])
            radii = np.array(
                [np.sqrt(np.square(mine[g] - c).sum(axis=1).max()) for g, c in zip(groups, centres, strict=True)]
            )
            pairs = joined(centres, radii, np.array([len(g) for g in groups], float))
            n = len(groups)

            def emit(ball: int) -> int:
                if ball < n:
                    return grow(places[groups[ball]])
                left, right = map(emit, pairs[ball - n])
                nodes.append([nodes[left][0], nodes[right][1], left, right])
                return len(nodes) - 1

            return emit(2 * n - 2)

        grow(np.arange(len(points)))
        place = np.concatenate(order)
        first, last, left, right = np.array(nodes, np.int64).T
        ordered = points[place]
        before = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(ordered, axis=0, dtype=np.int64)])
        total = before[last] - before[first]
        centre = total / (last - first)[:, None]
        radius = np.array(
            [
                np.sqrt(np.square(ordered[a:b] - c).sum(axis=1).max())
                for a, b, c in zip(first.tolist(), last.tolist(), centre, strict=True)
            ]
        )
        return cls(
            points=ordered, place=place.astype(np.int32), first=first, last=last, left=left, right=right,
            centre=centre, radius=radius, total=total,
        )

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw)) as held:
            return cls(**{name: held[name] for name in cls.FIELDS})

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of each point in tree order (ties to the lower one), and
        the count and sum of the points of each entry."""
        n, width = entries.shape
        codes = np.zeros(len(self.points), np.int64)
        counts, sums = np.zeros(n, np.int64), np.zeros((n, width), np.int64)
        doubles = entries.astype(np.float64)
        apart = np.sqrt(np.maximum(squared_doubles(doubles, doubles), 0))
        apart *= 1 + 1e-9
        largest = max(float(np.abs(self.points).max()), float(np.abs(doubles).max()))
        slack = 1e-10 * (1.0 + width * largest**2)  # far above the rounding of doubles
        apart += np.sqrt(slack)
        _, once = np.unique(entries, axis=0, return_index=True)
        listed = np.zeros((1, n), bool)
        listed[0, once] = True  # of equal entries only the first can own a point
        balls = np.array([len(self.first) - 1])
        loose = []  # leaves that no entry owns whole, with what is left of their list
        while len(balls):
            distance = squared_doubles(self.centre[balls], doubles)
            distance[~listed] = np.inf
            best = distance.argmin(axis=1)
            gap = distance - distance[np.arange(len(balls)), best][:, None]
            # how far the gap between two entries can change within the ball
            change = 2 * (self.radius[balls][:, None] * (1 + 1e-9)) * apart[best] + slack
            listed &= (gap <= change) | (np.arange(n) == best[:, None])
            whole = listed.sum(axis=1) == 1
            for ball, entry in zip(balls[whole].tolist(), best[whole].tolist(), strict=True):
                codes[self.first[ball] : self.last[ball]] = entry
                counts[entry] += self.last[ball] - self.first[ball]
                sums[entry] += self.total[ball]
            balls, listed = balls[~whole], listed[~whole]
            inner = self.left[balls] >= 0
            loose += zip(balls[~inner].tolist(), listed[~inner], strict=True)
            balls = np.concatenate([self.left[balls[inner]], self.right[balls[inner]]])
            listed = np.concatenate([listed[inner], listed[inner]])
        for ball, left in loose:
            a, b = self.first[ball], self.last[ball]
            mine, some = self.points[a:b], np.flatnonzero(left)
            if self.radius[ball] == 0:  # equal points, of any number
                mine = mine[:1]
            own = some[squared(mine, entries[some]).argmin(axis=1)]
            codes[a:b] = own
            if self.radius[ball] == 0:
                counts[own[0]] += b - a
                sums[own[0]] += self.total[ball]
            else:
                np.add.at(counts, own, 1)
                np.add.at(sums, own, mine)
        return codes, counts, sums
