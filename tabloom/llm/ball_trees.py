"""Metric trees by the anchors hierarchy, and nearest entries of a codebook for whole balls of them.

A tree is built middle-out: about the root of n anchors own the n points, each of them becomes a subtree in the same way, and the
subtrees are joined pair by pair, the pair with the smallest common ball first. Nodes cache the count and sum of their points.
"""

from __future__ import annotations

import io

import numpy as np

#: Points of a leaf.
LEAF = 48
#: Components up to this size, times the root of the width, have squared distances that doubles hold exactly; beyond it Python
#: integers are used.
EXACT = 1 << 22
#: Squared distances beyond this count as this.
LARGEST = (1 << 61) - 1


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points to integer entries: doubles, or Python integers where these are too short."""
    if not len(points) or max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) * int(np.sqrt(points.shape[1]) + 1) <= EXACT:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)
    p, e = points.astype(object), entries.astype(object)
    return np.array([((e - x) ** 2).sum(1) for x in p], object).reshape(len(p), len(e))


def _anchors(points: np.ndarray, wanted: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Indices owned by each anchor, and their distances to it, the farthest first.

    Every new anchor is the point farthest from the anchor with the largest radius. It takes points from the others, and an anchor's list
    is read only as far as a point can still be nearer to the new one: to half the distance of the two anchors.
    """
    pts = points.astype(np.float64)
    start = np.sqrt(((pts - pts[0]) ** 2).sum(1))
    order = np.argsort(-start, kind="stable")
    owned, far, pivots = [order], [start[order]], [0]
    while len(owned) < wanted:
        widest = max(range(len(far)), key=lambda a: far[a][0])
        if far[widest][0] == 0:
            break
        new = int(owned[widest][0])
        got, got_far = [], []
        for a in range(len(owned)):
            apart = np.sqrt(((pts[pivots[a]] - pts[new]) ** 2).sum())
            reach = int(np.searchsorted(-far[a], -apart / 2, side="right"))
            if not reach:
                continue
            some = owned[a][:reach]
            to_new = np.sqrt(((pts[some] - pts[new]) ** 2).sum(1))
            moves = to_new < far[a][:reach]
            if moves.any():
                got.append(some[moves])
                got_far.append(to_new[moves])
                stay = np.concatenate([~moves, np.ones(len(owned[a]) - reach, bool)])
                owned[a], far[a] = owned[a][stay], far[a][stay]
        mine, mine_far = np.concatenate(got), np.concatenate(got_far)
        order = np.argsort(-mine_far, kind="stable")
        owned.append(mine[order])
        far.append(mine_far[order])
        pivots.append(new)
    return owned, far


class BallTree:
    """Nodes as arrays: ball (``center``, ``radius``), cached ``count`` and ``total``, two children or a range of ``points``."""

    FIELDS = ("points", "order", "center", "radius", "count", "total", "left", "right", "start")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> BallTree:
        """A tree over integer points (rows); the last node is the root."""
        points = np.ascontiguousarray(points, np.int64)
        width = points.shape[1]
        nodes: list[tuple] = []
        order: list[np.ndarray] = []
        placed = 0

        def leaf_node(own: np.ndarray) -> int:
            nonlocal placed
            pts = points[own]
            center = pts.mean(0)
            radius = float(np.sqrt(((pts - center) ** 2).sum(1).max())) if (pts != pts[0]).any() else 0.0
            if radius == 0:
                center = pts[0].astype(np.float64)
            nodes.append((center, radius, len(own), pts.sum(0), -1, -1, placed))
            order.append(own)
            placed += len(own)
            return len(nodes) - 1

        def joined(heads: list[int]) -> int:
            """Middle-out: the two balls with the smallest common ball become one, until one is left."""
            heads = list(heads)
            c = np.array([nodes[h][0] for h in heads])
            r = np.array([nodes[h][1] for h in heads])
            size = np.sqrt(((c[:, None] - c) ** 2).sum(2)) + r[:, None] + r
            np.fill_diagonal(size, np.inf)
            for _ in range(len(heads) - 1):
                i, j = divmod(int(size.argmin()), len(heads))
                a, b = nodes[heads[i]], nodes[heads[j]]
                n = a[2] + b[2]
                center = (a[0] * a[2] + b[0] * b[2]) / n
                radius = max(float(np.sqrt(((center - x[0]) ** 2).sum())) + x[1] for x in (a, b))
                nodes.append((center, radius, n, a[3] + b[3], heads[i], heads[j], a[6]))
                heads[i], c[i], r[i] = len(nodes) - 1, center, radius
                size[j, :] = size[:, j] = np.inf
                r[j] = np.inf
                near = np.sqrt(((c - center) ** 2).sum(1)) + r + radius
                near[i] = np.inf
                size[i, :] = size[:, i] = near
            return len(nodes) - 1

        def grow(own: np.ndarray) -> int:
            if len(own) <= leaf:
                return leaf_node(own)
            parts, _ = _anchors(points[own], max(2, int(np.sqrt(len(own)))))
            if len(parts) == 1:
                return leaf_node(own)
            return joined([grow(own[p]) for p in parts])

        if len(points):
            grow(np.arange(len(points)))
        columns = list(zip(*nodes)) if nodes else [[] for _ in range(7)]
        at = np.concatenate(order) if order else np.empty(0, np.int64)
        return cls(points=points[at], order=at, center=np.array(columns[0], np.float64).reshape(-1, width), radius=np.array(columns[1], np.float64),
                   count=np.array(columns[2], np.int64), total=np.array(columns[3], np.int64).reshape(-1, width),
                   left=np.array(columns[4], np.int64), right=np.array(columns[5], np.int64), start=np.array(columns[6], np.int64))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        small = np.abs(self.points).max(initial=0) < 1 << 31
        np.savez(out, **{f: (a.astype(np.int32) if f in ("points", "order", "left", "right", "start") and (f != "points" or small) else a)
                         for f, a in ((f, getattr(self, f)) for f in self.FIELDS)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> BallTree:
        with np.load(io.BytesIO(raw)) as held:
            return cls(**{f: held[f].astype(np.int64) if held[f].dtype == np.int32 else held[f] for f in cls.FIELDS})

    def owners(self, entries: np.ndarray, collect: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry of every point, the lowest index of equally near ones.

        Candidates go down the tree. An entry leaves a ball's list when another one is nearer to all points of the ball: |p - e|^2 -
        |p - f|^2 is linear in p, so its least value over the ball is known from center and radius. Once one candidate is left,
        the ball is its own as a whole and count and sum are taken from the node.

        Returns counts and sums per entry, and with ``collect`` also entry and squared distance per point in input order.
        """
        width = self.points.shape[1]
        counts, sums = np.zeros(len(entries), np.int64), np.zeros((len(entries), width), np.int64)
        entry = np.empty(len(self.points) if collect else 0, np.int64)
        error = np.empty(len(entry), np.int64)
        if not len(self.points):
            return counts, sums, entry, error
        # equal entries: only the first can own anything
        distinct = np.sort(np.unique(entries, axis=0, return_index=True)[1])
        real = entries.astype(np.float64)
        stack = [(len(self.count) - 1, distinct)]
        while stack:
            node, held = stack.pop()
            if len(held) > 1:
                own = real[held]
                off = ((own - self.center[node]) ** 2).sum(1)
                best = int(off.argmin())
                reach = 2 * self.radius[node] * np.sqrt(((own - own[best]) ** 2).sum(1))
                # a margin above what rounding can make, so that ties stay
                keep = off - off[best] <= reach * (1 + 1e-9) + 1e-9 * (off + 1) + 1e-6
                keep[best] = True
                held = held[keep]
            whole = len(held) == 1
            if whole and not collect:
                counts[held[0]] += self.count[node]
                sums[held[0]] += self.total[node]
                continue
            if self.left[node] >= 0 and not whole:
                stack.append((int(self.left[node]), held))
                stack.append((int(self.right[node]), held))
                continue
            for at, pts in self._ranges(node):
                if self.radius[node] == 0:
                    far = distances(pts[:1], entries[held]).repeat(len(pts), axis=0)
                else:
                    far = distances(pts, entries[held])
                pick = far.argmin(1)
                own = held[pick]
                counts += np.bincount(own, minlength=len(entries))
                np.add.at(sums, own, pts)
                if collect:
                    entry[self.order[at : at + len(pts)]] = own
                    error[self.order[at : at + len(pts)]] = np.minimum(far[np.arange(len(pts)), pick], LARGEST).astype(np.int64) if far.dtype == object else far[np.arange(len(pts)), pick]
        return counts, sums, entry, error

    def _ranges(self, node: int):
        """(first place, points) of the leaves below a node."""
        todo = [node]
        while todo:
            n = todo.pop()
            if self.left[n] >= 0:
                todo += [int(self.left[n]), int(self.right[n])]
            else:
                yield int(self.start[n]), self.points[self.start[n] : self.start[n] + self.count[n]]
