"""Tricube-weighted sums over ranges of sorted rows, from moments of dyadic nodes.

Within a window of half-width h the tricube weight of a row at distance u * h to
one side is the polynomial 1 - 3|u|^3 + 3|u|^6 - |u|^9.  So the sums that a
local line needs follow from the moments up to degree 11 of the rows, and those
of a node (a run of rows) can be moved to any centre.  A range of rows is a few
nodes for each level of a binary tree.  Moments are taken about a node's own
centre and in units of its own radius, and a node lies within the window it is
used for, so no term exceeds its weight and nothing cancels.
"""

import numpy as np

DEGREE = 11
#: Windows that are summed together: their arrays stay in the cache, and memory is not mapped anew for each.
WINDOWS = 1 << 11
#: Sums of a local line: weights, with t and t * t, with y, with t * y; t in units of h. Then the weights before tricube.
SUMS = ("w", "t", "tt", "y", "ty", "before")


def _move(moments, delta, ratio):
    """Moments about another centre: each row's place tau becomes delta + ratio * tau."""
    out = [moments[0].copy()]
    scale = ratio
    for m in moments[1:]:
        out.append(m * scale)
        scale = scale * ratio
    for first in range(1, len(out)):
        for j in range(len(out) - 1, first - 1, -1):
            out[j] += delta * out[j - 1]
    return out


def _taylor(d, r):
    """The coefficients of (1 - (d + r * tau)^3)^3 by powers of tau."""
    square = d * d
    cube = square * d
    rest = 1 - cube
    out = [
        rest * rest * rest, -9 * square * rest * rest, -9 * d * rest * (1 - 4 * cube), (60 - 84 * cube) * cube - 3,
        square * (45 - 126 * cube), d * (18 - 126 * cube), 3 - 84 * cube, -36 * square, -9 * d,
    ]
    power = r
    for k in range(1, len(out)):
        out[k] *= power
        power = power * r
    return [*out, -power]


class Nodes:
    """Runs of rows: their ends, and moments of the weights and of the weighted y."""

    def __init__(self, low, high, weights, values):
        self.low, self.high = low, high
        self.centre = low + (high - low) / 2
        self.radius = (high - low) / 2
        self.weights, self.values = weights, values

    @classmethod
    def of_rows(cls, x, w, wy):
        """One node per row."""
        zero = np.zeros(len(x))
        return cls(x, x, [w, *[zero] * DEGREE], [wy, *[zero] * (DEGREE - 1)])

    def __len__(self):
        return len(self.low)

    def _at(self, pick):
        return Nodes(self.low[pick], self.high[pick], [m[pick] for m in self.weights], [m[pick] for m in self.values])

    def _about(self, centre, radius):
        """The moments of weights and values about other centres."""
        some = np.where(radius > 0, radius, 1)
        delta, ratio = (self.centre - centre) / some, self.radius / some
        return _move(self.weights, delta, ratio), _move(self.values, delta, ratio)

    def pairs(self):
        """Half as many nodes: neighbours merged, an odd last one as it is."""
        n = len(self) // 2 * 2
        left, right = self._at(slice(0, n, 2)), self._at(slice(1, n, 2))
        merged = Nodes(left.low, right.high, None, None)
        sides = [side._about(merged.centre, merged.radius) for side in (left, right)]
        merged.weights, merged.values = ([a + b for a, b in zip(*both)] for both in zip(*sides))
        if n == len(self):
            return merged
        return merged.joined(self._at(slice(n, None)))

    def joined(self, other):
        both = lambda a, b: [np.concatenate(pair) for pair in zip(a, b)]
        return Nodes(
            *both((self.low, self.high), (other.low, other.high)),
            both(self.weights, other.weights),
            both(self.values, other.values),
        )

    def tricube(self, x0, h, side):
        """SUMS of each node for a window about x0; ``side`` is -1 left of x0, 1 right of it.

        The weight of a row at ``tau`` is a polynomial in it, whose coefficients follow from the
        node's centre and radius in units of h, so no moments are moved.
        """
        some = np.where(h > 0, h, 1)
        delta, ratio = (self.centre - x0) / some, self.radius / some
        weights, values = self.weights, self.values
        if not self.radius.any():
            w = (1 - np.abs(delta) ** 3) ** 3
            y, w = w * values[0], w * weights[0]
            return np.stack([w, delta * w, delta * delta * w, y, delta * y, weights[0]])
        factors = _taylor(side * delta, side * ratio)
        w, w1, w2 = (sum(f * m for f, m in zip(factors, weights[k:])) for k in range(3))
        y, y1 = (sum(f * m for f, m in zip(factors, values[k:])) for k in range(2))
        t = delta * w + ratio * w1
        tt = delta * t + ratio * (delta * w1 + ratio * w2)
        return np.stack([w, t, tt, y, delta * y + ratio * y1, weights[0]])


class Tree:
    """Levels of nodes over sorted rows, from single ones to all."""

    def __init__(self, nodes):
        self.levels = [nodes]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].pairs())

    def root(self):
        return self.levels[-1]

    def sums(self, first, last, x0, h, side):
        """SUMS over the rows from ``first`` up to but not with ``last`` for each window."""
        total = np.zeros((len(SUMS), len(x0)))
        for at in range(0, len(x0), WINDOWS):
            few = slice(at, at + WINDOWS)
            self._add(total[:, few], first[few].copy(), np.maximum(first[few], last[few]), x0[few], h[few], side)
        return total

    def _add(self, total, first, last, x0, h, side):
        for nodes in self.levels:
            for ends, step in ((first, 0), (last, -1)):
                use = np.flatnonzero((first < last) & (ends % 2 == 1))
                if len(use):
                    total[:, use] += nodes._at(ends[use] + step).tricube(x0[use], h[use], side)
                    ends[use] += 1 + 2 * step
            first //= 2
            last //= 2
            if not (first < last).any():
                return
