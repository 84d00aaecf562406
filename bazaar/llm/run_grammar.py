"""Run-length grammar of a sequence by recompression, with extension queries.

Two steps alternate: block compression names every maximal block of equal symbols
by (symbol, length); pair compression splits the alphabet in two by a hash of the
symbol and names all pairs of a left symbol and a right one, which never overlap.
Of a few splits the one with most pairs is taken.  Equal stretches get equal names
but for a few symbols at their ends, so a query climbs to long equal symbols, walks
over them and goes down again where they differ.

All levels lie in one set of arrays; a symbol is its index there.  A query pair is
always on one level.  Within a block both sides move on by the shorter rest at once.
The result is exact at any height: a difference counts on the lowest level only.
"""

from __future__ import annotations

import numpy as np

from .words import mix

SPLITS = 4


class RunGrammar:
    """``base``: non-negative ids; ``wall``: True at symbols that occur once, which
    stand at both ends and wherever extensions must end."""

    def __init__(self, base: np.ndarray, wall: np.ndarray):
        self.n = len(base)
        #: by direction: whether the symbol is its parent's end child, that end of its
        #: children, how many symbols of its block lie ahead (itself included)
        symbol, parent, levels = [], [], []
        name, at = base.astype(np.int64), 0
        walls = int(wall.sum())
        seed = 0
        while True:
            block = np.ones(len(name), bool)
            block[1:] = name[1:] != name[:-1]
            if not block.all():
                head = block
                first = np.flatnonzero(head)
                last = np.append(first[1:], len(name)) - 1
                group = np.cumsum(head) - 1
                place = np.arange(len(name))
                rest, done = last[group] - place + 1, place - first[group] + 1
                key = name[first] * np.int64(len(name) + 1) + (last - first + 1)
            else:
                take = self._pairs(name, wall, seed)
                seed += SPLITS
                if len(name) <= 2 * walls or not take.any():
                    break
                head = ~take
                first = np.flatnonzero(head)
                two = np.append(take[1:], False)[first]
                last = first + two
                group = np.cumsum(head) - 1
                rest = done = np.ones(len(name), np.int64)
                key = name[first] * np.int64(len(name) + 1) + np.where(two, name[np.minimum(last, len(name) - 1)] + 1, 0)
            symbol.append(name)
            up = at + len(name)
            parent.append(group + up)
            levels.append((at + first, at + last, head, np.append(head[1:], True), rest, done))
            _, name = np.unique(key, return_inverse=True)
            name = name.astype(np.int64)
            wall, at = wall[first], up
        ones = np.ones(len(name), np.int64)
        symbol.append(name)
        parent.append(np.full(len(name), -1, np.int64))
        edge = np.zeros(len(name), bool)
        down = [np.full(self.n, -1, np.int64)] * 2
        self.symbol, self.parent = np.concatenate(symbol), np.concatenate(parent)
        self.child = [np.concatenate([down[0], *[x[0] for x in levels]]), np.concatenate([down[1], *[x[1] for x in levels]])]
        self.edge = [np.concatenate([*[x[2] for x in levels], edge]), np.concatenate([*[x[3] for x in levels], edge])]
        self.ahead = [np.concatenate([*[x[4] for x in levels], ones]), np.concatenate([*[x[5] for x in levels], ones])]

    @staticmethod
    def _pairs(name: np.ndarray, wall: np.ndarray, seed: int) -> np.ndarray:
        """True at the second symbol of every pair of the best split."""
        best, most = np.zeros(len(name), bool), 0
        for k in range(seed, seed + SPLITS):
            side = (mix(name.astype(np.uint64) + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(1)).astype(bool)
            for left in (side, ~side):
                pair = (left & ~wall)[:-1] & (~left & ~wall)[1:]
                if (count := int(np.count_nonzero(pair))) > most:
                    best, most = np.append(False, pair), count
        return best

    def extend(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """For every pair of places a != b the number of equal symbols from them on,
        forwards or (``back``) backwards, both places included."""
        child, edge, ahead = self.child[back], self.edge[back], self.ahead[back]
        sign = -1 if back else 1
        x, y = a.astype(np.int64), b.astype(np.int64)
        out = np.zeros(len(x), np.int64)
        open_ = np.arange(len(x))
        while len(open_):
            equal = self.symbol[x] == self.symbol[y]
            above, beside = self.parent[x], self.parent[y]
            up = edge[x] & edge[y] & equal
            up[up] = self.symbol[above[up]] == self.symbol[beside[up]]
            on = equal & ~up
            step = sign * np.minimum(ahead[x], ahead[y])
            over = ~equal & (x < self.n)
            nx = np.where(up, above, np.where(on, x + step, child[x]))
            ny = np.where(up, beside, np.where(on, y + step, child[y]))
            if over.any():
                out[open_[over]] = sign * (x[over] - a[open_[over]])
                nx, ny, open_ = nx[~over], ny[~over], open_[~over]
            x, y = nx, ny
        return out
