"""A quadtree with two halves per axis over a sparse matrix of counts, and its joint walk.

A tile has ``ROWS`` rows and ``COLUMNS`` columns in ``SIDE`` by ``SIDE`` leaves. Every
level holds four bits per node that is not empty, one per quadrant; the quadrant's
node on the next level is the number of set bits up to its own. Leaves hold the
prices of their entries.

A row's price of a count c is ``1 + SCALE * (c + PRIOR) // D`` with the row's own D, so
all zeros of a row have one price, and a quadrant that is empty for two groups of
rows costs its width times the difference of two numbers.
"""

from dataclasses import dataclass

import numpy as np

SIDE = 32
DEPTH = 5  # SIDE is 2 to this power
LEAF_ROWS, LEAF_COLUMNS = 4, 64
ROWS, COLUMNS = SIDE * LEAF_ROWS, SIDE * LEAF_COLUMNS
SCALE_STEP, SCALE_STEPS = 1000, 3
PRIOR = 5
# Leaf pairs compared at once.
CHUNK = 256


def prices(counts: np.ndarray, divisor: np.ndarray) -> np.ndarray:
    """``1 + 10**9 * (counts + PRIOR) // divisor`` without leaving 64 bits: long division,
    three decimal digits at a time. A divisor of 0 gives 0."""
    safe = np.maximum(divisor, 1)
    whole, rest = np.divmod(counts + PRIOR, safe)
    for _ in range(SCALE_STEPS):
        digits, rest = np.divmod(rest * SCALE_STEP, safe)
        whole = whole * SCALE_STEP + digits
    return np.where(divisor > 0, whole + 1, 0)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of x with a gap behind each."""
    out = np.zeros_like(x)
    for bit in range(DEPTH):
        out |= ((x >> bit) & 1) << (2 * bit)
    return out


@dataclass
class Tree:
    """A tile: bits and their ranks by level, prices of the leaves that are not empty, zero prices of the rows."""

    bits: list[np.ndarray]
    ranks: list[np.ndarray]
    leaves: np.ndarray  # leaf, row, column
    zero: np.ndarray  # price of a zero, by row

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The nodes of quadrants on the next level, -1 where they are empty."""
        at = 4 * node + quadrant
        here = (node >= 0) & self.bits[level][np.maximum(at, 0)]
        return np.where(here, self.ranks[level][np.maximum(at, 0)] - 1, -1)


def build(row: np.ndarray, column: np.ndarray, count: np.ndarray, divisor: np.ndarray) -> Tree:
    """The tree of a tile's entries; ``divisor`` is D of each of the ``ROWS`` rows, 0 for rows that are not there."""
    zero = prices(np.zeros(ROWS, np.int64), divisor)
    # Row bit before column bit: the quadrants of a node are 2 * lower half + right half.
    code = (_spread(row // LEAF_ROWS) << 1) | _spread(column // LEAF_COLUMNS)
    named, leaf = np.unique(code, return_inverse=True)
    bits, ranks = [], []
    for level in range(DEPTH):
        nodes = np.unique(named >> (2 * (DEPTH - level)))
        children = np.unique(named >> (2 * (DEPTH - level - 1)))
        flags = np.zeros(4 * max(len(nodes), 1), dtype=bool)
        flags[4 * np.searchsorted(nodes, children >> 2) + (children & 3)] = True
        bits.append(flags)
        ranks.append(np.cumsum(flags))
    leaf_row = np.zeros(len(named), dtype=np.int64)
    for bit in range(DEPTH):
        leaf_row |= ((named >> (2 * bit + 1)) & 1) << bit
    by_leaf = zero.reshape(SIDE, LEAF_ROWS)[leaf_row]
    leaves = np.repeat(by_leaf[:, :, None], LEAF_COLUMNS, axis=2)
    leaves[leaf, row % LEAF_ROWS, column % LEAF_COLUMNS] = prices(count, divisor[row])
    return Tree(bits, ranks, leaves, zero)


def distances(one: Tree, two: Tree, width: int) -> np.ndarray:
    """For every row of one tile and every row of the other, over the first ``width`` columns
    (``COLUMNS`` at most): the sum of the absolute differences of their prices."""
    # Columns by which a pair of leaf rows is priced as empty, per level and below.
    empty = np.zeros((SIDE, SIDE), dtype=np.int64)
    sums = np.zeros((SIDE, SIDE, LEAF_ROWS, LEAF_ROWS), dtype=np.int64)
    x = np.zeros(1, np.int64) if len(one.leaves) else np.full(1, -1)
    y = np.zeros(1, np.int64) if len(two.leaves) else np.full(1, -1)
    i = j = c = np.zeros(1, np.int64)
    for level in range(DEPTH + 1):
        span = SIDE >> level
        # Quadrants beyond the width have no columns left.
        columns = np.clip(width - c * span * LEAF_COLUMNS, 0, span * LEAF_COLUMNS)
        none = (x < 0) & (y < 0)
        if none.any():
            coarse = np.zeros((1 << level, 1 << level), dtype=np.int64)
            np.add.at(coarse, (i[none], j[none]), columns[none])
            empty += np.kron(coarse, np.ones((span, span), dtype=np.int64))
        go = ~none & (columns > 0)
        x, y, i, j, c = x[go], y[go], i[go], j[go], c[go]
        if level == DEPTH or not len(x):
            break
        a, b, k = (np.tile(np.array(v), len(x)) for v in ([0, 0, 0, 0, 1, 1, 1, 1], [0, 0, 1, 1] * 2, [0, 1] * 4))
        x, y, i, j, c = (np.repeat(v, 8) for v in (x, y, i, j, c))
        x, y = one.child(level, x, 2 * a + k), two.child(level, y, 2 * b + k)
        i, j, c = 2 * i + a, 2 * j + b, 2 * c + k
    place = np.arange(LEAF_COLUMNS)
    for at in range(0, len(x), CHUNK):
        part = slice(at, at + CHUNK)
        inside = place[None, None, :] < (width - c[part] * LEAF_COLUMNS)[:, None, None]
        sides = []
        for tree, node, rows in ((one, x[part], i[part]), (two, y[part], j[part])):
            flat = np.repeat(tree.zero.reshape(SIDE, LEAF_ROWS)[rows][:, :, None], LEAF_COLUMNS, axis=2)
            full = node >= 0
            flat[full] = tree.leaves[node[full]]
            sides.append(np.where(inside, flat, 0))
        found = np.abs(sides[0][:, :, None, :] - sides[1][:, None, :, :]).sum(axis=3)
        np.add.at(sums, (i[part], j[part]), found)
    total = sums.transpose(0, 2, 1, 3).reshape(ROWS, ROWS)
    wide = np.repeat(np.repeat(empty, LEAF_ROWS, axis=0), LEAF_ROWS, axis=1)
    return total + wide * np.abs(one.zero[:, None] - two.zero[None, :])
