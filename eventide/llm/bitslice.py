"""Bit-sliced index over blocks of whole-number vectors, in numpy.

A slice is a bitmap over the rows of a block: one bit of one attribute. The weighted
sum of the attributes is itself a set of slices, made by adding slices with the
bitwise full adder, so all rows of a block are scored at once.
"""

import numpy as np

WORD = 64


class Block:
    """Slices of the attributes of some rows; attributes count from their least value."""

    def __init__(self, n: int, low: np.ndarray, bits: np.ndarray, slices: np.ndarray):
        self.n, self.low, self.bits = n, low, bits
        self.first = np.concatenate([[0], np.cumsum(bits)])
        # Complements stand behind the slices, for weights below zero.
        self.both = np.concatenate([slices, ~slices])
        self.half = len(slices)

    @staticmethod
    def build(values: np.ndarray) -> "Block":
        """Index the rows of ``values`` (row x attribute)."""
        n, d = values.shape
        low = values.min(axis=0) if n else np.zeros(d, np.int64)
        above = (values - low).view(np.uint64)
        most = above.max(axis=0) if n else np.zeros(d, np.uint64)
        bits = np.array([int(m).bit_length() for m in most], dtype=np.int64)
        slices = np.zeros((int(bits.sum()), -(-n // WORD)), dtype=np.uint64)
        at = 0
        for k in range(d):
            for b in range(bits[k]):
                packed = np.packbits((above[:, k] >> np.uint64(b)) & np.uint64(1) != 0, bitorder="little")
                slices[at].view(np.uint8)[: len(packed)] = packed
                at += 1
        return Block(n, low, bits, slices)

    def scores(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the weighted sum, lowest first, and what to add to every row."""
        d = min(len(weights), len(self.bits))
        offset, by_place = 0, {}
        for k in range(d):
            w = int(weights[k])
            offset += w * int(self.low[k])
            bits = int(self.bits[k])
            if w == 0 or bits == 0:
                continue
            if w < 0:
                offset += w * ((1 << bits) - 1)
            base = int(self.first[k]) + (self.half if w < 0 else 0)
            for j in range(abs(w).bit_length()):
                if abs(w) >> j & 1:
                    for b in range(bits):
                        by_place.setdefault(j + b, []).append(base + b)
        out: list[np.ndarray] = []
        carry: list[np.ndarray] = []
        place, top = 0, max(by_place, default=-1)
        while place <= top or carry:
            parts = [self.both[by_place[place]]] if place in by_place else []
            rows = np.concatenate(parts + carry) if parts + carry else None
            carry = []
            if rows is None:
                out.append(np.zeros(self.both.shape[1], np.uint64))
            else:
                while len(rows) > 1:
                    if len(rows) == 2:
                        carry.append((rows[0] & rows[1])[None])
                        rows = (rows[0] ^ rows[1])[None]
                        break
                    third = len(rows) // 3
                    a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                    half = a ^ b
                    carry.append((a & b) | (half & c))
                    rows = np.concatenate([half ^ c, rows[3 * third :]])
                out.append(rows[0])
            place += 1
        return out, offset

    def top(self, weights: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
        """Rows of the ``k`` largest weighted sums and these sums.

        From the most significant slice downward: the open rows that have the bit are
        taken if they fit, else only they stay open. Rows open at the end are equal, and
        the first of them fill up.
        """
        slices, offset = self.scores(weights)
        words = self.both.shape[1]
        open_rows = np.full(words, ~np.uint64(0))
        if self.n % WORD:
            open_rows[-1] = np.uint64((1 << (self.n % WORD)) - 1)
        taken = np.zeros(words, np.uint64)
        n_taken = 0
        for s in reversed(slices):
            ones = open_rows & s
            n = int(np.bitwise_count(ones).sum())
            if n_taken + n > k:
                open_rows = ones
            else:
                taken |= ones
                n_taken += n
                open_rows = open_rows & ~s
                if n_taken == k:
                    break
        rows = _members(taken)
        if n_taken < k:
            rows = np.concatenate([rows, _members(open_rows)[: k - n_taken]])
        word, bit = rows // WORD, (rows % WORD).astype(np.uint64)
        sums = [offset] * len(rows)
        for place, s in enumerate(slices):
            ones = ((s[word] >> bit) & np.uint64(1)).tolist()
            sums = [x + (o << place) for x, o in zip(sums, ones, strict=True)]
        return rows, sums


def _members(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
