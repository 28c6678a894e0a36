"""A tree as balanced parentheses, with blocks of range minima over the excess.

Nodes in preorder are the opening parentheses; the excess after a position is how many are still open. A subtree ends
where the excess first falls below that after its opening, which is looked for in the rest of the block, then in a tree
of minima over the blocks, and then in one block.
"""

from __future__ import annotations

import numpy as np

#: Positions per block.
BLOCK = 64
#: Nodes that look for their end at a time.
STEP = 1 << 14


class Parens:
    def __init__(self, opens: np.ndarray) -> None:
        """``opens``: True for each opening, False for each closing parenthesis, balanced."""
        self.opens = opens
        n_blocks = max(1, -(-len(opens) // BLOCK))
        excess = np.full(n_blocks * BLOCK, np.iinfo(np.int32).min, np.int32)  # what lies beyond the end is below all
        excess[:len(opens)] = np.cumsum(np.where(opens, 1, -1))
        self.excess = excess.reshape(n_blocks, BLOCK)
        self.levels = [self.excess.min(axis=1)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            below = np.append(below, below[-1:]) if len(below) % 2 else below
            self.levels.append(np.minimum(below[::2], below[1::2]))
        self.starts = np.flatnonzero(opens)

    def _first_below(self, block: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first block from ``block`` on whose minimum is below ``bound``; there is one for each."""
        at, level = block.copy(), np.zeros(len(block), np.int64)
        out = np.full(len(block), -1, np.int64)
        rising = np.ones(len(block), bool)
        while (out < 0).any():
            for height, minima in enumerate(self.levels):
                here = np.flatnonzero((level == height) & (out < 0))
                if not len(here):
                    continue
                hit = (at[here] < len(minima)) & (minima[np.minimum(at[here], len(minima) - 1)] < bound[here])
                found, other = here[hit], here[~hit]
                rising[found] = False
                if height:
                    at[found], level[found] = 2 * at[found], height - 1
                else:
                    out[found] = at[found]
                up = rising[other] & (at[other] % 2 == 1)  # the next subtree belongs to a higher one
                at[other] += 1
                at[other[up]] >>= 1
                level[other[up]] += 1
        return out

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        out = np.empty(len(places), np.int64)
        for first in range(0, len(places), STEP):
            p = places[first:first + STEP]
            block, inside = p // BLOCK, p % BLOCK
            bound = self.excess[block, inside]
            below = (self.excess[block] < bound[:, None]) & (np.arange(BLOCK) > inside[:, None])
            far = np.flatnonzero(~below.any(axis=1))
            if len(far):
                block[far] = self._first_below(block[far] + 1, bound[far])
                below[far] = self.excess[block[far]] < bound[far, None]
            out[first:first + STEP] = block * BLOCK + below.argmax(axis=1)
        return out

    def sizes(self) -> np.ndarray:
        """The number of nodes in the subtree of each node, in preorder."""
        return (self.find_close(self.starts) - self.starts + 1) // 2

    def leaves(self, sizes: np.ndarray) -> np.ndarray:
        """The number of childless nodes in each subtree: openings that are closed at once, by rank."""
        pair = np.zeros(len(self.opens) + 1, np.int64)
        np.cumsum(self.opens[:-1] & ~self.opens[1:], out=pair[1:-1])
        pair[-1] = pair[-2]
        return pair[self.starts + 2 * sizes - 1] - pair[self.starts]
