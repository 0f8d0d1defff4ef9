"""Balanced parentheses of an ordered forest: findclose by range min-max blocks, ranks by cumulative counts."""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """``bits``: 1 opens a node, 0 closes it, in depth-first order. All operations take arrays of positions."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(np.int8)
        self.excess = np.cumsum(2 * self.bits.astype(np.int64) - 1)
        n = len(bits)
        self.opens = np.concatenate(([0], np.cumsum(self.bits, dtype=np.int64)))           # opens before a position
        pair = np.zeros(n, np.int64)
        pair[:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.pairs = np.concatenate(([0], np.cumsum(pair)))                                # leaf pairs "()" that open before a position
        blocks = max(1, -(-n // BLOCK))
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:n] = self.excess
        low = padded.reshape(blocks, BLOCK).min(axis=1)
        self.levels = [low]                                                                # least excess of 1, 2, 4, ... blocks
        while len(low) > 1:
            if len(low) % 2:
                low = np.append(low, np.iinfo(np.int64).max)
                self.levels[-1] = low
            low = low.reshape(-1, 2).min(axis=1)
            self.levels.append(low)

    def _scan(self, at: np.ndarray, goal: np.ndarray, found: np.ndarray, todo: np.ndarray) -> np.ndarray:
        """First position from ``at`` in the same block with excess <= goal; returns the entries of ``todo`` without one."""
        n, end = len(self.excess), (at // BLOCK + 1) * BLOCK
        at, open_ = at.copy(), np.ones(len(at), bool)
        for _ in range(BLOCK):
            live = np.flatnonzero(open_ & (at < np.minimum(end, n)))
            if not len(live):
                break
            hit = self.excess[at[live]] <= goal[live]
            found[todo[live[hit]]] = at[live[hit]]
            open_[live[hit]] = False
            at[live] += 1
        return np.flatnonzero(open_)

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Position of the parenthesis that closes each open one: the first later place with one excess less."""
        goal, found = self.excess[opens] - 1, np.full(len(opens), -1, np.int64)
        todo = self._scan(opens + 1, goal, found, np.arange(len(opens)))
        # an open one at the end of its block was scanned in the next block, so the search goes on from there
        block, level = (opens[todo] + 1) // BLOCK, np.zeros(len(todo), np.int64)
        goal, up = goal[todo], np.ones(len(todo), bool)
        for k, low in enumerate(self.levels):
            live = np.flatnonzero(up)
            right = block[live] ^ 1
            ok = (block[live] % 2 == 0) & (right < len(low))
            ok[ok] = low[right[ok]] <= goal[live[ok]]
            block[live[ok]], level[live[ok]], up[live[ok]] = right[ok], k, False
            block[live[~ok]] >>= 1
        for k in range(len(self.levels) - 1, 0, -1):
            live = np.flatnonzero(level == k)
            left = 2 * block[live]
            block[live] = left + (self.levels[k - 1][left] > goal[live])
            level[live] = k - 1
        self._scan(block * BLOCK, goal, found, todo)
        return found


def forest(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, nodes in the order they open) of the forest with these parents (-1: a root)."""
    n = len(parent)
    order = np.argsort(parent, kind="stable")
    first = np.searchsorted(parent[order], np.arange(-1, n + 1))     # children of v: order[first[v + 1]:first[v + 2]]
    bits, opened = np.zeros(2 * n, np.int8), np.empty(n, np.int64)
    order_, first_ = order.tolist(), first.tolist()
    stack, at, k = order_[first_[0]:first_[1]][::-1], 0, 0
    while stack:
        v = stack.pop()
        if v >= 0:
            bits[at], opened[k], k = 1, v, k + 1
            stack.append(-1)
            stack.extend(order_[first_[v + 1]:first_[v + 2]][::-1])
        at += 1
    return bits, opened
