"""Induced suffix sorting of one shard with common-prefix values, queues on disk beyond a bound.

The shard is an integer string in which 0 ends each part (parts are compared up to their
end, equal parts in text order). Suffixes that start below their right neighbour (S) and above their left one
(left-most S, LMS) are sorted first: their substrings by induction, their names
recursively. From them one pass induces all other L suffixes in ascending order
and one all S suffixes in descending order. Both passes pop suffixes from a priority queue by
first symbol, a whole run at a time, and push the suffixes before them together with the
length of the common prefix with the entry pushed before, which is one more than the least
common prefix seen in between.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Iterator

import numpy as np

from sensorlake.llm.text import mix, powers

#: names of more symbols than this are ordered by rank doubling, not by another round of induction
MAX_SYMBOLS = 4096


class BucketQueue:
    """Priority queue of (suffixes, common prefixes) by first symbol, first in first out within one.

    Runs wait in memory up to ``limit`` entries and go to files in ``folder`` beyond that.
    """

    def __init__(self, symbols: int, limit: int = 1 << 22, folder: str | None = None):
        self.runs: list[deque] = [deque() for _ in range(symbols)]
        self.limit, self.folder, self.held = limit, folder, 0
        self.spilled = 0

    def push(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        if self.folder and self.held + len(at) > self.limit:
            from sensorlake.llm.token_store import open_file

            path = f"{self.folder}/run-{uuid.uuid4().hex}"
            with open_file(path, "w") as f:
                f.write(at.astype("<i8").tobytes())
                f.write(lcp.astype("<i8").tobytes())
            self.runs[symbol].append(path)
            self.spilled += 1
        else:
            self.runs[symbol].append((at, lcp))
            self.held += len(at)

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All runs that wait for ``symbol`` now, as one."""
        found = []
        while self.runs[symbol]:
            run = self.runs[symbol].popleft()
            if isinstance(run, str):
                found.append(self._read(run))
            else:
                self.held -= len(run[0])
                found.append(run)
        if not found:
            return None
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _read(self, path: str):
        from sensorlake.llm.token_store import open_file, remove_file

        with open_file(path, "r") as f:
            both = np.frombuffer(f.read(), "<i8")
        remove_file(path)
        return both[: len(both) // 2], both[len(both) // 2:]


class Shard:
    """The string, its suffix types and prefix hashes."""

    def __init__(self, t: np.ndarray, symbols: int):
        n = len(t)
        self.t, self.n, self.symbols = t, n, symbols
        after = np.append(t[1:], 0)
        differs = np.flatnonzero(np.append(t[:-1] != t[1:], True))
        nxt = differs[np.searchsorted(differs, np.arange(n))]
        self.is_s = (t[nxt] < after[nxt]) | (t == 0)
        self.run_end = nxt + 1
        self.lms = np.flatnonzero(self.is_s & np.concatenate(([False], ~self.is_s[:-1])))
        up, self.down = powers(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(t.astype(np.uint64) + np.uint64(7)) * up[:-1], out=self.prefix[1:])
        ends = np.flatnonzero(t == 0)
        self.end = ends[np.searchsorted(ends, np.arange(n))]  # the 0 that ends each position's part

    def hashes(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.prefix[at + size] - self.prefix[at]) * self.down[at]

    def common(self, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
        """Common prefix of the suffixes at ``a`` and ``b``, at most ``cap``, ends of parts not counted."""
        most = np.minimum(np.minimum(self.end[a] - a, self.end[b] - b), cap)
        out, step = np.zeros(len(a), np.int64), 1 << (cap.bit_length() - 1)
        while step:
            fits = np.flatnonzero(out + step <= most)
            x, y = a[fits] + out[fits], b[fits] + out[fits]
            same = self.hashes(x, step) == self.hashes(y, step)
            out[fits[same]] += step
            step >>= 1
        return out

    def _junction(self, a: int, b: int) -> int:
        """Common prefix of an L and an S suffix of the same first symbol: the shorter of their runs of it."""
        return int(min(self.run_end[a] - a, self.run_end[b] - b))

    def induce(self, lms: np.ndarray, lcp: np.ndarray, cap: int, folder: str | None, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes but the ends of parts, in descending order, in runs, with the common prefix with the one before (capped)."""
        t, sorted_l = self.t, BucketQueue(self.symbols, limit, folder)
        first = t[lms]
        edge = np.searchsorted(first, np.arange(self.symbols + 1))
        queue, least = BucketQueue(self.symbols, limit, folder), np.zeros(self.symbols, np.int64)

        def push_before(at: np.ndarray, lcp: np.ndarray, s_type: bool) -> None:
            p = at - 1
            ok = np.flatnonzero((p >= 0) & (self.is_s[p] == s_type) & (t[p] != 0))
            symbols = t[p[ok]]
            kept = least.copy()
            np.minimum(least, lcp.min(), out=least)
            by = np.argsort(symbols, kind="stable")
            cut = np.flatnonzero(np.diff(symbols[by])) + 1
            for group in np.split(ok[by], cut) if len(ok) else ():
                q = int(t[p[group[0]]])
                low = np.minimum.reduceat(lcp[: group[-1] + 1], np.concatenate(([0], group[:-1] + 1)))
                low[0] = min(low[0], kept[q])
                least[q] = lcp[group[-1] + 1:].min() if group[-1] + 1 < len(lcp) else cap
                queue.push(q, p[group], np.minimum(low + 1, cap))

        # ascending: L suffixes of each symbol, then its LMS suffixes
        for c in range(self.symbols):
            last = None
            while (run := queue.pop(c)) is not None:
                at, low = run
                if last is None:
                    low = np.concatenate(([0], low[1:]))
                last = int(at[-1])
                push_before(at, low, False)
                sorted_l.push(c, at, low)
            lo, hi = int(edge[c]), int(edge[c + 1])
            if lo < hi:
                low = lcp[lo:hi].copy()
                low[0] = min(cap, self._junction(last, int(lms[lo]))) if last is not None else 0
                push_before(lms[lo:hi], low, False)
        # descending: S suffixes of each symbol, then its L suffixes
        least[:] = 0
        for c in range(self.symbols - 1, 0, -1):
            last = None
            while (run := queue.pop(c)) is not None:
                at, low = run
                if last is None:
                    low = np.concatenate(([0], low[1:]))
                last = int(at[-1])
                push_before(at, low, True)
                yield at, low
            run = sorted_l.pop(c)
            if run is not None:
                at, low = run[0][::-1], np.concatenate(([0], run[1][:0:-1]))
                if last is not None:
                    low[0] = min(cap, self._junction(int(at[0]), last))
                push_before(at, low, True)
                yield at, low

    def sorted_lms(self, folder: str | None, limit: int) -> np.ndarray:
        """LMS suffixes in ascending order."""
        t, lms = self.t, self.lms
        ends = lms[t[lms] == 0]
        loose = lms[np.argsort(t[lms], kind="stable")]
        is_lms = np.zeros(self.n + 1, bool)
        is_lms[lms] = True
        found = [at[is_lms[at]] for at, _ in self.induce(loose, np.zeros(len(loose), np.int64), 0, folder, limit)]
        by_substring = np.concatenate([ends, *[x[::-1] for x in found[::-1]]])
        # equal neighbours share a name; the ends of parts are all different
        order = np.searchsorted(lms, by_substring)
        size = np.append(np.diff(lms) + 1, 1)[order]
        size[: len(ends)] = 1
        h = self.hashes(by_substring, np.minimum(size, self.n - by_substring))
        new = (size[1:] != size[:-1]) | (h[1:] != h[:-1])
        new[: len(ends)] = True
        names = np.concatenate(([0], np.cumsum(new)))
        if names[-1] + 1 == len(lms):
            return by_substring
        reduced = np.empty(len(lms), np.int64)
        reduced[order] = names
        symbols = int(names[-1]) - len(ends) + 2
        if symbols <= MAX_SYMBOLS and len(lms) > 64 * symbols:
            inner = Shard(np.maximum(reduced - len(ends) + 1, 0), symbols)
            ranked = suffixes(inner, folder, limit)
        else:
            ranked = doubled(reduced)
        return lms[ranked]


def doubled(rank: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names by rank doubling; only suffixes still tied are sorted again."""
    rank, n, step = rank.copy(), len(rank), 1
    order = np.argsort(rank, kind="stable")
    rank_sorted = rank[order]
    rank[order] = np.searchsorted(rank_sorted, rank_sorted)  # a rank is the place of its group
    while True:
        r = rank[order]
        head = np.concatenate(([True], r[1:] != r[:-1], [True]))
        tied = np.flatnonzero(~(head[:-1] & head[1:]))
        if not len(tied):
            return order
        at = order[tied]
        follow = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        by = np.lexsort((follow, rank[at]))
        at, follow = at[by], follow[by]
        order[tied] = at
        old = rank[at]
        new = np.concatenate(([True], (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])))
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        step *= 2


def suffixes(shard: Shard, folder: str | None = None, limit: int = 1 << 22) -> np.ndarray:
    """All suffixes in ascending order, ends of parts first."""
    lms = shard.sorted_lms(folder, limit)
    runs = [at for at, _ in shard.induce(lms, np.zeros(len(lms), np.int64), 0, folder, limit)]
    return np.concatenate([np.flatnonzero(shard.t == 0), *[r[::-1] for r in runs[::-1]]])


def sorted_runs(parts: list[bytes], cap: int, folder: str | None = None, limit: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of the concatenated parts (each followed by an end) in descending order, in runs, with common prefixes up to ``cap``."""
    t = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.int64) + 1
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    t[ends] = 0
    shard = Shard(t, 257)
    lms = shard.sorted_lms(folder, limit)
    lcp = np.concatenate(([0], shard.common(lms[:-1], lms[1:], cap)))
    yield from shard.induce(lms, lcp, cap, folder, limit)
