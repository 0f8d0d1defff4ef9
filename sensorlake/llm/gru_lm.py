"""Language-model scoring: a gated recurrent network with class-factored output, and a unigram base score.

Word counts of all training texts are one aggregation. Words that occur ``often`` times or more, and at least the
``vocabulary`` most frequent ones (of those that are broadcast), the end mark and "other" are the network's
tokens, in classes of like probability mass: p(word) = p(class) * p(word in class). The network starts from the
words' shares and is trained on every training text: texts are dealt into ``rounds`` by a hash of doc_id, and in a round
each partition runs truncated backpropagation over its texts (split into tokens once, stored) from the broadcast weights, with the state carried from
window to window, and gives its changes; their means, weighted by how often a partition met a
token, are added up on Spark. It scores whole texts the same
way, many texts side by side. A word outside the vocabulary has the probability
of "other" times its add-one share among all such words, so the score is a
proper probability of the whole text.

Counts of the (at most ``frequent``) commonest words are broadcast after that
bound is applied; rarer words of a text get theirs from a join on the word.

Training texts are those whose crc32(doc_id as text) mod 7 is not 2. Words are told apart by a
64-bit hash.

Rows: a null or empty text is the end mark alone; a null doc_id is neither
trained on nor held out; equal rows and repeated ids are scored each; without
training texts the counts are zero and the network is an untrained one of "other" and end; an
empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.tables import stored
from sensorlake.llm.text import slices, utf8, words

END, OTHER = 0, 1
BLOCK = 32
#: rows of class probabilities, and logits within classes, at a time, which stay in the cache
ROWS, CELLS = 2048, 1 << 19
#: states that are scored at a time, so that the rows of a class are many
SCORED = 1 << 14
HELD = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7"


# --- the network ---------------------------------------------------------------------------------------------------


def add_up_rows(at: np.ndarray, rows: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different values of ``at``, which ascends, and for each the sum of its rows); order[i] gives the one or several parts of row i."""
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1, [len(at)]))
    size = np.diff(first)
    take = lambda some: rows.take(order.take(some, axis=0), axis=0, mode="clip").reshape(len(some), -1)
    out = np.empty((len(size), order.shape[1] * rows.shape[1]), rows.dtype)
    often = np.flatnonzero(size >= 8)  # frequent tokens: one product each
    if len(often):
        part, ones, lo = take(np.flatnonzero(np.repeat(size >= 8, size))), np.ones(size.max(), rows.dtype), 0
        for k, n in zip(often.tolist(), size[often].tolist(), strict=True):
            np.dot(ones[:n], part[lo: lo + n], out=out[k])
            lo += n
    for n in range(1, 8):  # the others by like counts, as whole blocks
        some = np.flatnonzero(size == n)
        if len(some):
            total = take(first[some])
            for k in range(1, n):
                total += take(first[some] + k)
            out[some] = total
    return at[first[:-1]], out


def class_bounds(mass: np.ndarray, classes: int) -> np.ndarray:
    """Cuts tokens 0..n-1 (common ones first) into up to ``classes`` runs of like total ``mass``."""
    share = np.cumsum(np.sqrt(mass + 1.0))
    cls = np.minimum((share / share[-1] * classes).astype(int), classes - 1)
    return np.concatenate(([0], np.flatnonzero(np.diff(cls)) + 1, [len(mass)]))


def fits(total: np.ndarray) -> bool:
    """If sums of exponentials are so far from the ends of their type that no maximum had to be taken out."""
    return bool(total.min() > 1e-30 and total.max() < 1e30)


class Network:
    """GRU over tokens; output softmax over classes and over the tokens of a class."""

    def __init__(self, bounds: np.ndarray, hidden: int = 16, seed: int = 11):
        n, c, rng = int(bounds[-1]), len(bounds) - 1, np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) * 0.1).astype(np.float32)
        self.bounds, self.hidden = bounds, hidden
        self.width = np.diff(bounds)
        self.cls = np.repeat(np.arange(c), self.width)
        # where the rows of a token are sorted to: its class, or behind all others if it is alone in it
        self.place, self.group = np.arange(n) - bounds[self.cls], np.where(self.width > 1, np.arange(c), c)[self.cls].astype(np.int16 if c < 1 << 15 else np.int64)
        self.p = {"x": draw(n, 3 * hidden), "u": draw(hidden, 3 * hidden), "c": draw(hidden, c), "cb": np.zeros(c, np.float32),
                  "w": draw(n, hidden), "wb": np.zeros(n, np.float32)}
        # sums of squared gradients (one a row for the tables by token), and how often training met a token and a class
        self.seen = {name: np.zeros(v.shape[:1] if name in ("x", "w") else v.shape, np.float32) for name, v in self.p.items()}
        self.met, self.met_class = np.zeros(n, np.int64), np.zeros(c, np.int64)
        self.kept: dict[str, np.ndarray] = {}

    def _room(self, name: str, like: np.ndarray, *shape: int) -> np.ndarray:
        """An array to fill, in memory kept from window to window: fresh pages cost as much as the arithmetic."""
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size or self.kept[name].dtype != like.dtype:
            self.kept[name] = np.empty(size, like.dtype)
        return self.kept[name][:size].reshape(shape)

    # gates lie one after the other, (3, lanes, hidden): operations on one of them run through memory without gaps

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        """Rows of the input table seen as (tokens * 3, hidden) that hold the gates of tokens ``x`` (steps, lanes): (steps, 3, lanes)."""
        return 3 * x[:, None, :] + np.arange(3)[None, :, None]

    def _by_gate(self, u: np.ndarray) -> np.ndarray:
        """Recurrent weights by gate, those of the sigmoid gates with the other sign, as their exponent needs it."""
        u = np.ascontiguousarray(u.reshape(self.hidden, 3, self.hidden).transpose(1, 0, 2))
        u[:2] *= -1
        return u

    @staticmethod
    def _step(gates: np.ndarray, h: np.ndarray, u: np.ndarray, pair: np.ndarray | None = None, rh: np.ndarray | None = None,
              more: np.ndarray | None = None, after: np.ndarray | None = None):
        """State after, in ``after`` if that is given; ``gates`` holds the inputs and becomes z, r and the new state.

        ``rh`` takes the recurrent part of the new state times r, ``more`` the state after less the new state.
        """
        pair, rh = np.matmul(h, u[:2], out=pair), np.matmul(h, u[2], out=rh)
        zr, new = gates[:2], gates[2]
        np.subtract(pair, zr, out=zr)
        np.exp(zr, out=zr)  # a sum beyond the range of the type gives infinity, and a gate of zero
        zr += 1
        np.reciprocal(zr, out=zr)
        rh *= gates[1]
        new += rh
        np.tanh(new, out=new)
        more = np.subtract(h, new, out=more)
        more *= gates[0]
        return np.add(more, new, out=after)

    def step(self, x: np.ndarray, h: np.ndarray, u: np.ndarray):
        """(state after, z, r, new state) of one step for all lanes: x is the token's input row, h the state."""
        gates = np.ascontiguousarray(x.reshape(-1, 3, self.hidden).transpose(1, 0, 2))
        return self._step(gates, h, self._by_gate(u)), *gates

    def _joined(self, arrays: dict) -> np.ndarray | None:
        """The array (tokens, hidden + 1) whose columns are ``w`` and ``wb``, if there is one."""
        whole = arrays["w"].base
        return whole if whole is not None and whole is arrays["wb"].base and whole.shape == (len(self.cls), self.hidden + 1) else None

    def _output(self) -> tuple[np.ndarray, np.ndarray]:
        """Output weights with the biases last: of classes (hidden + 1, classes) and of tokens (tokens, hidden + 1)."""
        p, tokens = self.p, self._joined(self.p)
        return np.vstack([p["c"], p["cb"]]), np.hstack([p["w"], p["wb"][:, None]]) if tokens is None else tokens

    def _runs(self, edge: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
        """(first row, end row, class) of rows sorted by class, in lists of up to ``CELLS`` logits within classes (at least one row)."""
        run, cells = [], 0
        for k in np.flatnonzero(np.diff(edge)).tolist():
            width, end = int(self.width[k]), int(edge[k + 1])
            most = max(1, CELLS // width)
            for lo in range(int(edge[k]), end, most):
                hi = min(lo + most, end)
                if run and cells + (hi - lo) * width > CELLS:
                    yield run
                    run, cells = [], 0
                run.append((lo, hi, k))
                cells += (hi - lo) * width
        if run:
            yield run

    def log_probs(self, h: np.ndarray, y: np.ndarray, grads: dict | None = None, output: tuple | None = None):
        """Natural log p(y | h) for rows of states; with ``grads`` (zeros) also parameter gradients, and returns d loss / d h, kept until the next call.

        Rows of ``h`` may end with a one, the factor of the biases. ``output`` is that of :meth:`_output`, if it is known.
        """
        size, last = len(y), self.hidden
        classes, tokens = output or self._output()
        if h.shape[1] == last:
            h = np.hstack([h, np.ones((size, 1), h.dtype)])
        order = np.argsort(self.group[y], kind="stable")  # rows of one class side by side
        h, y = np.take(h, order, axis=0, out=self._room("sorted", h, *h.shape), mode="clip"), y[order]
        cls, place = self.cls[y], self.place[y]
        out, dh = np.empty(size, h.dtype), None if grads is None else self._room("dh", h, size, last)
        weights, ones = np.ascontiguousarray(classes[:last].T), np.ones(classes.shape[1], h.dtype)
        for lo in range(0, size, ROWS):
            rows = slice(lo, lo + ROWS)
            part = h[rows]
            d = self._room("classes", h, len(part), classes.shape[1])
            cells, hit = d.reshape(-1), cls[rows] + np.arange(0, d.size, d.shape[1])
            for far in (False, True):
                np.matmul(part, classes, out=d)
                if far:
                    d -= d.max(axis=1, keepdims=True)
                each = cells.take(hit)
                with np.errstate(over="ignore"):
                    total = np.exp(d, out=d) @ ones
                if fits(total):
                    break
            out[rows] = each - np.log(total)
            if grads is not None:  # divided by the total in the narrow factors instead of the wide one
                cells[hit] -= total
                share = 1 / total
                grads["c"] += (part[:, :last] * share[:, None]).T @ d
                grads["cb"] += share @ d
                np.matmul(d, weights, out=dh[rows])
                dh[rows] *= share[:, None]
        # within the classes: the logits of a run lie one after the other, so that all but the products is done at once
        edge = np.searchsorted(self.group[y], np.arange(len(self.bounds)))
        joined = None if grads is None else self._joined(grads)
        changes = np.zeros_like(tokens) if joined is None and grads is not None else joined
        for run in self._runs(edge):
            rows = slice(run[0][0], run[-1][1])
            width = self.width[cls[rows]]
            begin = np.cumsum(width) - width
            cells, hit = self._room("cells", h, int(begin[-1] + width[-1])), begin + place[rows]
            ends = np.cumsum([(hi - lo) * int(self.width[k]) for lo, hi, k in run])[:-1]
            blocks = [d.reshape(hi - lo, -1) for (lo, hi, _), d in zip(run, np.split(cells, ends), strict=True)]
            for far in (False, True):
                for (lo, hi, k), d in zip(run, blocks, strict=True):
                    np.dot(h[lo:hi], tokens[self.bounds[k]: self.bounds[k + 1]].T, out=d)
                    if far:
                        d -= d.max(axis=1, keepdims=True)
                each = cells.take(hit)
                with np.errstate(over="ignore"):
                    total = np.add.reduceat(np.exp(cells, out=cells), begin)
                if fits(total):
                    break
            out[rows] += each - np.log(total)
            if grads is not None:
                cells[hit] -= total
                share = 1 / total
                part, more = h[rows] * share[:, None], self._room("within", h, len(total), last)
                for (lo, hi, k), d in zip(run, blocks, strict=True):
                    words, at = slice(self.bounds[k], self.bounds[k + 1]), slice(lo - rows.start, hi - rows.start)
                    if lo == edge[k]:
                        np.dot(d.T, part[at], out=changes[words])
                    else:
                        changes[words] += d.T @ part[at]
                    np.dot(d, tokens[words, :last], out=more[at])
                more *= share[:, None]
                dh[rows] += more
        if changes is not joined:
            grads["w"] += changes[:, :last]
            grads["wb"] += changes[:, last]
        back = np.empty(size, np.int64)
        back[order] = np.arange(size)
        return out[back], None if dh is None else np.take(dh, back, axis=0, out=self._room("dh_back", h, *dh.shape), mode="clip")

    def window(self, x: np.ndarray, y: np.ndarray, reset: np.ndarray, h: np.ndarray, grads: dict | None = None):
        """(loss, gradients, state after) of one truncated window: inputs, targets and state resets are (steps, lanes).

        ``grads`` are arrays of zeros to fill, with ``x`` for the tokens of the window alone, in ascending order, which replaces
        what is there; without them new ones of the parameters' shapes are made.
        """
        k, p, every = self.hidden, self.p, grads is None
        grads = {name: np.zeros_like(v) for name, v in p.items() if name != "x"} if every else grads
        table, at, u = p["x"].reshape(-1, k), self._inputs(x), self._by_gate(p["u"])
        gates, pair = self._room("gates", h, len(x), 3, x.shape[1], k), self._room("pair", h, 2, x.shape[1], k)
        rhs, mores, states = (self._room(name, h, *x.shape, n) for name, n in (("rhs", k), ("mores", k), ("states", k + 1)))
        befores = self._room("befores", h, len(x) + 1, x.shape[1], k)
        states[:, :, k] = 1
        resets = [np.flatnonzero(r) for r in reset]
        befores[0] = h
        for t in range(len(x)):
            befores[t][resets[t]] = 0
            np.take(table, at[t], axis=0, out=gates[t], mode="clip")
            states[t, :, :k] = self._step(gates[t], befores[t], u, pair, rhs[t], mores[t], befores[t + 1])
        out, dh_out = self.log_probs(states.reshape(-1, k + 1), y.reshape(-1), grads)
        dh_out = dh_out.reshape(len(x), -1, k)
        carry = np.zeros_like(h)
        back = np.ascontiguousarray(p["u"].reshape(k, 3, k).transpose(1, 2, 0))
        dn, kept, by_gate = np.empty_like(h), np.empty_like(h), np.zeros((3, k, k), h.dtype)
        for t in range(len(x) - 1, -1, -1):
            # z, r and the new state become the gradients of their inputs; dn is that of the recurrent part of the new state
            z, r, new = gates[t]
            dh = dh_out[t]
            dh += carry
            np.multiply(dh, z, out=kept)
            dh -= kept
            np.multiply(dh, mores[t], out=z)
            new *= new
            np.subtract(1, new, out=new)
            new *= dh
            np.multiply(new, r, out=dn)
            np.subtract(new, dn, out=r)
            r *= rhs[t]
            before = befores[t].T
            by_gate[:2] += np.matmul(before, gates[t, :2])
            by_gate[2] += before @ dn
            carry, more = np.matmul(gates[t, :2], back[:2], out=pair)
            carry += more
            carry += np.matmul(dn, back[2], out=more)
            carry += kept
            carry[resets[t]] = 0
        grads["u"] += by_gate.transpose(1, 0, 2).reshape(k, 3 * k)
        order = np.argsort(x.reshape(-1).astype(np.uint16 if len(p["x"]) <= 1 << 16 else np.int32), kind="stable")
        lanes = x.shape[1]
        parts = (order + 2 * lanes * (order // lanes))[:, None] + lanes * np.arange(3)
        met, grads["x"] = add_up_rows(x.reshape(-1)[order], gates.reshape(-1, k), parts)
        if every:
            table, grads["x"] = grads["x"], np.zeros_like(p["x"])
            grads["x"][met] = table
        return -float(out.sum()), {name: grads[name] for name in p}, befores[len(x)].copy()

    def start(self, mass: np.ndarray) -> Network:
        """Biases that give each token its share of ``mass`` before anything is learned."""
        mass = mass + 1.0
        each = np.add.reduceat(mass, self.bounds[:-1])
        self.p["cb"] = np.log(each / each.sum()).astype(np.float32)
        self.p["wb"] = np.log(mass / each[self.cls]).astype(np.float32)
        return self

    def train(self, docs: list[np.ndarray], lanes: int = 32, steps: int = 16, epochs: int = 2, rate: float = 0.05, clip: float = 5.0) -> Network:
        """Adagrad over windows of a stream of documents (each ends with the end mark, which also starts the next).

        Tables by token have one step size a row, and only rows that a window meets are changed.
        """
        if not docs:
            return self
        stream = np.concatenate([[END], *docs])
        lanes = min(lanes, len(stream) - 1)
        size = -(-(len(stream) - 1) // lanes)
        # the last lane is filled up from the start: no token is left out
        x, y = (np.resize(s, (lanes, size)) for s in (stream[:-1], stream[1:]))
        # weights and biases of tokens side by side, and so their gradients: one product gives both
        tokens = np.hstack([self.p["w"], self.p["wb"][:, None]])
        changes = np.zeros_like(tokens)
        self.p["w"], self.p["wb"] = tokens[:, :-1], tokens[:, -1]
        grads = {name: np.zeros_like(self.p[name]) for name in ("u", "c", "cb")} | {"w": changes[:, :-1], "wb": changes[:, -1]}
        for _ in range(epochs):
            h = np.zeros((lanes, self.hidden), np.float32)
            for t in range(0, size, steps):
                xs, ys = (np.ascontiguousarray(s[:, t: t + steps].T) for s in (x, y))
                _, found, h = self.window(xs, ys, xs == END, h, grads)
                met = np.bincount(xs.reshape(-1), minlength=len(self.met))
                met_class = np.bincount(self.cls[ys].reshape(-1), minlength=len(self.met_class))
                self.met += met
                self.met_class += met_class
                inputs, hit = np.flatnonzero(met), np.flatnonzero(met_class)
                # where most are met, all take part: the others have gradients of zero
                words = slice(None) if 2 * self.width[hit].sum() >= len(met) else np.concatenate(
                    [np.arange(self.bounds[c], self.bounds[c + 1]) for c in hit])
                rows, block = {"x": inputs, "w": words, "wb": words}, changes[words]
                part = found | {"w": block[:, :-1], "wb": block[:, -1]}
                scale = 1.0 / ys.size
                squares = {name: np.einsum("ij,ij->i", g, g) if name in ("x", "w") else g * g for name, g in part.items()}
                norm = scale * float(sum(q.sum() for q in squares.values())) ** 0.5
                scale *= min(1.0, clip / (norm + 1e-9))
                for name, g in part.items():
                    at_rows, by_row = rows.get(name, slice(None)), name in ("x", "w")
                    self.seen[name][at_rows] += squares[name] * np.float32(scale * scale / (g.shape[1] if by_row else 1))
                    change = np.float32(rate * scale) / (np.sqrt(self.seen[name][at_rows]) + np.float32(1e-8))
                    g *= change[:, None] if by_row else change
                    if name not in ("w", "wb"):
                        self.p[name][at_rows] -= g
                tokens[words] -= block
                changes[words] = 0
                for name in ("u", "c", "cb"):
                    grads[name][:] = 0
        return self

    def score(self, docs: list[np.ndarray], lanes: int = 1024, steps: int = 32) -> np.ndarray:
        """Natural log probability of each document (tokens with the end mark), state carried over windows."""
        out = np.zeros(len(docs))
        order = np.argsort([-len(d) for d in docs], kind="stable")
        k, u, table, (classes, tokens) = self.hidden, self._by_gate(self.p["u"]), self.p["x"].reshape(-1, self.hidden), self._output()
        output = classes, np.asfortranarray(tokens)
        states = self._room("scored", table, SCORED + lanes, k + 1)
        states[:, k] = 1
        targets, texts, used = np.empty(len(states), np.int64), np.empty(len(states), np.int64), 0
        for g in range(0, len(order), lanes):
            rows = order[g: g + lanes]
            size = np.array([len(docs[r]) for r in rows])
            # lanes are sorted by length: the first ones go on
            live = (len(rows) - np.searchsorted(size[::-1], np.arange(size[0]), "right")).tolist()
            h = np.zeros((len(rows), k), np.float32)
            ids = np.concatenate([*(docs[r] for r in rows), np.full(steps, END)])
            begin = np.cumsum(size) - size
            last = np.full(len(rows), END)
            for t in range(0, int(size[0]), steps):
                n = live[t]
                x = np.full((steps + 1, n), END)
                x[0] = last[:n]
                # behind the end of a text stand tokens of the next one, which no score uses
                x[1:] = ids.take(begin[None, :n] + t + np.arange(steps)[:, None], mode="clip")
                at = self._inputs(x)
                for s, m in enumerate(live[t: t + steps]):
                    gates = np.take(table, at[s, :, :m], axis=0, out=self._room("gates", table, 3, m, k), mode="clip")
                    h = self._step(gates, h[:m], u, self._room("pair", table, 2, m, k), self._room("rh", table, m, k))
                    rest = slice(used, used + m)
                    states[rest, :k], targets[rest], texts[rest] = h, x[s + 1, :m], rows[:m]
                    used += m
                    if used >= SCORED:
                        out += np.bincount(texts[:used], self.log_probs(states[:used], targets[:used], output=output)[0], minlength=len(out))
                        used = 0
                last = x[-1]
        if used:
            out += np.bincount(texts[:used], self.log_probs(states[:used], targets[:used], output=output)[0], minlength=len(out))
        return out

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bounds=self.bounds, hidden=self.hidden, **self.p, **{f"seen_{k}": v for k, v in self.seen.items()})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        got = np.load(io.BytesIO(data))
        net = cls(got["bounds"], int(got["hidden"]))
        net.p = {k: got[k] for k in net.p}
        net.seen = {k: got[f"seen_{k}"] for k in net.seen}
        return net

    # what a partition learned travels in blocks of ``BLOCK`` tokens and one (-1) for the rest

    def _parts(self) -> list[np.ndarray]:
        """Views, one row a token: input table, then output table with bias; each with its sums of squares."""
        p, s = self.p, self.seen
        return [p["x"], s["x"][:, None], p["w"], s["w"][:, None], p["wb"][:, None], s["wb"][:, None]]

    def _rest(self) -> list[np.ndarray]:
        return [a[name] for a in (self.p, self.seen) for name in ("u", "c", "cb")]

    def changes(self, before: Network) -> Iterator[tuple[int, bytes]]:
        """(block, weighted differences to ``before`` with their weights) after training; rows weigh as often as they were met."""
        met, out = self.met.astype(np.float64), self.met_class[self.cls].astype(np.float64)
        total = float(self.met.sum())
        yield -1, np.concatenate([*(total * (a - b).ravel() for a, b in zip(self._rest(), before._rest(), strict=True)), [total]]).tobytes()
        for lo in range(0, len(met), BLOCK):
            rows = slice(lo, lo + BLOCK)
            if not met[rows].any() and not out[rows].any():
                continue
            cols = [w[rows, None] * (a[rows] - b[rows]).astype(np.float64) for a, b, w in zip(
                self._parts(), before._parts(), (met, met, out, out, out, out), strict=True)]
            yield lo // BLOCK, np.hstack([*cols, met[rows, None], out[rows, None]]).tobytes()

    def apply(self, sums: Iterator[tuple[int, bytes]]) -> Network:
        """Adds the weighted means of all partitions' changes, given their sums by block."""
        for block, data in sums:
            got = np.frombuffer(data)
            if block < 0:
                at, total = 0, max(1.0, got[-1])
                for a in self._rest():
                    a += (got[at: at + a.size].reshape(a.shape) / total).astype(np.float32)
                    at += a.size
                continue
            rows = slice(block * BLOCK, min((block + 1) * BLOCK, len(self.met)))
            got = got.reshape(rows.stop - rows.start, -1)
            met, out, at = np.maximum(got[:, -2:-1], 1), np.maximum(got[:, -1:], 1), 0
            for a, w in zip(self._parts(), (met, met, out, out, out, out), strict=True):
                a[rows] += (got[:, at: at + a.shape[1]] / w).astype(np.float32)
                at += a.shape[1]
        return self


# --- the corpus ----------------------------------------------------------------------------------------------------


def token_counts(train: DataFrame) -> DataFrame:
    """(word, c): occurrences of each word hash in all training texts, added up per batch first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column(0))
            seen, waiting = [], 0
            for i, j in slices(at):
                seen.append(words(data, at, i, j)[3])
                waiting += len(seen[-1])
                if waiting > 2_000_000 or j == b.num_rows:
                    w, n = np.unique(np.concatenate(seen), return_counts=True)
                    yield pa.record_batch([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "c"])
                    seen, waiting = [], 0

    return train.select("text").mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def common_words(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending, counts) of all words at or above the least count that at most ``most`` words reach."""
    level = F.expr("CASE WHEN c <= 1000 THEN c ELSE CAST(1000 + 64 * floor(log2(c / 1000D) * 64) AS LONG) END")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).orderBy(F.desc("level")).take(10_000)
    total, least = 0, None
    for r in levels:
        total += r["n"]
        if total > most:
            break
        least = r["c"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = counts.filter(F.col("c") >= least).toArrow()  # at most ``most`` rows
    w, c = table.column("word").to_numpy().view(np.uint64), table.column("c").to_numpy()
    order = np.argsort(w)
    return w[order], c[order]


def starts(known: np.ndarray) -> np.ndarray:
    """Where the ascending hashes of each value of their leading bits begin (a power of two of values, as many as there are hashes or more)."""
    bits = max(1, int(len(known) - 1).bit_length())
    return np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)


def places(known: np.ndarray, begin: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of each hash among the ascending ``known`` ones, or -1; ``begin`` is ``starts(known)``."""
    if not len(known):
        return np.full(len(h), -1, np.int64)
    k = begin.take((h >> np.uint64(65 - len(begin).bit_length())).view(np.int64)).astype(np.int64)
    found = known.take(k, mode="clip")
    out, rest = np.where(found == h, k, -1), np.flatnonzero(found < h)
    for step in (1, 2):  # the fewer that come behind one or two others of the same leading bits
        at = k[rest] + step
        found, want = known.take(at, mode="clip"), h[rest]
        out[rest[found == want]] = np.minimum(at, len(known) - 1)[found == want]
        rest = rest[found < want]
    at = np.searchsorted(known, h[rest])
    out[rest] = np.where(known.take(at, mode="clip") == h[rest], np.minimum(at, len(known) - 1), -1)
    return out


def score_documents(docs: DataFrame, vocabulary: int = 4094, classes: int = 64, frequent: int = 300_000, hidden: int = 32,
                    often: int = 1000, rounds: int = 4, shard_tokens: int = 1_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10 of the whole text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.expr(f"coalesce({HELD} = 2, false)").alias("held_out"))
    train = docs.filter("doc_id IS NOT NULL AND NOT held_out")
    counts = stored(token_counts(train), "words")
    ends = train.count()
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v_all = totals["n"] + ends, totals["v"] + (ends > 0)
    known, c_known = common_words(counts, frequent)
    top = np.sort(np.lexsort((known, -c_known))[:max(vocabulary, int((c_known >= often).sum()))])
    by_count = top[np.lexsort((known[top], -c_known[top]))]
    token = np.full(len(known), OTHER, np.int64)
    token[by_count] = np.arange(2, 2 + len(by_count))
    n_other, v_other = n_all - ends - int(c_known[top].sum()), totals["v"] - len(top)
    mass = np.concatenate(([ends, n_other], c_known[by_count])).astype(float)
    bounds = class_bounds(mass, min(max(classes, int(len(mass) ** 0.5)), len(mass)))
    least_common = int(c_known.min()) if len(c_known) else 0
    # place -1, that of a word which is not common, is the last one: no known count, and "other"
    table = spark.sparkContext.broadcast((known, starts(known), np.append(np.log10(c_known + 1.0), 0.0), np.append(token, OTHER).astype("<u2" if len(mass) <= 1 << 16 else "<i4")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens of every text, and what its score takes from words outside the vocabulary."""
        from pyspark import TaskContext

        known, begin, logs, token = table.value
        rid = TaskContext.get().partitionId() << 33
        for b in batches:
            n = b.num_rows
            n_words, n_common, n_out, log_common, log_out = (np.zeros(n) for _ in range(5))
            rare, texts = [], []
            data, at = utf8(b.column(1))
            for i, j in slices(at):
                _, _, row, h = words(data, at, i, j)
                first, place = np.searchsorted(row, np.arange(i, j + 1)), places(known, begin, h)
                ids, common, log = token[place], place >= 0, logs[place]
                out, filled = ids == OTHER, np.flatnonzero(np.diff(first))
                n_words[i:j] = np.diff(first)
                if len(filled):
                    for total, values in ((n_common, common), (n_out, out), (log_common, log), (log_out, log * out)):
                        total[i + filled] = np.add.reduceat(values, first[filled], dtype=float)
                rare.append(h[~common])
                ends = first[1:] + np.arange(j - i)
                texts.append(np.full(len(ids) + j - i, END, token.dtype))
                inside = np.ones(len(texts[-1]), bool)
                inside[ends] = False
                texts[-1][inside] = ids
            lists = [np.concatenate(([0], np.cumsum(size))).astype(np.int32) for size in ((n_words + 1) * token.itemsize, n_words - n_common)]
            texts, rare = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (texts, rare))
            yield pa.record_batch([
                b.column(0), b.column(2), pa.array(rid + np.arange(n)), pa.array(n_words.astype(np.int64)), pa.array(n_common.astype(np.int64)),
                pa.array(n_out.astype(np.int64)), pa.array(log_common), pa.array(log_out),
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(lists[0]), pa.py_buffer(texts)]),
                pa.ListArray.from_arrays(pa.array(lists[1]), pa.array(rare.view(np.int64)))],
                names=["doc_id", "held_out", "rid", "n_words", "n_common", "n_out", "log_common", "log_out", "ids", "rare"])
            rid += n

    def texts_of(column: pa.Array) -> list[np.ndarray]:
        """Tokens of each text, with the end mark."""
        code = table.value[3].dtype
        data, at = utf8(column)
        return np.split(data[at[0]: at[-1]].view(code), (at[1:-1] - at[0]) // code.itemsize) if len(column) else []

    kept = "doc_id long, held_out boolean, rid long, n_words long, n_common long, n_out long, log_common double, log_out double"
    encoded = stored(docs.select("doc_id", "text", "held_out").mapInArrow(encode, f"{kept}, ids binary, rare array<long>"), "tokens")
    net = Network(bounds, hidden).start(mass)
    shard = max(shard_tokens, 200 * len(mass))  # a partition's changes stay small beside its texts
    for r in range(rounds):
        held = spark.sparkContext.broadcast(net.dump())

        def learn(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            before, now = Network.load(held.value), Network.load(held.value)
            ready, seen, waiting = [], [], 0  # texts of about a million tokens, and those after them
            for b in batches:
                for i in range(0, b.num_rows, 256):
                    more = texts_of(b.column(0).slice(i, 256))
                    seen += more
                    waiting += sum(map(len, more))
                    if waiting >= 1_000_000:
                        now.train(ready, lanes=512, epochs=1)
                        ready, seen, waiting = seen, [], 0
            if ready and waiting < 500_000:  # few texts alone would be many small windows
                ready, seen, waiting = [], ready + seen, waiting + sum(map(len, ready))
            now.train(ready, lanes=512, epochs=1)
            now.train(seen, lanes=min(512, max(32, waiting // 1024)), epochs=1)
            if now.met.any():
                part = TaskContext.get().partitionId()
                for block, data in now.changes(before):
                    yield pa.record_batch([pa.array([block]), pa.array([part]), pa.array([data], pa.binary())], names=["block", "part", "data"])

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, total = None, None
            row = lambda: pa.record_batch([pa.array([at]), pa.array([total.tobytes()], pa.binary())], names=["block", "data"])
            for b in batches:
                for block, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if block != at and at is not None:
                        yield row()
                    more = np.frombuffer(data.as_buffer())
                    at, total = block, more.copy() if block != at else total + more
            if at is not None:
                yield row()

        # every training text takes part in one round; dealt without a key, so copies do not meet in one task
        some = encoded.filter(f"doc_id IS NOT NULL AND NOT held_out AND pmod(xxhash64(doc_id, 5), {rounds}) = {r}").select("ids")
        changes = some.repartition(max(1, -(-n_all // (rounds * shard)))).mapInArrow(learn, "block long, part long, data binary")
        sums = changes.repartition("block").sortWithinPartitions("block", "part").select("block", "data").mapInArrow(
            add_up, "block long, data binary")
        blocks = 1 + -(-len(net.met) // BLOCK)  # one row a block of the vocabulary, one for the rest
        net.apply((x["block"], x["data"]) for x in sums.take(blocks))
        held.destroy()
    net_bytes = net.dump()
    net_held = spark.sparkContext.broadcast(net_bytes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.load(net_held.value)
        for b in batches:
            net_log = net.score(texts_of(b.column(b.num_columns - 1))) / np.log(10.0)
            yield pa.record_batch([*b.columns[:-1], pa.array(net_log)], names=[*b.schema.names[:-1], "net_log"])

    scored = stored(encoded.drop("rare").mapInArrow(score, f"{kept}, net_log double"), "scored")
    rare_counts = counts.filter(F.col("c") < least_common) if least_common else counts
    pairs = encoded.select("rid", F.explode("rare").alias("word")).join(rare_counts, "word")
    sums = pairs.groupBy("rid").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("log_rare"), F.count(F.lit(1)).alias("n_rare"))
    zero, end = F.lit(0.0), float(np.log10(ends + 1.0))
    whole, others = float(np.log10(n_all + v_all + 1.0)), float(np.log10(n_other + v_other + 1.0))
    return scored.join(sums, "rid", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("log_common") + F.coalesce("log_rare", zero) + end - (F.col("n_words") + 1) * whole).alias("base_score"),
        (F.col("net_log") + F.col("log_out") + F.coalesce("log_rare", zero) - F.col("n_out") * others).alias("score"))
