"""A gated recurrent language model with a class-factored output, in numpy.

Symbols are numbered by class: symbol ``s`` is member ``s % members`` of class
``s // members``, and P(s | h) = P(class | h) * P(member | class, h). Documents run
side by side in lanes; the hidden state is carried from window to window and
reset where a document begins. Training backpropagates inside one window only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WINDOW = 16


def _order(ids: np.ndarray, below: int) -> np.ndarray:
    """A stable order of the numbers; small ones are sorted by radix."""
    return np.argsort(ids.astype(np.int16) if below < 1 << 15 else ids, kind="stable")


class Net:
    """Parameters, their Adagrad sums and the passes over a window."""

    def __init__(self, classes: int, members: int, hidden: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        n, h = classes * members, hidden
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.classes, self.members, self.hidden = classes, members, hidden
        self.p = {
            "E": small(n + 1, 3 * h),  # the last row is the input at a document's start
            "U": small(h, 3 * h),
            "b": np.zeros(3 * h, np.float32),
            "Wc": small(h, classes),
            "bc": np.zeros(classes, np.float32),
            "Wm": small(classes, h, members),
            "bm": np.zeros((classes, members), np.float32),
        }
        self.g2 = {k: np.full_like(v, 1e-2) for k, v in self.p.items()}

    @property
    def start(self) -> int:
        return self.classes * self.members

    def set_unigrams(self, mass: np.ndarray) -> None:
        """Let the output biases give these frequencies of the symbols (add one)."""
        mass = mass.reshape(self.classes, self.members) + 1.0
        self.p["bc"][:] = np.log(mass.sum(1) / mass.sum())
        self.p["bm"][:] = np.log(mass / mass.sum(1, keepdims=True))

    # --- passes ----------------------------------------------------------

    def _by_gate(self, rows: np.ndarray) -> np.ndarray:
        """Rows of update, reset and candidate gate side by side, as one block for each gate."""
        return np.ascontiguousarray(rows.reshape(-1, 3, self.hidden).transpose(1, 0, 2))

    def _side_by_side(self, blocks: np.ndarray) -> np.ndarray:
        return blocks.transpose(1, 0, 2).reshape(-1, 3 * self.hidden)

    def inputs(self) -> tuple:
        """The gates' inputs by symbol and their recurrent weights. The first two
        gates come negated, for 1 / (1 + exp(-a))."""
        sign = np.array([-1, -1, 1], np.float32)[:, None, None]
        return self._by_gate(self.p["E"] + self.p["b"]) * sign, self._by_gate(self.p["U"]) * sign

    def recur(self, h: np.ndarray, x: np.ndarray, begin: np.ndarray, tape: list | None = None, inputs: tuple | None = None):
        """Hidden states [T, B, H] of a window; x are the inputs, begin marks first tokens."""
        out = np.empty((*x.shape, self.hidden), np.float32)
        by_symbol, u = inputs or self.inputs()
        gx = np.take(by_symbol, x, axis=1)
        resets = begin.any(1)
        for t in range(len(x)):
            if resets[t]:
                h = np.where(begin[t][:, None], np.float32(0), h)
            gh = np.matmul(h, u)
            zr = gh[:2]
            zr += gx[:2, t]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr
            c = r * gh[2]
            c += gx[2, t]
            np.tanh(c, out=c)
            if tape is not None:
                tape.append((h, z, r, c, gh[2]))
            now = out[t]
            np.subtract(h, c, out=now)
            now *= z
            now += c
            h = now
        return out, h

    def bounds(self) -> tuple:
        """Bounds of the logits of the classes, and of the members of each class:
        states lie in (-1, 1), so the weights bound every logit."""
        p = self.p
        return (np.abs(p["Wc"]).sum(0).max() + np.abs(p["bc"]).max(),
                np.abs(p["Wm"]).sum(1).max(1) + np.abs(p["bm"]).max(1))

    def _softmax(self, x: np.ndarray, k: str, row, bound: float, own: np.ndarray, grads: dict | None):
        """Log probabilities of ``own`` and, with ``grads``, the gradient by ``x``."""
        w, b = self.p["W" + k], self.p["b" + k]
        if row is not None:
            w, b = w[row], b[row]
        e = x @ w
        e += b
        if bound > 60:  # exp could overflow
            e -= e.max(1, keepdims=True)
        flat, at = e.reshape(-1), np.arange(0, e.size, e.shape[1]) + own
        logp = flat.take(at)
        np.exp(e, out=e)
        total = e @ np.ones(e.shape[1], np.float32)
        logp -= np.log(total)
        if grads is None:
            return logp, None
        # (p - onehot) is e less the total at ``own``, over the total.
        flat[at] = flat.take(at) - total
        share = 1 / total
        dw, db = (x * share[:, None]).T @ e, share @ e
        if row is None:
            grads["W" + k], grads["b" + k] = dw, db
        else:
            grads["W" + k][row], grads["b" + k][row] = dw, db
        dx = e @ w.T
        dx *= share[:, None]
        return logp, dx

    def output(self, hs: np.ndarray, y: np.ndarray, grads: dict | None = None, bounds: tuple | None = None):
        """Log probabilities (natural) of symbols ``y`` [n] after states ``hs`` [n, H].

        The rows are taken in the order of their classes, so that each class is one block.
        """
        bound, member_bounds = bounds or self.bounds()
        cls = y // self.members
        order = _order(cls, self.classes)
        ends = np.searchsorted(cls[order], np.arange(self.classes + 1))
        x, cls, mem = hs[order], cls[order], (y % self.members)[order]
        if grads is not None:
            grads["Wm"], grads["bm"] = np.zeros_like(self.p["Wm"]), np.zeros_like(self.p["bm"])
        logp, dx = self._softmax(x, "c", None, bound, cls, grads)
        for k in range(self.classes):
            at = slice(ends[k], ends[k + 1])
            if ends[k] < ends[k + 1]:
                more, dk = self._softmax(x[at], "m", k, member_bounds[k], mem[at], grads)
                logp[at] += more
                if grads is not None:
                    dx[at] += dk
        out = np.empty_like(logp)
        out[order] = logp
        dhs = None
        if grads is not None:
            dhs = np.empty_like(dx)
            dhs[order] = dx
        return out, dhs

    def back(self, tape: list, begin: np.ndarray, x: np.ndarray, dhs: np.ndarray, grads: dict) -> None:
        """Backpropagation through the steps of one window."""
        n = self.hidden
        u = self._by_gate(self.p["U"])
        ut = u.transpose(0, 2, 1).copy()
        dgx = np.empty((3, *x.shape, n), np.float32)
        dgh = np.empty((3, x.shape[1], n), np.float32)
        du = np.zeros_like(u)
        carry = np.zeros_like(dhs[0])
        resets = begin.any(1)
        for t in range(len(x) - 1, -1, -1):
            h, z, r, c, ghc = tape[t]
            dz, dr, dc = dgx[0, t], dgx[1, t], dgx[2, t]
            dh = dhs[t]
            dh += carry
            keep = dh * z
            np.subtract(dh, keep, out=dc)
            dc *= 1 - c * c
            np.subtract(h, c, out=dz)
            dz *= keep
            dz *= 1 - z
            np.multiply(dc, r, out=dgh[2])
            np.multiply(dgh[2], ghc, out=dr)
            dr *= 1 - r
            dgh[:2] = dgx[:2, t]
            du += np.matmul(h.T, dgh)
            back = np.matmul(dgh, ut)
            carry = keep
            for part in back:
                carry += part
            if resets[t]:
                carry[begin[t]] = 0
        flat, ids = dgx.reshape(3, -1, n), x.reshape(-1)
        order = _order(ids, self.start + 1)
        ids = ids[order]
        first = np.concatenate([[0], np.nonzero(np.diff(ids))[0] + 1])
        grads["U"], grads["b"] = self._side_by_side(du), flat.sum(1).reshape(-1)
        grads["E"] = (ids[first], self._side_by_side(np.add.reduceat(np.take(flat, order, axis=1), first, axis=1)))

    def step(self, grads: dict, rate: float) -> None:
        for k, g in grads.items():
            if isinstance(g, tuple):
                rows, g = g
                self.g2[k][rows] += g * g
                self.p[k][rows] -= rate * g / np.sqrt(self.g2[k][rows])
            else:
                self.g2[k] += g * g
                self.p[k] -= rate * g / np.sqrt(self.g2[k])


# --- documents in lanes ---------------------------------------------------


def windows(docs: list[np.ndarray], lanes: int, start: int, window: int = WINDOW) -> Iterator[tuple]:
    """(active, x, y, begin, doc) windows over documents dealt to lanes, longest first.

    ``active`` is the number of lanes in use; rows of a window past a lane's end have doc -1.
    """
    lanes = max(1, min(lanes, len(docs)))
    load, dealt = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        k = int(load.argmin())
        dealt[k].append(i)
        load[k] += len(docs[i])
    if not docs:
        return
    order = np.argsort(-load, kind="stable")
    size = load[order]
    inside = [i for k in order for i in dealt[k]]
    symbols = np.concatenate([docs[i] for i in inside], dtype=np.int32)
    owner = np.repeat(np.array(inside, np.int32), [len(docs[i]) for i in inside])
    previous = np.concatenate([[start], symbols[:-1]]).astype(np.int32)
    previous[np.concatenate([[0], np.nonzero(np.diff(owner))[0] + 1])] = start
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    for t in range(0, int(size[0]), window):
        active = int((size > t).sum())
        place = t + np.arange(window)[:, None]
        real = place < size[:active]
        at = np.where(real, first[:active] + place, 0)
        x = np.where(real, previous[at], start)
        yield active, x, symbols[at], x == start, np.where(real, owner[at], -1)


def train(net: Net, docs: list[np.ndarray], lanes: int, rate: float) -> None:
    """One pass over the documents; each window is one step."""
    h = np.zeros((max(1, min(lanes, len(docs))), net.hidden), np.float32)
    for active, x, y, begin, doc in windows(docs, lanes, net.start):
        tape, grads = [], {}
        hs, h = net.recur(h[:active], x, begin, tape)
        real = (doc >= 0).reshape(-1)
        flat = hs.reshape(-1, net.hidden)
        if real.all():
            _, dhs = net.output(flat, y.reshape(-1), grads)
        else:
            dhs = np.zeros_like(flat)
            _, dhs[real] = net.output(flat[real], y.reshape(-1)[real], grads)
        net.back(tape, begin, x, dhs.reshape(hs.shape), grads)
        net.step(grads, rate)


def log_likelihoods(net: Net, docs: list[np.ndarray], lanes: int) -> np.ndarray:
    """log10 probability of each whole document's symbols."""
    out = np.zeros(len(docs))
    h = np.zeros((max(1, min(lanes, len(docs))), net.hidden), np.float32)
    inputs, bounds = net.inputs(), net.bounds()
    for active, x, y, begin, doc in windows(docs, lanes, net.start):
        hs, h = net.recur(h[:active], x, begin, inputs=inputs)
        real = (doc >= 0).reshape(-1)
        real = slice(None) if real.all() else real
        logp, _ = net.output(hs.reshape(-1, net.hidden)[real], y.reshape(-1)[real], bounds=bounds)
        out += np.bincount(doc.reshape(-1)[real], weights=logp, minlength=len(docs))
    return out / np.log(10)
