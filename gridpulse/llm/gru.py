"""A gated recurrent language model in numpy: truncated backpropagation and an output softmax factored into classes.

Inputs and outputs are symbols. Head words are symbols of their own, in classes of ``CLASS_WORDS`` whose members have a softmax that depends on
the state; every other word is the symbol of its class alone, and the caller gives its share of the class.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

CLASS_WORDS = 32


@dataclass
class Weights:
    """``table``: one row of gate inputs for each symbol; ``state``: from state to gates; ``to_class``, ``to_word``: the two softmaxes."""

    table: np.ndarray
    state: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.table, self.state, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def like(self, flat: np.ndarray) -> Weights:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at: at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Weights(*out)


def start(symbols: int, class_counts: np.ndarray, word_counts: np.ndarray, hidden: int, seed: int = 3) -> Weights:
    """Before training the model is the classes' and words' own frequencies. ``word_counts``: head classes x CLASS_WORDS, 0 for none."""
    rng = np.random.default_rng(seed)

    def small(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)

    heads = len(word_counts)
    bias = np.log(np.maximum(class_counts, 0.5) / max(class_counts.sum(), 1.0))
    words = np.where(word_counts > 0, np.log(np.maximum(word_counts, 1)), -1e4)
    return Weights(small(symbols, 3 * hidden) * 0.5, small(hidden, 3 * hidden), small(hidden, len(class_counts)) * 0.1, bias.astype(np.float32),
                   small(heads, hidden, CLASS_WORDS) * 0.1, words.astype(np.float32))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def step(w: Weights, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state, and what backpropagation needs."""
    n = h.shape[1]
    g = h @ w.state
    zr = sigmoid(x[:, : 2 * n] + g[:, : 2 * n])
    z, r, u = zr[:, :n], zr[:, n:], g[:, 2 * n:]
    c = np.tanh(x[:, 2 * n:] + r * u)
    return c + z * (h - c), z, r, u, c


def log_softmax(a: np.ndarray) -> np.ndarray:
    a = a - a.max(1, keepdims=True)
    return a - np.log(np.exp(a).sum(1, keepdims=True))


def picked(a: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log softmax of one column of each row; ``a`` is overwritten."""
    a -= a.max(1, keepdims=True)
    own = a[np.arange(len(a)), at]
    np.exp(a, out=a)
    return own - np.log(a.sum(1))


def _by_class(classes: np.ndarray, heads: int):
    """(class, rows of it) for the head classes that occur."""
    order = np.argsort(classes, kind="stable")
    edges = np.searchsorted(classes[order], np.arange(heads + 1))
    for c in np.flatnonzero(np.diff(edges)):
        yield c, order[edges[c]: edges[c + 1]]


def log_probs(w: Weights, h: np.ndarray, classes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Natural log probability of each row's class and, in head classes, of its word there."""
    out = picked(h @ w.to_class + w.class_bias, classes)
    for c, rows in _by_class(classes, len(w.to_word)):
        out[rows] += picked(h[rows] @ w.to_word[c] + w.word_bias[c], words[rows])
    return out


class Trainer:
    """Adam on windows of ``window`` symbols; the state is carried from one window of a sequence to the next, gradients are not."""

    def __init__(self, w: Weights, window: int = 32, rate: float = 4e-3) -> None:
        self.w, self.window, self.rate, self.t = w, window, rate, 0
        self.m = [np.zeros_like(a) for a in w.arrays()]
        self.v = [np.zeros_like(a) for a in w.arrays()]

    def sequences(self, inputs: np.ndarray, classes: np.ndarray, words: np.ndarray, lens: np.ndarray) -> float:
        """One update for each window over rows of padded symbols; returns the mean loss."""
        h = np.zeros((len(inputs), self.w.state.shape[0]), np.float32)
        loss = count = 0.0
        for at in range(0, inputs.shape[1], self.window):
            part = slice(at, at + self.window)
            on = np.arange(inputs.shape[1])[None, part] < lens[:, None]
            if on.any():
                h, total = self._window(inputs[:, part], classes[:, part], words[:, part], on, h)
                loss, count = loss + total, count + on.sum()
        return loss / max(count, 1)

    def walk(self, windows: Iterable[tuple[np.ndarray, ...]], lanes: int) -> int:
        """One update for each window of ``windows_of``, the state of a lane carried while its walk goes on; returns the number of symbols."""
        h, seen = np.zeros((lanes, self.w.state.shape[0]), np.float32), 0
        for live, goes_on, inputs, classes, words, on in windows:
            h[live] = self._window(inputs, classes, words, on, h[live] * goes_on[:, None])[0]
            seen += int(on.sum())
        return seen

    def _window(self, inputs, classes, words, on, h):
        w, steps = self.w, inputs.shape[1]
        kept, hs = [], []
        for t in range(steps):
            before = h
            h, *rest = step(w, w.table[inputs[:, t]], h)
            kept.append((before, *rest))
            hs.append(h)
        states = np.stack(hs, 1)
        rows = states[on]
        cls, wrd = classes[on], words[on]
        n = len(rows)
        logp = log_softmax(rows @ w.to_class + w.class_bias)
        loss = -logp[np.arange(n), cls].sum()
        d = np.exp(logp)
        d[np.arange(n), cls] -= 1
        d /= n
        grad = [np.zeros_like(a) for a in w.arrays()]
        grad[2], grad[3] = rows.T @ d, d.sum(0)
        d_rows = d @ w.to_class.T
        for c, at in _by_class(cls, len(w.to_word)):
            own = rows[at]
            lp = log_softmax(own @ w.to_word[c] + w.word_bias[c])
            loss -= lp[np.arange(len(at)), wrd[at]].sum()
            e = np.exp(lp)
            e[np.arange(len(at)), wrd[at]] -= 1
            e /= n
            grad[4][c], grad[5][c] = own.T @ e, e.sum(0)
            d_rows[at] += e @ w.to_word[c].T
        d_states = np.zeros_like(states)
        d_states[on] = d_rows
        size = w.state.shape[0]
        dh = np.zeros_like(h)
        d_inputs = np.zeros((*inputs.shape, 3 * size), np.float32)
        for t in range(steps - 1, -1, -1):
            before, z, r, u, c = kept[t]
            dh = dh + d_states[:, t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            dr = dc * u * r * (1 - r)
            d_inputs[:, t, :size], d_inputs[:, t, size: 2 * size], d_inputs[:, t, 2 * size:] = dz, dr, dc
            gates = np.concatenate([dz, dr, dc * r], 1)
            grad[1] += before.T @ gates
            dh = dh * z + gates @ w.state.T
        order = np.argsort(inputs, axis=None, kind="stable")
        own = inputs.ravel()[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        grad[0][own[first]] = np.add.reduceat(d_inputs.reshape(-1, 3 * size)[order], first, axis=0)
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
        for a, g, m, v in zip(w.arrays(), grad, self.m, self.v):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= scale * m / (np.sqrt(v) + 1e-7)
        return h, float(loss)


def windows_of(walks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], lanes: int, window: int = 32) -> Iterator[tuple[np.ndarray, ...]]:
    """Every symbol of every walk (inputs, classes, words) once: ``lanes`` walks side by side, and where one ends the next begins.

    Yields the lanes that have a walk, whether it goes on from the window before, its padded inputs, classes and words, and which of them count.
    """
    held, at = [None] * lanes, [0] * lanes
    while True:
        for lane in range(lanes):
            if held[lane] is None:
                held[lane], at[lane] = next(walks, None), 0
        live = [lane for lane in range(lanes) if held[lane] is not None]
        if not live:
            return
        goes_on = np.array([at[lane] > 0 for lane in live])
        inputs, classes, words = np.zeros((3, len(live), window), np.int64)
        on = np.zeros((len(live), window), bool)
        for row, lane in enumerate(live):
            i, c, w = held[lane]
            part = slice(at[lane], at[lane] + window)
            n = len(i[part])
            inputs[row, :n], classes[row, :n], words[row, :n], on[row, :n] = i[part], c[part], w[part], True
            at[lane] += n
            if at[lane] == len(i):
                held[lane] = None
        yield np.array(live), goes_on, inputs, classes, words, on


def score_sequences(w: Weights, inputs: np.ndarray, classes: np.ndarray, words: np.ndarray, lens: np.ndarray, window: int = 32,
                    together: int = 1024) -> np.ndarray:
    """Natural log probability of each sequence. The arrays hold all sequences one after another; the state is carried over whole sequences."""
    out = np.zeros(len(lens))
    begins = np.cumsum(lens) - lens
    order = np.argsort(-lens, kind="stable")
    for at in range(0, len(order), together):
        own = order[at: at + together]
        size, first = lens[own], begins[own]
        h = np.zeros((len(own), w.state.shape[0]), np.float32)
        for t in range(0, int(size.max(initial=0)), window):
            # Longest first: the sequences that go on are the first ones.
            live = int(np.searchsorted(-size, -t, "left"))
            steps = int(min(window, size[0] - t))
            h, begin, left = h[:live], first[:live] + t, size[:live] - t
            states, places = [], []
            for k in range(steps):
                n = int(np.searchsorted(-left, -k, "left"))
                h[:n] = step(w, w.table[inputs[begin[:n] + k]], h[:n])[0]
                states.append(h[:n].copy())
                places.append(begin[:n] + k)
            where = np.concatenate(places)
            lp = log_probs(w, np.concatenate(states), classes[where], words[where])
            out[own[:live]] += np.bincount(np.concatenate([np.arange(len(p)) for p in places]), lp, live)
    return out
