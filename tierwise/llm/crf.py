"""Linear-chain conditional random field on numpy arrays.

Sequences of a batch are packed time-major (all first positions, then all
second positions, ...), longest sequence first, so one step of a recurrence
is one vector operation over every sequence still running.  Scores are the
emission rows of the positions and one transition matrix.
"""

from __future__ import annotations

import numpy as np


class Packing:
    """Maps positions in sequence order to time-major rows and back."""

    def __init__(self, lengths):
        lengths = np.asarray(lengths, dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        longest = int(lengths.max(initial=0))
        ended = np.bincount(lengths, minlength=longest + 1)
        #: sequences with more than t positions
        self.active = len(lengths) - np.cumsum(ended)[:longest]
        self.offset = np.concatenate(([0], np.cumsum(self.active)))
        starts = np.cumsum(lengths) - lengths
        t = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
        self.rows = self.offset[t] + np.repeat(rank, lengths) if len(t) else t
        self.steps = longest
        self.order = order

    def to_time(self, x: np.ndarray) -> np.ndarray:
        out = np.empty_like(x)
        out[self.rows] = x
        return out

    def to_sequence(self, x: np.ndarray) -> np.ndarray:
        return x[self.rows]


def forward_backward(pack: Packing, scores: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Posterior of each label at each position (sequence order); with
    ``pairs`` also the log partition sum of the batch and the expected
    transition counts."""
    top = scores.max(axis=1, keepdims=True) if len(scores) else scores[:, :1]
    b = pack.to_time(np.exp(scores - top))
    a_mat = np.exp(trans).astype(b.dtype)
    first = np.exp(start).astype(b.dtype)
    alpha, scale = np.empty_like(b), np.empty(len(b), b.dtype)
    off, act = pack.offset, pack.active
    for t in range(pack.steps):
        lo, hi = off[t], off[t + 1]
        cur = b[lo:hi] * (alpha[off[t - 1] : off[t - 1] + act[t]] @ a_mat if t else first)
        s = cur.sum(axis=1)
        np.divide(cur, s[:, None], out=alpha[lo:hi])
        scale[lo:hi] = s
    gamma = np.empty_like(b)
    expected = np.zeros(trans.shape)
    after = None
    for t in range(pack.steps - 1, -1, -1):
        lo, hi, n = off[t], off[t + 1], act[t]
        if after is None:
            beta = np.ones((n, trans.shape[0]), b.dtype)
        else:
            beta = np.ones((n, trans.shape[0]), b.dtype)
            beta[: len(after)] = after @ a_mat.T
            if pairs:
                expected += a_mat * (alpha[lo : lo + len(after)].T @ after)
        gamma[lo:hi] = alpha[lo:hi] * beta
        after = beta * b[lo:hi] / scale[lo:hi, None]
    gamma /= np.maximum(gamma.sum(axis=1, keepdims=True), 1e-30)
    out = pack.to_sequence(gamma)
    if not pairs:
        return out
    return out, float(np.log(scale).sum() + top.sum()), expected


def viterbi(pack: Packing, scores: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best label sequence (sequence order); ties go to the higher label."""
    k = trans.shape[0]
    b = pack.to_time(scores)
    back = np.zeros((len(b), k), np.int8)
    off, act = pack.offset, pack.active
    last = np.empty((len(b), k))
    for t in range(pack.steps):
        lo, hi = off[t], off[t + 1]
        if t == 0:
            last[lo:hi] = b[lo:hi] + start
            continue
        via = last[off[t - 1] : off[t - 1] + act[t], :, None] + trans[None]
        best = k - 1 - via[:, ::-1].argmax(axis=1)
        back[lo:hi] = best
        last[lo:hi] = np.take_along_axis(via, best[:, None], axis=1)[:, 0] + b[lo:hi]
    label = np.empty(len(b), np.int8)
    for t in range(pack.steps - 1, -1, -1):
        lo, n = off[t], act[t]
        ahead = act[t + 1] if t + 1 < pack.steps else 0
        end = k - 1 - last[lo : lo + n, ::-1].argmax(axis=1)
        if ahead:
            nxt = off[t + 1]
            end[:ahead] = back[np.arange(nxt, nxt + ahead), label[nxt : nxt + ahead]]
        label[lo : lo + n] = end
    return pack.to_sequence(label)


class Adam:
    """First-order optimiser for the small models trained on the driver."""

    def __init__(self, params, rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads) -> None:
        """Moves the parameters uphill along ``grads``."""
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
