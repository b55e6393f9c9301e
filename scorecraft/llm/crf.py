"""Linear-chain conditional random field in numpy, for many sequences at once.

Sequences lie one after the other in one feature matrix; each step of a
recursion handles the current position of every sequence still running, so the
number of numpy calls follows the longest sequence, not the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Crf:
    mean: np.ndarray  # of the training features, for scaling
    scale: np.ndarray
    emit: np.ndarray  # features x states
    bias: np.ndarray
    step: np.ndarray  # from state x to state
    first: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.emit + self.bias


def _order(lengths: np.ndarray):
    """Offsets of the sequences, longest first, and how many reach each step."""
    lengths = np.asarray(lengths, np.int64)
    begin = np.cumsum(lengths) - lengths
    by = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    running = np.searchsorted(-lengths[by], -np.arange(longest), side="left")
    return begin[by], lengths[by], running


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def marginals(e: np.ndarray, step: np.ndarray, first: np.ndarray, lengths: np.ndarray, pairs: bool = False):
    """Forward-backward: state probabilities of every row; with ``pairs`` also the
    expected transitions, first states and the sum of log partition values."""
    begin, size, running = _order(lengths)
    a, b = np.empty_like(e), np.zeros_like(e)
    for t, m in enumerate(running):
        at = begin[:m] + t
        a[at] = e[at] + (first if t == 0 else _lse(a[at - 1][:, :, None] + step, 1))
    for t in range(len(running) - 2, -1, -1):
        at = begin[:running[t + 1]] + t
        b[at] = _lse(step + (e[at + 1] + b[at + 1])[:, None, :], 2)
    full = size > 0
    log_z = _lse(a[(begin + size - 1)[full]], 1) if full.any() else np.zeros(0)
    z = np.empty(len(e))
    z_of = np.repeat(log_z, size[full])
    rows = np.concatenate([np.arange(s, s + n) for s, n in zip(begin[full], size[full])]) if full.any() else np.zeros(0, int)
    z[rows] = z_of
    p = np.exp(a + b - z[:, None])
    if not pairs:
        return p
    follows = np.ones(len(e), bool)
    follows[begin[full]] = False
    at = np.flatnonzero(follows)
    two = np.exp(a[at - 1][:, :, None] + step + (e[at] + b[at])[:, None, :] - z[at][:, None, None]).sum(0)
    return p, two, p[begin[full]].sum(0), log_z.sum()


def viterbi(e: np.ndarray, step: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best path of every sequence; ties to the lower state."""
    begin, size, running = _order(lengths)
    best, back = np.empty_like(e), np.zeros(e.shape, np.int64)
    for t, m in enumerate(running):
        at = begin[:m] + t
        if t == 0:
            best[at] = e[at] + first
        else:
            into = best[at - 1][:, :, None] + step
            back[at] = into.argmax(1)
            best[at] = e[at] + into.max(1)
    path = np.zeros(len(e), np.int64)
    full = size > 0
    last = (begin + size - 1)[full]
    path[last] = best[last].argmax(1)
    for t in range(len(running) - 2, -1, -1):
        at = begin[:running[t + 1]] + t
        path[at] = back[at + 1, path[at + 1]]
    return path


def fit(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, states: int = 2, l2: float = 1.0, rounds: int = 150,
        rate: float = 0.1, weights: np.ndarray | None = None) -> Crf:
    """Maximum likelihood with an l2 penalty, by Adam over all sequences.
    ``weights``: of each sequence's rows, 1 by default."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    lengths = np.asarray(lengths, np.int64)
    n = max(1, len(lengths))
    begin = np.cumsum(lengths) - lengths
    seen = np.eye(states)[y]
    follows = np.ones(len(y), bool)
    follows[begin[lengths > 0]] = False
    at = np.flatnonzero(follows)
    two = np.zeros((states, states))
    np.add.at(two, (y[at - 1], y[at]), 1)
    firsts = seen[begin[lengths > 0]].sum(0)
    theta = [np.zeros((x.shape[1], states)), np.zeros(states), np.zeros((states, states)), np.zeros(states)]
    m, v = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    for i in range(1, rounds + 1):
        p, expect, start, _ = marginals(z @ theta[0] + theta[1], theta[2], theta[3], lengths, pairs=True)
        miss = seen - p
        grads = [z.T @ miss, miss.sum(0), two - expect, firsts - start]
        for j, g in enumerate(grads):
            g = g / n - l2 * theta[j] / n
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.999 * v[j] + 0.001 * g * g
            theta[j] = theta[j] + rate * (m[j] / (1 - 0.9**i)) / (np.sqrt(v[j] / (1 - 0.999**i)) + 1e-8)
    return Crf(mean, scale, *theta)
