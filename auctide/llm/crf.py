"""Linear-chain conditional random fields in numpy: training, decoding, marginals.

Training and decoding work on padded batches of short sequences. Marginals of
texts of any length work on one chain that holds all texts of a batch, cut
into equal segments that advance side by side; a text start resets the chain.
"""

from __future__ import annotations

import numpy as np


def batch_marginals(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Padded ``scores (B, T, K)`` in log space -> unary marginals, expected transition counts, starts."""
    b, t, k = scores.shape
    live = np.arange(t)[None, :] < lengths[:, None]
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    m = np.exp(trans)
    fwd, scale = np.empty((t, b, k)), np.ones((t, b, 1))
    a = np.exp(start)[None, :] * e[:, 0]
    for i in range(t):
        if i:
            a = np.where(live[:, i, None], (fwd[i - 1] @ m) * e[:, i], fwd[i - 1])
        scale[i] = a.sum(axis=1, keepdims=True)
        fwd[i] = a = a / scale[i]
    bwd = np.ones((b, k))
    unary, pairs = np.empty((b, t, k)), np.zeros((k, k))
    for i in range(t - 1, -1, -1):
        u = fwd[i] * bwd
        unary[:, i] = u / u.sum(axis=1, keepdims=True) * live[:, i, None]
        if i:
            on = live[:, i, None]
            out = e[:, i] * bwd
            p = fwd[i - 1][:, :, None] * m[None] * out[:, None, :]
            p /= p.sum(axis=(1, 2), keepdims=True)
            pairs += (p * on[:, :, None]).sum(axis=0)
            nxt = out @ m.T
            bwd = np.where(on, nxt / nxt.sum(axis=1, keepdims=True), bwd)
    return unary, pairs, unary[:, 0].sum(axis=0)


def viterbi(scores: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best labels of one sequence ``scores (T, K)``; ties go to the smaller label."""
    t, k = scores.shape
    back = np.zeros((t, k), np.int8)
    rows, tr = scores.tolist(), trans.T.tolist()
    best = [s + r for s, r in zip(start.tolist(), rows[0])] if t else []
    for i in range(1, t):
        new = []
        for j in range(k):
            via = [b + w for b, w in zip(best, tr[j])]
            top = max(via)
            back[i, j] = via.index(top)
            new.append(top + rows[i][j])
        best = new
    out = np.zeros(t, np.int8)
    if t:
        out[-1] = best.index(max(best))
        for i in range(t - 1, 0, -1):
            out[i - 1] = back[i, out[i]]
    return out


def chain_marginals(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray,
                    segments: int = 1024) -> np.ndarray:
    """Forward-backward marginals of many sequences in one go.

    ``emit (N, K)``: positive potentials of all words of all sequences, one
    sequence after the other; ``first (N,)``: True where a sequence begins;
    ``trans``/``start``: positive potentials. The chain is cut into segments of
    equal length: their transfer matrices are built side by side, one scan over
    the segments links them, and a second pass side by side gives the messages.
    """
    n, k = emit.shape
    if not n:
        return np.zeros((0, k))
    s = max(1, min(segments, n // 16))
    length = -(-n // s)
    pad = s * length - n
    e = np.concatenate([emit, np.ones((pad, k))]).reshape(s, length, k)
    f = np.concatenate([first, np.ones(pad, bool)]).reshape(s, length)
    f[0, 0] = True
    # transfer matrix of every segment
    p = np.repeat(np.eye(k)[None], s, axis=0)
    for i in range(length):
        step = (p.reshape(-1, k) @ trans).reshape(s, k, k)
        r = f[:, i]
        if r.any():
            step[r] = p[r].sum(axis=2, keepdims=True) * start
        p = step * e[:, i, None, :]
        p /= p.sum(axis=(1, 2), keepdims=True)
    into, out = np.empty((s, k)), np.empty((s, k))
    v = np.ones(k) / k
    for j in range(s):
        into[j] = v
        v = v @ p[j]
        v = v / v.sum()
    w = np.ones(k)
    for j in range(s - 1, -1, -1):
        out[j] = w
        w = p[j] @ w
        w = w / w.sum()
    fwd = np.empty((length, s, k))
    a = into
    for i in range(length):
        r = f[:, i, None]
        a = np.where(r, a.sum(axis=1, keepdims=True) * start, a @ trans) * e[:, i]
        a = a / a.sum(axis=1, keepdims=True)
        fwd[i] = a
    b = out
    for i in range(length - 1, -1, -1):
        fwd[i] *= b
        x = e[:, i] * b
        b = np.where(f[:, i, None], (x @ start)[:, None], x @ trans.T)
        b = b / b.sum(axis=1, keepdims=True)
    post = fwd.transpose(1, 0, 2).reshape(-1, k)[:n]
    return post / post.sum(axis=1, keepdims=True)


class Adagrad:
    def __init__(self, rate: float):
        self.rate, self.sums = rate, {}

    def step(self, name: str, value: np.ndarray, grad: np.ndarray) -> None:
        s = self.sums.setdefault(name, np.full(value.shape, 1e-6))
        s += grad * grad
        value += self.rate * grad / np.sqrt(s)
