"""Hashed character n-grams of texts, and linear support vector machines on them."""

from __future__ import annotations

import numpy as np

#: Buckets of hashed n-grams of one to three bytes.
BUCKETS = 4096
#: Bytes of a text that are hashed at once.
CHUNK = 1 << 20
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def ngram_counts(data: bytes) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text's bytes, A-Z in lower case; long texts in overlapping chunks."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(1, len(data)), CHUNK):
        x = _LOWER[np.frombuffer(data, np.uint8, min(CHUNK + 2, len(data) - at), at)]
        one, two = x[:CHUNK], (x[:-1] * np.uint32(257) + x[1:])[:CHUNK]
        three = (x[:-2] * np.uint32(66049) + x[1:-1] * np.uint32(257) + x[2:])[:CHUNK] if len(x) > 2 else x[:0]
        for n, gram in ((1, one), (2, two), (3, three)):
            mixed = (gram + np.uint32(n * 0x9E3779)) * np.uint32(0x85EBCA6B)
            out += np.bincount((mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return out


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of counts, at unit length."""
    root = np.sqrt(counts.astype(np.float32))
    return root / np.maximum(1e-9, np.linalg.norm(root, axis=-1, keepdims=True))


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss; ``y`` is -1 or 1.

    Newton steps on the active rows, each solved by conjugate gradients; both classes weigh the same. The
    result depends on the rows only, not on their order beyond rounding.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * cost * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        if not on.any():
            break
        a, c = x[on], weight[on]
        gradient = w - 2 * a.T @ (c * y[on] * slack[on])
        step, r = np.zeros_like(w), -gradient
        p, rr = r.copy(), r @ r
        if rr < 1e-10:
            break
        for _ in range(40):
            ap = p + 2 * a.T @ (c * (a @ p))
            k = rr / (p @ ap)
            step += k * p
            r -= k * ap
            new = r @ r
            if new < 1e-8 * (gradient @ gradient):
                break
            p, rr = r + new / rr * p, new
        loss = lambda v: 0.5 * v @ v + (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        if size <= 1e-4:
            break
        w = w + size * step
    return w.astype(np.float32)
