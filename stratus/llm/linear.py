"""A sparse logistic model over hashed features, fitted on a bounded sample.

The sample is gathered on the driver (its row bound is a parameter of the
operators) as packed feature ids, and fitted by an accelerated proximal
gradient method in a diagonal metric.  Scoring is a column function.
"""

import zlib

import numpy as np

from .common import ship

ship(__name__)

DIMENSIONS = 1 << 18


def hashed(words) -> np.ndarray:
    """Distinct feature ids of an iterable of byte strings."""
    return np.unique(np.fromiter(map(zlib.crc32, words), dtype=np.uint32) & np.uint32(DIMENSIONS - 1)).astype(np.int32)


def fit(rows: list[np.ndarray], target: np.ndarray, l1: float, pairs: list[tuple] = (), pair_weight: float = 0.0,
        min_rows: int = 5, steps: int = 250) -> tuple[np.ndarray, float]:
    """(weights by feature id, intercept) minimising the mean logistic loss on soft targets
    + ``l1`` * |w| + ``pair_weight`` * mean squared score change over ``pairs``.

    A pair is (ids only in the original, ids only in its counterfactual, how often).  Features in
    fewer than ``min_rows`` rows get no weight.  Without both classes only the intercept is fitted.
    """
    n, weights = len(rows), np.zeros(DIMENSIONS)
    positive = float(target.sum())
    bias = float(np.log((positive + 0.1) / (n - positive + 0.9)))
    if n == 0 or positive < 0.5 or n - positive < 0.5:
        return weights, bias
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    ids = np.concatenate(rows) if len(at) else np.zeros(0, dtype=np.int32)
    seen = np.bincount(ids, minlength=DIMENSIONS)
    keep = np.flatnonzero(seen >= min_rows)
    for a, b, _ in pairs:  # both sides of a swap keep their weights
        keep = np.union1d(keep, np.concatenate([a, b]))
    if not len(keep):
        return weights, bias
    column = np.full(DIMENSIONS, -1)
    column[keep] = np.arange(len(keep))
    used = column[ids] >= 0
    at, col, d = at[used], column[ids[used]], len(keep)
    nnz = np.bincount(at, minlength=n) + 1
    curve = 0.25 / n * np.bincount(col, weights=nnz[at].astype(float), minlength=d) + 1e-6
    curve_bias = 0.25 * nnz.mean()
    if pairs:
        p_at = np.concatenate([np.full(len(a) + len(b), i) for i, (a, b, _) in enumerate(pairs)])
        p_col = column[np.concatenate([np.concatenate([a, b]) for a, b, _ in pairs])]
        p_sign = np.concatenate([np.concatenate([np.ones(len(a)), -np.ones(len(b))]) for a, b, _ in pairs])
        share = np.array([c for _, _, c in pairs], dtype=float)
        share /= share.sum()
        p_nnz = np.bincount(p_at, minlength=len(pairs))
        curve += 2 * pair_weight * np.bincount(p_col, weights=share[p_at] * p_nnz[p_at], minlength=d)
    w, v, bv, b, t = np.zeros(d), np.zeros(d), bias, bias, 1.0
    for _ in range(steps):
        z = np.bincount(at, weights=v[col], minlength=n) + bv
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / n
        grad = np.bincount(col, weights=err[at], minlength=d)
        if pairs:
            change = np.bincount(p_at, weights=p_sign * v[p_col], minlength=len(share))
            grad += 2 * pair_weight * np.bincount(p_col, weights=p_sign * (share * change)[p_at], minlength=d)
        new = v - grad / curve
        new = np.sign(new) * np.maximum(np.abs(new) - l1 / curve, 0)
        new_b = bv - err.sum() / curve_bias
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, bv = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    weights[keep] = w
    return weights, float(b)


def score(weights: np.ndarray, bias: float, ids: np.ndarray) -> float:
    z = float(weights[ids].sum()) + bias
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
