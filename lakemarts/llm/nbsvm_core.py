"""Character n-gram features and the linear model scaled by naive Bayes
log-count ratios (no Spark here; see ``toxicity.py``)."""

from __future__ import annotations

import numpy as np

NGRAMS = (4, 6)
HASH_BITS = 18
#: Occurrences in a text from which a bucket's two features are on.
LEVELS = (1, 3)
#: Features in all.
SIZE = len(LEVELS) << HASH_BITS
#: Characters featurised at a time, so that memory does not grow with a text.
CHUNK = 1 << 18
_MULTIPLIERS = {4: np.uint64(0x9E3779B97F4A7C15), 6: np.uint64(0xC2B2AE3D27D4EB4F)}


def features(text: str | None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Sorted features of a text: its lower-cased character 4- and 6-grams,
    hashed to buckets, one feature for each of ``LEVELS`` that the bucket's
    number of occurrences reaches.  With ``wanted`` (a boolean per bucket)
    other buckets are left out.  Null or empty text: none."""
    if not text:
        return np.empty(0, dtype=np.int32)
    ids, counts = [], []
    overlap = max(NGRAMS) - 1
    for at in range(0, len(text), CHUNK):
        # a space stands for either end; an n-gram belongs to the chunk in which it starts
        piece = (" " if at == 0 else "") + text[at : at + CHUNK + overlap]
        piece += " " if at + CHUNK + overlap >= len(text) else ""
        own = CHUNK + (at == 0) if at + CHUNK < len(text) else len(piece)
        chars = np.frombuffer(piece.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        for n in NGRAMS:
            if len(chars) < n:
                continue
            h = chars[: len(chars) - n + 1].copy()
            for k in range(1, n):
                h *= np.uint64(1000003)
                h ^= chars[k : len(chars) - n + 1 + k]
            h = h[:own] * _MULTIPLIERS[n]
            b = (h >> np.uint64(64 - HASH_BITS)).astype(np.int32)
            if wanted is not None:
                b = b[wanted[b]]
            some, times = np.unique(b, return_counts=True)
            ids.append(some)
            counts.append(times)
    ids, back = np.unique(np.concatenate(ids or [np.empty(0, np.int32)]), return_inverse=True)
    total = np.bincount(back, np.concatenate(counts), len(ids)) if len(ids) else np.empty(0)
    return np.concatenate([ids[total >= n] + (i << HASH_BITS) for i, n in enumerate(LEVELS)]).astype(np.int32)


def ratios(held: np.ndarray, n0: int, n1: int, alpha: float = 1.0, z: float = 3.5, most: int = 20_000) -> np.ndarray:
    """Log-count ratio of every feature from ``held[label, feature]``, the
    number of rows of either label that have it: the log of the share of
    positive rows over the share of negative ones.  Features whose ratio is
    under ``z`` standard errors say nothing and get 0; of more than ``most``
    others the clearest stay."""
    p, q = held[1] + alpha, held[0] + alpha
    r = np.log(p / (n1 + 2 * alpha)) - np.log(q / (n0 + 2 * alpha))
    error = np.sqrt(np.maximum(1 / p - 1 / (n1 + 2 * alpha) + 1 / q - 1 / (n0 + 2 * alpha), 1e-12))
    clear = np.abs(r) / error
    used = np.argsort(-clear, kind="stable")[:most]
    out = np.zeros(len(r))
    used = used[clear[used] > z]
    out[used] = r[used]
    return out


def prior(n0: int, n1: int, alpha: float = 1.0) -> float:
    """Log odds of label 1, smoothed towards label 0 where there are no rows."""
    return float(np.log((n1 + alpha) / (n0 + 2 * alpha)))


def fit(rows: list[np.ndarray], labels: np.ndarray, r: np.ndarray, ridge: float = 0.1, steps: int = 150,
        rate: float = 0.02) -> tuple[np.ndarray, float]:
    """Weights per feature and the intercept: logistic regression on the
    features scaled by their ratios ``r``, so a feature's weight is w * r.
    One class only, or no row: zero weights and the prior as intercept."""
    n1 = int(labels.sum())
    n0 = len(labels) - n1
    used = np.flatnonzero(r)
    if not n1 or not n0 or not len(used):
        return np.zeros(len(r)), prior(n0, n1)
    column = np.full(len(r), -1, dtype=np.int64)
    column[used] = np.arange(len(used))
    cols = [c[c >= 0] for c in (column[row] for row in rows)]
    doc = np.repeat(np.arange(len(rows)), [len(c) for c in cols])
    col = np.concatenate(cols)
    scale = r[used][col]
    w = np.zeros(len(used) + 1)  # the last one is the intercept
    w[-1] = prior(n0, n1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        margin = np.bincount(doc, scale * w[col], len(rows)) + w[-1]
        miss = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels
        slope = np.append(np.bincount(col, scale * miss[doc], len(used)) + ridge * w[:-1], miss.sum())
        # Adam: steps of one size for rare and frequent features
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros(len(r))
    weights[used] = w[:-1] * r[used]
    return weights, float(w[-1])


def score(row: np.ndarray, weights: np.ndarray, bias: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(weights[row].sum() + bias, -35, 35))))
