"""Banded edit distance (insert, delete, replace, swap neighbours) of many pairs at once."""

from __future__ import annotations

import numpy as np


def _codes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(t) for t in texts], dtype="int64")
    out = np.zeros((len(texts), width), dtype="int32")
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le"), dtype="<i4")
    return out, size


def banded(a: list[str], b: list[str], k: int) -> np.ndarray:
    """Distances of a[i] and b[i], with k + 1 for anything above k; only the 2k+1 diagonals around the main one are filled."""
    n = len(a)
    if not n:
        return np.empty(0, "int64")
    width = max(1, max(map(len, a)), max(map(len, b)))
    x, m = _codes(a, width)
    y, l = _codes(b, width)  # noqa: E741
    big, span = k + 1, 2 * k + 1
    rows = np.arange(n)
    result = np.full(n, big, dtype="int64")
    # band[:, d] is the cell (i, j = i + d - k)
    before = np.full((n, span), big, dtype="int64")
    now = np.full((n, span), big, dtype="int64")
    for d in range(span):
        if d - k >= 0:
            now[:, d] = d - k
    done = m == 0
    result[done] = np.minimum(l[done], big)
    for i in range(1, width + 1):
        older, before = before, now
        now = np.full((n, span), big, dtype="int64")
        for d in range(span):
            j = i + d - k
            if j < 0 or j > width:
                continue
            if j == 0:
                now[:, d] = min(i, big)
                continue
            best = before[:, d] + (x[:, i - 1] != y[:, j - 1])
            if d + 1 < span:
                best = np.minimum(best, before[:, d + 1] + 1)
            if d > 0:
                best = np.minimum(best, now[:, d - 1] + 1)
            if i > 1 and j > 1:
                swap = (x[:, i - 1] == y[:, j - 2]) & (x[:, i - 2] == y[:, j - 1])
                best = np.where(swap, np.minimum(best, older[:, d] + 1), best)
            now[:, d] = np.minimum(best, big)
        at = m == i
        if at.any():
            col = l - i + k
            ok = at & (col >= 0) & (col < span)
            result[ok] = now[rows[ok], col[ok]]
    return np.minimum(result, big)
