"""Hashed linear models: features of a text and their fit.

A text's features are its distinct words (lower case, outer punctuation off) and
their beginnings of ``STEMS`` characters, which inflected forms share, and
optionally the distinct shapes of its raw tokens, each hashed to one of
``DIMS`` cells. Models are logistic, fitted by AdaGrad with a soft threshold that
sets the weights of uninformative cells to zero.
"""

from __future__ import annotations

import re
import zlib

import numpy as np

DIMS = 1 << 18
STEMS = (4, 5, 6)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
#: Tokens whose cells a worker keeps; the memory stays with the worker when it is idle.
#: Of cells with a weight most tokens have none, so that more are kept.
_CACHE_TOKENS, _CACHE_WEIGHED = 100_000, 300_000


def _shape(c: str) -> str:
    return "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c


_SHAPES = {i: _shape(chr(i)) for i in range(128)}


class Cells(dict):
    """raw token -> cells of its word and, if asked for, of its shape; with ``weights``
    only those whose weight is not zero, which are all that a margin needs. Memory is
    bounded: the cache starts again when it is full."""

    def __init__(self, shapes: bool, weights: np.ndarray | None = None):
        super().__init__()
        self.shapes = shapes
        self.counts = None if weights is None else (weights[:DIMS] != 0).tobytes()

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= (_CACHE_TOKENS if self.counts is None else _CACHE_WEIGHED):
            self.clear()
        word = _EDGE.sub("", token.lower())
        parts = [word] + [f"{n} {word[:n]}" for n in STEMS if len(word) > n] if word else []
        cells = tuple(zlib.crc32(x.encode()) % DIMS for x in parts)
        if self.shapes:
            shape = token.translate(_SHAPES) if token.isascii() else "".join(map(_shape, token))
            shape = re.sub(r"(.)\1+", r"\1\1", shape)
            cells += (zlib.crc32(("shape " + shape).encode()) % DIMS,)
        if self.counts is not None:
            cells = tuple([c for c in cells if self.counts[c]])
        self[token] = cells
        return cells

    def of(self, text: str) -> np.ndarray:
        """Distinct cells of ``text``, ascending."""
        found: set[int] = set()
        for cells in map(self.__getitem__, set(text.split())):
            found.update(cells)
        out = np.fromiter(found, dtype=np.int64, count=len(found))
        out.sort()
        return out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit(rows: list[np.ndarray], target: np.ndarray, extra: np.ndarray, epochs: int = 8, steps: int = 600,
        rate: float = 0.3, penalty: float = 0.03, seed: int = 7) -> np.ndarray:
    """Weights: DIMS cells, one for each column of ``extra``, the bias. ``target``
    may be a probability. Without rows, or with one class, only the bias speaks.

    A small sample is passed over more often, for ``steps`` steps at least, and
    its soft threshold is higher (``penalty`` over the root of its size)."""
    n, k = len(rows), extra.shape[1]
    w = np.zeros(DIMS + k + 1)
    share = (float(np.sum(target)) + 0.5) / (n + 1.0)
    w[-1] = np.log(share / (1.0 - share))
    if n == 0 or np.ptp(target) == 0:
        return w
    batch = max(16, min(256, n // 40))
    epochs = max(epochs, -(-steps * batch // n))
    l1 = penalty / np.sqrt(n)
    squares = np.full_like(w, 1e-6)
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            ids = order[at:at + batch]
            sizes = np.array([len(rows[i]) for i in ids])
            cells = np.concatenate([rows[i] for i in ids])
            owner = np.repeat(np.arange(len(ids)), sizes)
            margin = np.bincount(owner, weights=w[cells], minlength=len(ids)) + extra[ids] @ w[DIMS:DIMS + k] + w[-1]
            error = (sigmoid(margin) - target[ids]) / len(ids)
            touched, where = np.unique(cells, return_inverse=True)
            grad = np.bincount(where, weights=error[owner])
            squares[touched] += grad * grad
            step = rate / np.sqrt(squares[touched])
            new = w[touched] - step * grad
            w[touched] = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0.0)
            tail = np.append(extra[ids].T @ error, error.sum())
            squares[DIMS:] += tail * tail
            w[DIMS:] -= rate / np.sqrt(squares[DIMS:]) * tail
    return w


def margin(w: np.ndarray, cells: np.ndarray, extra=()) -> float:
    return float(w[cells].sum() + np.dot(w[DIMS:-1], extra) + w[-1])
