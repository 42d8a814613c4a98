"""Linear-chain conditional random fields over two or more labels, on numpy."""

from __future__ import annotations

import numpy as np


def forward_backward(unary: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Marginals of each position. ``unary`` (n, k) and ``steps`` (n - 1, k, k) are potentials, not logs.

    ``steps[i]`` stands between positions i and i + 1; what lies between them
    may already be summed out of it.
    """
    n, k = unary.shape
    ahead, back = np.empty((n, k)), np.empty((n, k))
    now = unary[0]
    ahead[0] = now / now.sum()
    for i in range(1, n):
        now = (ahead[i - 1] @ steps[i - 1]) * unary[i]
        ahead[i] = now / now.sum()
    back[-1] = 1
    for i in range(n - 2, -1, -1):
        now = steps[i] @ (unary[i + 1] * back[i + 1])
        back[i] = now / now.sum()
    both = ahead * back
    return both / both.sum(axis=1, keepdims=True)


class Gap:
    """The summed-out potential of a run of positions that all look alike.

    ``step`` is the transition matrix, ``plain`` the unary potential of such a
    position. A run of g of them between two others is (step diag(plain))^g
    step, whatever g: it comes from the eigenvalues, scaled by the largest.
    """

    def __init__(self, step: np.ndarray, plain: np.ndarray):
        self.step = step
        values, vectors = np.linalg.eig(step * plain)
        top = np.argmax(np.abs(values))
        self.values = values / values[top]
        self.left, self.right = vectors, np.linalg.inv(vectors)

    def __call__(self, runs: np.ndarray) -> np.ndarray:
        powers = self.values[None, :] ** np.asarray(runs, float)[:, None]
        inside = (self.left[None] * powers[:, None, :]) @ self.right
        return np.maximum((inside @ self.step).real, 1e-300)


def fit_windows(
    classes: np.ndarray, labels: np.ndarray, n_classes: int, steps: int = 150, ridge: float = 1e-2
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (classes, 2) and transitions (2, 2) of a two-label chain from windows of equal width.

    Maximum conditional likelihood by gradient ascent with momentum; gradients
    are observed minus expected counts from batched forward-backward.
    """
    n, width = classes.shape
    unary, trans = np.zeros((n_classes, 2)), np.zeros((2, 2))
    if not n:
        return unary, trans
    one = np.eye(2)[labels]
    seen_u = np.zeros_like(unary)
    np.add.at(seen_u, (classes.ravel(), labels.ravel()), 1)
    seen_t = np.zeros((2, 2))
    np.add.at(seen_t, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
    often = np.maximum(seen_u.sum(axis=1, keepdims=True), 1)
    speed_u, speed_t = np.zeros_like(unary), np.zeros_like(trans)
    for _ in range(steps):
        u, t = np.exp(unary)[classes], np.exp(trans)
        ahead, back = np.empty_like(one), np.empty_like(one)
        ahead[:, 0] = u[:, 0]
        for i in range(1, width):
            now = (ahead[:, i - 1] @ t) * u[:, i]
            ahead[:, i] = now / now.sum(axis=1, keepdims=True)
        back[:, -1] = 1
        for i in range(width - 2, -1, -1):
            now = (u[:, i + 1] * back[:, i + 1]) @ t.T
            back[:, i] = now / now.sum(axis=1, keepdims=True)
        marginal = ahead * back
        marginal /= marginal.sum(axis=2, keepdims=True)
        pair = ahead[:, :-1, :, None] * t * (u[:, 1:] * back[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        expected = np.zeros_like(unary)
        np.add.at(expected, classes.ravel(), marginal.reshape(-1, 2))
        # Scaled by how often a class is seen, so that rare words learn as fast.
        speed_u = 0.9 * speed_u + (seen_u - expected) / often - ridge * unary
        speed_t = 0.9 * speed_t + (seen_t - pair.sum(axis=(0, 1))) / seen_t.sum() - ridge * trans
        unary += 0.5 * speed_u
        trans += 0.5 * speed_t
    return unary, trans
