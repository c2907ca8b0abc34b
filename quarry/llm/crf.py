"""A linear-chain conditional random field with two labels over binary features."""

from __future__ import annotations

import numpy as np


class Chain:
    """Feature, transition and start weights; label 1 is what is looked for."""

    def __init__(self, features: int):
        self.unary = np.zeros((features, 2))
        self.step = np.zeros((2, 2))
        self.start = np.zeros(2)

    def scores(self, active: list[list[int]]) -> np.ndarray:
        """Label scores of a sequence of blocks, each a list of active features."""
        return np.array([self.unary[f].sum(0) for f in active]).reshape(-1, 2)

    def decode(self, active: list[list[int]]) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not active:
            return []
        score = self.scores(active)
        best, back = score[0] + self.start, []
        for s in score[1:]:
            both = best[:, None] + self.step
            back.append(both.argmax(0))
            best = both.max(0) + s
        out = [int(best.argmax())]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]

    def fit(self, pages: list[tuple[list[list[int]], list[int]]], l2: float = 2e-4, rounds: int = 200, rate: float = 0.2) -> Chain:
        """Maximize the conditional log-likelihood (forward-backward, Adam steps on all pages)."""
        pages = [p for p in pages if p[0]]
        n, length, size = len(pages), max(len(p[0]) for p in pages), len(self.unary)
        x = np.zeros((n, length, size), np.float32)
        y = np.zeros((n, length), int)
        live = np.zeros((n, length), bool)
        for k, (active, labels) in enumerate(pages):
            for t, f in enumerate(active):
                x[k, t, f] = 1
            y[k, :len(labels)] = labels
            live[k, :len(labels)] = True
        truth = np.eye(2)[y] * live[:, :, None]
        pair_live = live[:, 1:]
        true_step = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
        true_unary = x.reshape(-1, size).T @ truth.reshape(-1, 2).astype(np.float32)
        true_start = truth[:, 0].sum(0)
        params = [self.unary, self.step, self.start]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for k in range(1, rounds + 1):
            score = (x @ self.unary.astype(np.float32)).astype(np.float64)
            fwd, bwd = np.zeros((n, length, 2)), np.zeros((n, length, 2))
            fwd[:, 0] = score[:, 0] + self.start
            for t in range(1, length):
                nxt = np.logaddexp.reduce(fwd[:, t - 1, :, None] + self.step, axis=1) + score[:, t]
                fwd[:, t] = np.where(live[:, t, None], nxt, fwd[:, t - 1])
            for t in range(length - 2, -1, -1):
                nxt = np.logaddexp.reduce(self.step + (score[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
                bwd[:, t] = np.where(live[:, t + 1, None], nxt, 0)
            total = np.logaddexp.reduce(fwd[:, -1], axis=1)
            prob = np.exp(fwd + bwd - total[:, None, None]) * live[:, :, None]
            pair = fwd[:, :-1, :, None] + self.step + (score[:, 1:] + bwd[:, 1:])[:, :, None, :] - total[:, None, None, None]
            pair = np.exp(np.where(pair_live[:, :, None, None], pair, -np.inf))
            grads = [true_unary - x.reshape(-1, size).T @ prob.reshape(-1, 2).astype(np.float32), true_step - pair.sum((0, 1)), true_start - prob[:, 0].sum(0)]
            for i, (p, g) in enumerate(zip(params, grads, strict=True)):
                g = g / n - l2 * p
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p += rate * (m[i] / (1 - 0.9 ** k)) / (np.sqrt(v[i] / (1 - 0.999 ** k)) + 1e-8)
        return self
