"""A linear-chain conditional random field over sequences of sparse binary features."""

from __future__ import annotations

import numpy as np

Sequence = list[np.ndarray]  # feature numbers of each position


class ConditionalField:
    """Weights of (feature, label), of (label, next label) and of (first label); small enough to be broadcast."""

    def __init__(self, labels: int, features: int):
        self.labels, self.features = labels, features
        self.emit = np.zeros((features, labels), np.float32)
        self.move = np.zeros((labels, labels), np.float32)
        self.first = np.zeros(labels, np.float32)

    def _scores(self, run: list[Sequence]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(scores (sequence, position, label), mask, all feature numbers, their flat positions)."""
        width = max(len(s) for s in run)
        sizes = np.array([len(f) for s in run for f in s])
        place = np.array([i * width + j for i, s in enumerate(run) for j in range(len(s))])
        flat = np.concatenate([f for s in run for f in s]) if len(sizes) else np.zeros(0, np.int64)
        at = np.repeat(place, sizes)
        out = np.zeros((len(run) * width, self.labels), np.float64)
        for k in range(self.labels):
            out[:, k] = np.bincount(at, self.emit[flat, k], len(out))
        mask = np.zeros(len(run) * width, bool)
        mask[place] = True
        return out.reshape(len(run), width, -1), mask.reshape(len(run), width), flat, at

    def fit(self, sequences: list[Sequence], labels: list[list[int]], rounds: int = 8, batch: int = 256, rate: float = 0.25, shrink: float = 1e-5, seed: int = 5) -> ConditionalField:
        """Maximum likelihood by stochastic gradients with per-weight step sizes."""
        known = [i for i, s in enumerate(sequences) if len(s)]
        chance = np.random.default_rng(seed)
        squares = [np.full(w.shape, 1e-6) for w in (self.emit, self.move, self.first)]
        for _ in range(rounds):
            chance.shuffle(known)
            for lo in range(0, len(known), batch):
                part = known[lo : lo + batch]
                for weight, square, grad in zip((self.emit, self.move, self.first), squares, self._gradient([sequences[i] for i in part], [labels[i] for i in part])):
                    grad = grad / len(part) - shrink * weight
                    square += grad**2
                    weight += (rate * grad / np.sqrt(square)).astype(np.float32)
        return self

    def _gradient(self, run: list[Sequence], labels: list[list[int]]):
        e, mask, flat, at = self._scores(run)
        n, width, k = e.shape
        move = self.move.astype(np.float64)
        alpha = np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + self.first
        for t in range(1, width):
            a = alpha[:, t - 1, :, None] + move
            top = a.max(1)
            step = np.log(np.exp(a - top[:, None]).sum(1)) + top + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        beta = np.zeros_like(e)
        for t in range(width - 2, -1, -1):
            b = move + (beta[:, t + 1] + e[:, t + 1])[:, None, :]
            top = b.max(2)
            step = np.log(np.exp(b - top[:, :, None]).sum(2)) + top
            beta[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        top = alpha[:, -1].max(1)
        total = np.log(np.exp(alpha[:, -1] - top[:, None]).sum(1)) + top
        seen = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        truth = np.zeros_like(e)
        moves = np.zeros((k, k))
        for i, own in enumerate(labels):
            truth[i, np.arange(len(own)), own] = 1
            np.add.at(moves, (own[:-1], own[1:]), 1)
        for t in range(1, width):
            pair = alpha[:, t - 1, :, None] + move + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
            moves -= (np.exp(pair) * mask[:, t, None, None]).sum(0)
        rest = (truth - seen).reshape(n * width, k)
        emit = np.stack([np.bincount(flat, rest[at, j], self.features) for j in range(k)], 1)
        return emit, moves, (truth - seen)[:, 0].sum(0)

    def decode(self, sequences: list[Sequence], batch: int = 512) -> list[np.ndarray]:
        """The most likely labels of each sequence."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted((i for i, s in enumerate(sequences) if len(s)), key=lambda i: len(sequences[i]))
        for lo in range(0, len(order), batch):
            part = order[lo : lo + batch]
            e, mask, _, _ = self._scores([sequences[i] for i in part])
            n, width, k = e.shape
            best = e[:, 0] + self.first
            back = np.zeros((n, width, k), np.int64)
            for t in range(1, width):
                a = best[:, :, None] + self.move
                back[:, t] = np.where(mask[:, t, None], a.argmax(1), np.arange(k))
                best = np.where(mask[:, t, None], a.max(1) + e[:, t], best)
            label = best.argmax(1)
            path = np.zeros((n, width), np.int64)
            for t in range(width - 1, -1, -1):
                path[:, t] = label
                label = back[np.arange(n), t, label]
            for row, i in enumerate(part):
                out[i] = path[row, : len(sequences[i])]
        return out
