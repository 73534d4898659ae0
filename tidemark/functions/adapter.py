"""A low-rank correction of query vectors, q + (q A) B, fitted so that relevant documents come nearer than others.

The loss of a query is the negative logarithm of its relevant documents' share of a softmax over -distance^2 / temperature,
against its nearest wrong documents (found anew now and then) and random ones.  Only documents that the query may see count.
Vectors are dense matrices: a corpus that fits one machine, as fitting does not need more; scoring is a DataFrame job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Adapter:
    a: np.ndarray
    b: np.ndarray

    def __call__(self, q: np.ndarray) -> np.ndarray:
        return q + q @ self.a @ self.b


@dataclass(frozen=True)
class Options:
    rank: int = 16
    temperature: float = 0.05
    rate: float = 1e-3
    epochs: int = 60
    batch: int = 64
    hard: int = 16
    random: int = 16
    refresh: int = 5
    patience: int = 8
    seed: int = 7

    def __post_init__(self) -> None:
        if min(self.temperature, self.rate) <= 0 or min(self.rank, self.epochs, self.batch, self.refresh, self.patience) < 1:
            raise ValueError(f"options out of range: {self}")


@dataclass
class Questions:
    """Vectors, and matrices (queries x documents): what is relevant, and what may be seen."""

    vectors: np.ndarray
    relevant: np.ndarray
    visible: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        if self.visible is None:
            self.visible = np.ones_like(self.relevant)


def _distances(q: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return np.maximum((q**2).sum(1)[:, None] + (docs**2).sum(1)[None] - 2 * q @ docs.T, 0)


def reciprocal_rank(docs: np.ndarray, asked: Questions, adapter: Adapter | None = None, cut: int = 10) -> float:
    """Mean reciprocal rank of the first relevant document among those visible; equal distances go by position."""
    q = adapter(asked.vectors) if adapter else asked.vectors
    d = np.where(asked.visible, np.round(_distances(q, docs), 9), np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :cut]
    hit = np.take_along_axis(asked.relevant & asked.visible, order, 1)
    first = np.where(hit.any(1), hit.argmax(1), -1)
    return float(np.mean(np.where(first >= 0, 1 / np.maximum(first + 1.0, 1.0), 0.0)))


def fit(docs: np.ndarray, train: Questions, check: Questions, options: Options = Options()) -> tuple[Adapter, list[float]]:
    """The adapter that was best on ``check``, and its score there after each epoch (the first: without one)."""
    if not len(train.vectors) or not len(check.vectors) or not (train.relevant & train.visible).any(1).all():
        raise ValueError("every training question needs a visible relevant document, and there must be some to check with")
    rng = np.random.default_rng(options.seed)
    dim = docs.shape[1]
    adapter = Adapter(rng.normal(0, dim**-0.5, (dim, options.rank)), np.zeros((options.rank, dim)))
    wrong = train.visible & ~train.relevant
    best, scores, stale = Adapter(adapter.a.copy(), adapter.b.copy()), [reciprocal_rank(docs, check, adapter)], 0
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in vars(adapter).items()}
    step = 0
    near = np.zeros_like(wrong)
    for epoch in range(options.epochs):
        if epoch % options.refresh == 0:
            d = np.where(wrong, _distances(adapter(train.vectors), docs), np.inf)
            near = np.zeros_like(wrong)
            np.put_along_axis(near, np.argsort(d, axis=1)[:, : options.hard], True, axis=1)
            near &= wrong
        for rows in np.array_split(rng.permutation(len(train.vectors)), -(-len(train.vectors) // options.batch)):
            # random wrong documents by random keys: the smallest of each row
            keys = np.where(wrong[rows], rng.random((len(rows), len(docs))), 2.0)
            drawn = np.zeros_like(wrong[rows])
            np.put_along_axis(drawn, np.argsort(keys, axis=1)[:, : options.random], True, axis=1)
            right = (train.relevant & train.visible)[rows]
            used = right | near[rows] | (drawn & wrong[rows])
            base = train.vectors[rows]
            q = adapter(base)
            z = np.where(used, -_distances(q, docs) / options.temperature, -np.inf)
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            share = np.where(right, p, 0)
            slope = 2 / options.temperature * (p - share / np.maximum(share.sum(1, keepdims=True), 1e-300)) @ docs / len(rows)
            step += 1
            for name, grad in (("a", base.T @ (slope @ adapter.b.T)), ("b", (base @ adapter.a).T @ slope)):
                m, v = state[name] = (0.9 * state[name][0] + 0.1 * grad, 0.999 * state[name][1] + 0.001 * grad**2)
                getattr(adapter, name)[...] -= options.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        scores.append(reciprocal_rank(docs, check, adapter))
        if scores[-1] > max(scores[:-1]):
            best, stale = Adapter(adapter.a.copy(), adapter.b.copy()), 0
        else:
            stale += 1
            if stale >= options.patience:
                break
    return best, scores
