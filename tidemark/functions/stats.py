"""Exact and resampling tests, in plain Python: their inputs are a handful of numbers per decision."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence


def fisher_exact(agree: int, total: int, other_agree: int, other_total: int) -> float:
    """Two-sided p-value of two shares: the probability of tables no likelier than the one seen; 1 if either is empty."""
    if total == 0 or other_total == 0:
        return 1.0
    hits, everyone = agree + other_agree, total + other_total
    most, few = min(hits, total), max(0, hits + total - everyone)
    ln = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    likely = [ln(hits, k) + ln(everyone - hits, total - k) - ln(everyone, total) for k in range(few, most + 1)]
    # what ties with the table seen must not depend on rounding
    return min(1.0, math.fsum(math.exp(x) for x in likely if x <= likely[agree - few] + 1e-7))


def sign_flip(differences: Sequence[float], seed: int = 0, exact_up_to: int = 12, rounds: int = 10_000) -> tuple[float, float]:
    """One-sided p-values of the sum's being this low, and this high, when every sign is a coin's: over all assignments of signs
    for few differences, else over that many drawn ones besides the assignment seen."""
    import numpy as np

    size = np.abs(np.asarray(differences, float))
    if not len(size):
        return 1.0, 1.0
    if len(size) <= exact_up_to:
        heads = np.arange(2 ** len(size))[:, None] >> np.arange(len(size)) & 1
    else:
        drawn = np.random.default_rng(seed).integers(0, 2, (rounds, len(size)))
        heads = np.concatenate([np.asarray(differences)[None] > 0, drawn])
    # twice the positive part less all: what ties with the sum seen must not depend on rounding
    gain, seen = heads @ size, size[np.asarray(differences) > 0].sum()
    close = 1e-9 * size.sum()
    return float((gain <= seen + close).mean()), float((gain >= seen - close).mean())


def holm(p: Sequence[float]) -> list[float]:
    """Step-down adjusted p-values, in the order given."""
    import numpy as np

    p = np.asarray(p, float)
    place = np.argsort(np.argsort(p, kind="stable"), kind="stable")
    scaled = np.sort(p) * np.arange(len(p), 0, -1)
    return np.minimum(1.0, np.maximum.accumulate(scaled))[place].tolist() if len(p) else []


def merged_regions(pairs: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Unions of overlapping or touching intervals, ascending: a union ends where as many have ended as begun."""
    marks = sorted([(low, 0) for low, _ in pairs] + [(high, 1) for _, high in pairs])
    depth = list(itertools.accumulate(1 - 2 * end for _, end in marks))
    ends = [k for k, d in enumerate(depth) if d == 0]
    return [(marks[first][0], marks[last][0]) for first, last in zip([0, *(k + 1 for k in ends)], ends, strict=False)]
