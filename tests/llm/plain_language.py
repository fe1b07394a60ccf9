"""Interpolated Kneser-Ney of one language's whole counts, in arrays: what the tables of Spark must say."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from roadpulse.llm.language import ORDER, _discount, _hashes, _points


class Level(NamedTuple):
    """One order of a model: grams and contexts as sorted hashes, with log-probability and log-backoff."""

    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_backoff: np.ndarray


class Model(NamedTuple):
    """Levels from order 1 up, the log-probability of a letter never met, and the mean and deviation
    of the characters' surprise in the training text."""

    levels: list[Level]
    log_unseen: float
    mean: float
    deviation: float


def estimate(counts: dict[str, int], alphabet: int) -> Model:
    """Interpolated Kneser-Ney: the highest order from counts, lower orders from the number of distinct
    characters before a gram, each discounted by n1 / (n1 + 2 n2) of its own counts."""
    points = _points(list(counts), ORDER)
    times = np.fromiter(counts.values(), np.float64, len(counts))
    spelled, before = _hashes(points), [np.zeros(len(points), np.uint64), *_hashes(points[:, :-1])]
    levels: list[Level] = []
    tables = []
    rows, weight = np.arange(len(points)), times
    for order in range(ORDER, 0, -1):  # one row for each distinct gram of the order
        if order < ORDER:
            _, first, back = np.unique(spelled[order - 1][rows], return_index=True, return_inverse=True)
            weight, rows = np.bincount(back).astype(np.float64), rows[first]
        tables.append((order, rows, weight))
    lower, floor = None, 1.0 / (alphabet + 1)
    for order, rows, weight in reversed(tables):
        ones, twos = (weight == 1).sum(), (weight == 2).sum()
        discount = _discount(ones, twos)
        contexts, back = np.unique(before[order - 1][rows], return_inverse=True)
        total, kinds = np.bincount(back, weight), np.bincount(back)
        backoff = discount * kinds / total
        if lower is None:
            shorter = np.full(len(rows), floor)
        else:
            shorter = np.exp(lower.log_p[np.searchsorted(lower.grams, spelled[order - 2][rows])])
        p = np.maximum(weight - discount, 0) / total[back] + backoff[back] * shorter
        names = spelled[order - 1][rows]
        sort = np.argsort(names)
        lower = Level(names[sort], np.log(p[sort]), contexts, np.log(backoff))
        levels.append(lower)
    surprise = -levels[-1].log_p[np.searchsorted(levels[-1].grams, spelled[-1])]
    mean = float(np.average(surprise, weights=times))
    return Model(levels, float(np.log(floor)), mean, float(np.sqrt(np.average((surprise - mean) ** 2, weights=times))))


def _found(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return at, names[at] == wanted


def log_likelihood(model: Model, spelled: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
    """Of each character, by the longest gram that the model knows, backing off from longer ones."""
    out = np.full(len(spelled[0]), model.log_unseen)
    left, off = np.arange(len(out)), np.zeros(len(out))
    for order in range(ORDER, 0, -1):
        level = model.levels[order - 1]
        at, known = _found(level.grams, spelled[order - 1][left])
        out[left[known]] = off[known] + level.log_p[at[known]]
        left, off = left[~known], off[~known]
        at, known = _found(level.contexts, before[order - 1][left])
        off = off + np.where(known, level.log_backoff[at], 0.0)
    out[left] = off + model.log_unseen
    return out
