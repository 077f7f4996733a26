"""Gradients and curvatures of the losses.

``logistic``: a label of 0 or 1. ``squared``: any number. ``listwise``: of a list (a customer's offers) with
scores s, log(1 + sum over pairs of a clicked i and another j of exp(s_j - s_i)). That sum over pairs is a
product of two sums over rows, so gradients need no pairs, no order and no list in one place: two sums per list.
"""

from __future__ import annotations

import numpy as np

LOGISTIC, SQUARED, LISTWISE = "logistic", "squared", "listwise"
REACH = 30.0  # scores of lists are compared within this range


def list_sums(score: np.ndarray, label: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's part in the two sums of its list."""
    s = np.clip(score, -REACH, REACH)
    return (np.where(use & (label > 0), np.exp(-s), 0.0), np.where(use & (label <= 0), np.exp(s), 0.0))


def listwise(score: np.ndarray, label: np.ndarray, clicked: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of each row, from the two sums of its list."""
    s = np.clip(score, -REACH, REACH)
    whole = 1.0 + clicked * others
    share = np.where(label > 0, np.exp(-s) * others, np.exp(s) * clicked) / whole
    return np.where(label > 0, -share, share), share * (1.0 - share)


def gradients(objective: str, score: np.ndarray, block, lists: dict) -> tuple[np.ndarray, np.ndarray]:
    label = block.label
    if objective == LOGISTIC:
        p = 1 / (1 + np.exp(-score))
        return p - label, p * (1 - p)
    if objective == SQUARED:
        return score - label, np.ones(len(score))
    # held-out lists take no part, so the sums are those of the rows that teach
    a, b = list_sums(score, label, ~block.held)
    new = np.concatenate([[True], np.diff(block.list) != 0])
    starts = np.flatnonzero(new)
    sums = [np.add.reduceat(x, starts) for x in (a, b)]
    names = block.list[starts]
    for k in np.flatnonzero(np.isin(names, np.fromiter(lists, np.int64, len(lists)))).tolist():
        sums[0][k], sums[1][k] = lists[int(names[k])]
    at = np.cumsum(new) - 1
    return listwise(score, label, sums[0][at], sums[1][at])
