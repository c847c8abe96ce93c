"""Dot products of two sets of vectors, scored in single precision first and exactly where it matters.

A product of unit rows in single precision is off by less than a known bound. Pairs that stay below a
row's floor by more than that cannot enter its list; only the others are scored as doubles. So the
lists are those of doubles, while nearly all pairs cost a product and a comparison of floats.
"""

from typing import NamedTuple

import numpy as np

from shelfwise.operators.cells import BestK

#: Columns scored at once, at most, and pairs: a matrix that stays near the processor.
COLUMNS, PAIRS = 1024, 1 << 18
#: Pairs scored as doubles in one step, and the share of all from which on all are.
EXACT_PAIRS, DENSE = 100_000, 1 / 16
#: Scores below this are too close to the smallest number for bounds in proportion.
LEAST_SCALE = 1e-280


#: Of rows with one id, which lie on both sides, the first of the left or of the right side meets none
#: of the others. Where ids are keys both are the same.
LEFT, RIGHT = "left", "right"


class Rule(NamedTuple):
    """Which pairs of one id do not count, if any, and how a score is rounded."""

    same: str | None
    single: bool = False
    digits: int | None = None

    def finished(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores as they rank, and whether they count: only positive ones do."""
        if self.single:
            with np.errstate(over="ignore"):
                scores = scores.astype(np.float32).astype(np.float64)
        counts = scores > 0
        return (scores if self.digits is None else np.round(scores, self.digits)), counts


class Side(NamedTuple):
    """Ids and vectors with their lengths; ``small`` are the vectors over the greatest length, as floats."""

    ids: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray
    small: np.ndarray
    longest: float
    order: np.ndarray

    def first(self, ids: np.ndarray) -> np.ndarray:
        """The row of the first vector with each of ``ids``, -1 where there is none."""
        at = self.order[np.searchsorted(self.ids, ids, sorter=self.order).clip(max=self.ids.size - 1)]
        return np.where(self.ids[at] == ids, at, -1)


def side(ids: np.ndarray, vectors: np.ndarray, unit_rows: bool) -> Side:
    """``unit_rows`` scales each vector by its own length, for the left side of products."""
    with np.errstate(all="ignore"):
        lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        longest = float(lengths.max(initial=0.0))
        by = np.where(lengths > 0, lengths, 1.0)[:, None] if unit_rows else (longest or 1.0)
        small = (vectors / by).astype(np.float32)
    return Side(ids, vectors, lengths, small, longest, np.argsort(ids))


def offer_products(best: BestK, at: int, left: Side, rows: np.ndarray, right: Side, rule: Rule, floor: np.ndarray) -> None:
    """Offer the scores of ``rows`` of the left side, which is at row ``at`` of ``best``, with all of
    the right side. ``floor`` is a score per left row that its answers reach."""
    step = PAIRS // max(1, min(right.ids.size, COLUMNS))
    for i in range(0, rows.size, step):
        for j in range(0, right.ids.size, COLUMNS):
            _offer(best, at, left, rows[i : i + step], right, slice(j, j + COLUMNS), rule, floor)


def _offer(best, at, left, rows, right, part, rule, floor):
    scale = left.lengths[rows] * right.longest
    if not (np.isfinite(scale).all() and scale.min() > LEAST_SCALE):
        return _offer_all(best, at, left, rows, right, part, rule)
    off = (left.vectors.shape[1] + 16) * 2.0**-23
    reached = np.maximum(floor[rows], best.scores[at + rows, -1])
    if rule.digits is not None:
        reached = reached - 0.51 * 10.0**-rule.digits
    least = (np.maximum(reached, 0.0) / scale - off).astype(np.float32)
    scores = left.small[rows] @ right.small[part].T
    near = scores > least[:, None]
    row, col = _set(near)
    if row.size > DENSE * near.size:
        return _offer_all(best, at, left, rows, right, part, rule)
    ids = right.ids[part][col]
    if rule.same:
        mine = rows[row]
        own = left.ids[mine] == ids
        if own.any():
            at_own = np.flatnonzero(own)
            mine, ids_own, col_own = mine[at_own], ids[at_own], part.start + col[at_own]
            own[at_own] = left.first(ids_own) == mine if rule.same == LEFT else right.first(ids_own) == col_own
        other = np.flatnonzero(~own)
        row, col, ids = row[other], col[other], ids[other]
    if not row.size:
        return
    which, vectors, exact = rows[row], right.vectors[part], np.empty(row.size)
    for k in range(0, row.size, EXACT_PAIRS):
        some = slice(k, k + EXACT_PAIRS)
        exact[some] = np.einsum("ij,ij->i", left.vectors[which[some]], vectors[col[some]])
    exact, counts = rule.finished(exact)
    best.take(at + which[counts], exact[counts], ids[counts])


def _set(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the flags that are set; few are, so eight are looked at together."""
    flat = flags.reshape(-1)
    whole = flat.size // 8 * 8
    eights = np.flatnonzero(flat[:whole].view(np.uint64) != 0)
    inner = np.flatnonzero(flat[:whole].reshape(-1, 8)[eights])
    found = np.concatenate([eights[inner >> 3] * 8 + (inner & 7), whole + np.flatnonzero(flat[whole:])])
    row = found // flags.shape[1]
    return row, found - row * flags.shape[1]


def _offer_all(best, at, left, rows, right, part, rule):
    """Score all pairs as doubles: before lists are filled, and where bounds do not apply."""
    scores = all_scores(left, rows, right, part, rule)
    best.settle()
    some = BestK(0, best.k)
    some.scores, some.partners = best.scores[at + rows], best.partners[at + rows]
    some.offer(scores, right.ids[part])
    best.scores[at + rows], best.partners[at + rows] = some.scores, some.partners


def all_scores(left: Side, rows: np.ndarray, right: Side, part: slice, rule: Rule) -> np.ndarray:
    """The scores of ``rows`` with a part of the right side; -inf marks pairs that do not count."""
    ids = right.ids[part]
    with np.errstate(all="ignore"):
        scores = left.vectors[rows] @ right.vectors[part].T
    scores, counts = rule.finished(scores)
    if rule.same:
        if rule.same == LEFT:
            first = left.first(ids)
            slot = np.searchsorted(rows, first).clip(max=rows.size - 1)
            own = np.flatnonzero((first >= 0) & (rows[slot] == first))
            counts[slot[own], own] = False
        else:
            slot = right.first(left.ids[rows]) - part.start
            own = np.flatnonzero((slot >= 0) & (slot < ids.size))
            counts[own, slot[own]] = False
    return np.where(counts, scores, -np.inf)
