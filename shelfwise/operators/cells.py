"""Exact best-k pairing of two tables without a cross join.

Both sides are cut into pieces, and a grid of cells covers every combination of a left block and
a right strip once. A row travels to the cells of its block or strip under a plain integer key;
each cell is one task that first takes its left block into memory (bounded by the grid) and then
streams the right rows past it, keeping k best partners per left row. Pairs are never rows, and
what leaves a cell is at most k rows per left row.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F


@dataclass(frozen=True)
class Grid:
    blocks: int
    strips: int

    @property
    def cells(self) -> int:
        return self.blocks * self.strips


def plan_grid(
    n_left: int, n_right: int, left_bytes: float, right_bytes: float, k: int, width: int,
    work: float | None = None, max_block: int = 65_536,
    cell_work: float = 2e7, max_cell_work: float = 1e11,
) -> Grid:
    """Choose the grid that ships least.

    The right side is copied once per block; the left side and k results per left row are
    shipped once per strip. ``work`` is the cost of all cells, by default one per pair. ``width``
    tasks are used as soon as the work justifies it, more when a cell would otherwise exceed
    ``max_cell_work``. A block has at most ``max_block`` rows.
    """
    n_left, n_right = max(n_left, 1), max(n_right, 1)
    work = work or n_left * n_right
    wanted = max(width, math.ceil(work / max_cell_work))
    cells = max(1, min(int(work / cell_work), wanted))
    per_strip = n_left * (left_bytes + 24 * k)
    best = math.sqrt(n_right * cells * right_bytes / per_strip)
    fewest = math.ceil(n_left / max_block)
    strips = min(max(1, round(best)), max(1, cells // fewest))
    return Grid(max(math.ceil(cells / strips), fewest), strips)


class BestK:
    """The k best (score, partner) of each left row, by score descending and then partner id."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.scores = np.full((rows, k), -np.inf)
        self.partners = np.full((rows, k), np.iinfo(np.int64).max)
        self._waiting, self._n_waiting = [], 0

    def take(self, rows: np.ndarray, scores: np.ndarray, partners: np.ndarray) -> None:
        """Take in single pairs. They wait until there are half as many as the lists hold, so that lists are
        sorted seldom; until then a row's last score may be lower than what has been offered."""
        floor = self.scores[rows, -1]
        better = (scores > floor) | ((scores == floor) & (partners < self.partners[rows, -1]))
        if not better.all():
            rows, scores, partners = rows[better], scores[better], partners[better]
        if rows.size:
            self._waiting.append((rows, scores, partners))
            self._n_waiting += rows.size
            if self._n_waiting > max(100_000, self.scores.size // 2):
                self.settle()

    def settle(self) -> None:
        """Sort in the pairs that wait."""
        if not self._n_waiting:
            return
        row, values, ids = (np.concatenate(c) for c in zip(*self._waiting))
        self._waiting, self._n_waiting = [], 0
        touched = np.zeros(len(self.scores), bool)
        touched[row] = True
        touched = np.flatnonzero(touched)
        step = max(1, 2_000_000 // self.k)
        order = np.argsort(row, kind="stable")
        row, values, ids = row[order], values[order], ids[order]
        for some in (touched[i : i + step] for i in range(0, touched.size, step)):
            of = slice(*np.searchsorted(row, (some[0], some[-1] + 1)))
            self._merge(some, np.searchsorted(some, row[of]), values[of], ids[of])

    def _merge(self, touched: np.ndarray, row: np.ndarray, values: np.ndarray, ids: np.ndarray) -> None:
        """The best of the lists of ``touched`` and of further pairs, whose ``row`` counts among these."""
        by_row = np.argsort(row, kind="stable")
        row, values, ids = row[by_row], values[by_row], ids[by_row]
        count = np.bincount(row, minlength=touched.size)
        first = np.cumsum(count) - count
        # Rows of alike numbers of further pairs are sorted together, as rows of one width.
        by_count = np.argsort(count, kind="stable")
        for some in (by_count[i : i + 1024] for i in range(0, touched.size, 1024)):
            width, at = int(count[some[-1]]), touched[some]
            place = np.arange(width)
            given = place < count[some][:, None]
            source = np.where(given, first[some][:, None] + place, 0)
            scores = np.concatenate([self.scores[at], np.where(given, values[source], -np.inf)], axis=1)
            partners = np.concatenate(
                [self.partners[at], np.where(given, ids[source], np.iinfo(np.int64).max)], axis=1
            )
            self.scores[at], self.partners[at] = self._first(scores, partners)

    def _first(self, scores: np.ndarray, partners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k first of each row, by score descending and then partner id."""
        k = self.k
        order = np.argsort(-scores, axis=1)
        ranked = np.take_along_axis(scores, order[:, : k + 1], axis=1)
        ties = np.flatnonzero(((ranked[:, 1:] == ranked[:, :-1]) & (ranked[:, 1:] > -np.inf)).any(axis=1))
        order = order[:, :k]
        if ties.size:
            order[ties] = np.lexsort((partners[ties], -scores[ties]), axis=1)[:, :k]
        scores, partners = (np.take_along_axis(x, order, axis=1) for x in (scores, partners))
        partners[scores == -np.inf] = np.iinfo(np.int64).max
        return scores, partners

    def offer(self, scores: np.ndarray, partners: np.ndarray) -> None:
        """Take in a (rows x partners) score matrix; -inf marks pairs that do not count."""
        k = self.k
        floor = self.scores[:, -1:]
        better = (scores > floor) | (
            (scores == floor) & (scores > -np.inf) & (partners < self.partners[:, -1:])
        )
        if scores.shape[1] > k and np.count_nonzero(better) > 4 * scores.shape[0] * k:
            better &= scores >= np.partition(scores, -k, axis=1)[:, -k][:, None]
        touched = np.flatnonzero(better.any(axis=1))
        if not touched.size:
            return
        row, col = np.nonzero(better[touched])
        self._merge(touched, row, scores[touched[row], col], partners[col])

    def batch(self, left_ids: np.ndarray, some: slice = slice(None)) -> pa.RecordBatch:
        """The pairs of all lists or of some, in order."""
        self.settle()
        ids, scores, partners = left_ids[some], self.scores[some], self.partners[some]
        row, col = np.nonzero(scores > -np.inf)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[row]), pa.array(partners[row, col]), pa.array(scores[row, col])],
            names=["id", "pid", "r"],
        )


def best_pairs(
    left: DataFrame,
    right: DataFrame,
    grid: Grid,
    k: int,
    open_cell: Callable[[pa.Table], tuple[np.ndarray, Callable]],
    in_order_of: list[str],
    batch_rows: int = 1,
) -> DataFrame:
    """Run every cell and merge: columns ``id, pid, r``, at most ``k`` rows per ``id``.

    ``left`` and ``right`` share their columns, among them ``cell``. ``open_cell`` gets the left
    block and returns its ids and a function that offers right-side tables to a ``BestK``; the
    right rows come in the order of ``in_order_of``, ``batch_rows`` at a time at least, and rows
    that agree in the first of these columns are never torn apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, stream in _split_sides(batches):
            ids, offer = open_cell(block)
            best = BestK(ids.size, k)
            for table in _whole_groups(stream, in_order_of[0], batch_rows):
                offer(best, table)
            yield best.batch(ids)

    columns = left.columns
    sides = left.select(F.lit(0).alias("side"), *columns).unionByName(
        right.select(F.lit(1).alias("side"), *columns)
    )
    found = (
        sides.repartitionById(grid.cells, F.col("cell"))
        .sortWithinPartitions("side", *in_order_of)
        .drop("cell")
        .mapInArrow(run, "id long, pid long, r double")
    )
    return found if grid.strips == 1 else best_k(found, k)


def best_k(pairs: DataFrame, k: int) -> DataFrame:
    """At most k rows per id, by score and then partner id; tasks cut to k before the shuffle."""
    order = Window.partitionBy("id").orderBy(F.desc("r"), "pid")
    return pairs.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def _split_sides(batches):
    """The left block of the partition, and the right rows that follow it."""
    block, first = [], None
    batches = iter(batches)
    for batch in batches:
        n_left = int(np.searchsorted(batch.column("side").to_numpy(), 1))
        if n_left:
            block.append(batch.slice(0, n_left))
        if n_left < batch.num_rows:
            first = batch.slice(n_left)
            break
    if block and first is not None:
        yield pa.Table.from_batches(block), _chain(first, batches)


def _chain(first, rest):
    yield first
    yield from rest


def _whole_groups(batches, key, batch_rows):
    """Tables of at least ``batch_rows`` rows that end where the value of ``key`` changes."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < batch_rows:
            continue
        table = pa.Table.from_batches(held)
        values = table.column(key).to_numpy()
        end = int(np.searchsorted(values, values[-1]))
        if end:
            yield table.slice(0, end)
            held = table.slice(end).to_batches()
            rows -= end
    if held:
        yield pa.Table.from_batches(held)
