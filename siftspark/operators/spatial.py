"""Points of two tables within a distance of each other, in cells that follow the density.

An octree is built on the driver from a bounded sample: cells with many points are split, down to the width of the cutoff.
So where points are sparse a cell is wide, and few points lie near its border. Each point of the larger table lies in one leaf; a point of
the smaller one goes to every leaf that its reach touches, which for leaves no narrower than the cutoff are those of 27 places
around it. Leaves that stay crowded are split by number: their points are dealt to parts on both sides, and each pair
of parts is a key of the join. The tree only decides on balance: without a sample the result would be the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.session import find_package

AXES = "xyz"
SEED = 42
#: Cells are numbered by whole numbers, so levels end where these would lose their last digits.
MOST_LEVELS = 30


def _hashed(cells: np.ndarray) -> np.ndarray:
    """One number for each cell (level, x, y, z). Cells that share a number only meet needlessly."""
    h = np.zeros(len(cells), np.uint64)
    for column in cells.T:
        h = (h ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


class Octree:
    """The cells of a sample of points that are split, by level, and in how many parts crowded leaves are dealt."""

    def __init__(self, sample: np.ndarray, side: np.ndarray, share: tuple[float, float], cutoff: float, most: int) -> None:
        self.cutoff = cutoff * (1 + 1e-9)
        extent = float((sample.max(0) - sample.min(0)).max()) if len(sample) else 0.0
        self.levels = min(MOST_LEVELS, max(0, ceil(log2(max(extent / self.cutoff, 1.0)))))
        self.split: list[np.ndarray] = []
        weight = np.where(side == 0, *share)
        at = np.arange(len(sample))
        for level in range(self.levels):
            key = self._keys(sample[at], level)
            cells, place = np.unique(key, return_inverse=True)
            crowded = np.bincount(place, weight[at], len(cells)) > most
            self.split.append(cells[crowded])
            at = at[crowded[place]]
            if not len(at):
                break
        leaf = self.leaves(sample)
        cells, place = np.unique(leaf, return_inverse=True)
        counts = [np.bincount(place, np.where(side == s, weight, 0.0), len(cells)) for s in (0, 1)]
        parts = [np.maximum(1, np.ceil(c / most)).astype(np.int32) for c in counts]
        several = (parts[0] > 1) | (parts[1] > 1)
        self.crowded, self.parts = cells[several], [p[several] for p in parts]

    def _keys(self, points: np.ndarray, level: int) -> np.ndarray:
        width = self.cutoff * 2.0 ** (self.levels - level)
        return _hashed(np.column_stack([np.full(len(points), level), np.floor(points / width)]))

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out = self._keys(points, 0)
        at = np.arange(len(points))
        for level, split in enumerate(self.split):
            at = at[np.isin(out[at], split)]
            if not len(at):
                break
            out[at] = self._keys(points[at], level + 1)
        return out

    def reached(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the point, leaf): each leaf within the cutoff of a point once."""
        steps = np.array(np.meshgrid(*[[-1, 0, 1]] * 3)).reshape(3, -1).T * self.cutoff
        leaf = np.sort(np.stack([self.leaves(points + s) for s in steps], axis=1), axis=1)
        new = np.ones(leaf.shape, bool)
        new[:, 1:] = leaf[:, 1:] != leaf[:, :-1]
        row, column = np.nonzero(new)
        return row, leaf[row, column]

    def parts_of(self, leaf: np.ndarray, side: int) -> np.ndarray:
        """In how many parts the points of a side are dealt in each leaf."""
        if not len(self.crowded):
            return np.ones(len(leaf), np.int64)
        at = np.minimum(np.searchsorted(self.crowded, leaf), len(self.crowded) - 1)
        return np.where(self.crowded[at] == leaf, self.parts[side][at], 1).astype(np.int64)


def _sample(points: DataFrame, n: int, wanted: int) -> tuple[np.ndarray, float]:
    """About so many of the points, and how many each stands for."""
    share = min(1.0, wanted / max(1, n))
    # Twice the wanted number is a bound that a draw by hash does not reach.
    rows = points.filter(F.pmod(F.xxhash64(F.lit(SEED), *AXES), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(*AXES).limit(2 * wanted + 1000).toArrow()
    found = np.column_stack([rows.column(c).to_numpy() for c in AXES]) if rows.num_rows else np.zeros((0, 3))
    return found, n / max(1, len(found))


def _dealt(points: DataFrame, tree: Octree, side: int, halo: bool, prefix: str) -> DataFrame:
    """The points with the keys that they meet under: leaf, part of this side, part of the other."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in AXES])
            row, leaf = tree.reached(places) if halo else (np.arange(len(places)), tree.leaves(places))
            own, other = tree.parts_of(leaf, side), tree.parts_of(leaf, 1 - side)
            part = (_hashed(places.view(np.int64)).view(np.uint64)[row] % own.astype(np.uint64)).astype(np.int64)
            row, leaf, part = np.repeat(row, other), np.repeat(leaf, other), np.repeat(part, other)
            against = np.arange(len(row)) - np.repeat(np.cumsum(other) - other, other)
            parts = (part, against) if side == 0 else (against, part)
            chosen = batch.select(["id", *AXES]).take(pa.array(row))
            yield pa.record_batch([pa.array(leaf), *(pa.array(p.astype(np.int32)) for p in parts), *chosen.columns], names=["_leaf", "_p0", "_p1", *names])

    names = [prefix, *(f"{prefix}{c}" for c in AXES)]
    kind = points.schema["id"].dataType.simpleString()
    return points.mapInArrow(deal, f"_leaf bigint, _p0 int, _p1 int, {prefix} {kind}, " + ", ".join(f"{prefix}{c} double" for c in AXES))


def within(donors: DataFrame, acceptors: DataFrame, cutoff: float, most: int = 5_000, sample: int = 100_000) -> DataFrame:
    """(d, a, distance) of points (id, x, y, z) of the two tables within the cutoff; points without a place have none.

    ``most``: points of one table that should lie in a cell, or in one part of a crowded one; ``sample``: points that the tree is built from.
    """
    find_package(donors.sparkSession)
    placed = lambda df: df.select("id", *[F.col(c).cast("double").alias(c) for c in AXES]).filter(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in AXES))
    sides = [placed(donors), placed(acceptors)]
    counts = [s.count() for s in sides]
    drawn = [_sample(s, n, sample // 2) for s, n in zip(sides, counts, strict=True)]
    side = np.repeat([0, 1], [len(x) for x, _ in drawn])
    tree = Octree(np.concatenate([x for x, _ in drawn]), side, (drawn[0][1], drawn[1][1]), cutoff, most)
    smaller = 0 if counts[0] <= counts[1] else 1
    d, a = (_dealt(s, tree, k, k == smaller, p) for k, (s, p) in enumerate(zip(sides, "da", strict=True)))
    square = sum((F.col(f"d{c}") - F.col(f"a{c}")) * (F.col(f"d{c}") - F.col(f"a{c}")) for c in AXES)
    met = d.join(a, ["_leaf", "_p0", "_p1"]).withColumn("_q", square)
    return met.filter(F.col("_q") <= cutoff * cutoff).select("d", "a", F.sqrt("_q").alias("distance"))
