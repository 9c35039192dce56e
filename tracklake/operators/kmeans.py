"""k-means on whole numbers: the best of several starts, all fitted at once.

Standardised features become integers on a grid of 2^-16, and every sum is a
sum of integers, so neither partitions nor their order change a centre: a fit is
a function of the rows alone. The scaler statistics, sums of doubles, are rounded
to nine significant digits for the same reason. (In the fit alone, a component
further than 4,096 standard deviations out counts as that far.)

A start's first centres are the rows with the least hash of (id, start). One
Spark job is one Lloyd round of all starts that still move: a task adds up its
rows by start and nearest centre (ties: the first) and emits at most ``starts *
k`` rows, Spark sums these, and the driver gets one such table. A start settles
when its centres move by no more than ``kmeans_tol`` (squared, in all) or after
``kmeans_max_iter`` rounds. The points are checkpointed, so a lost executor
costs its part of a round only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.session import ensure_checkpoint_dir
from tracklake.settings import DEFAULT, FEATURE_COLS, Settings

#: Grid points in a unit, and the furthest one from the mean.
GRID, FURTHEST = 1 << 16, 1 << 28
#: Bits of the lower part of a cost, which travels in two parts.
LOW = 24

_POINT = [f"p{i}" for i in range(len(FEATURE_COLS))]


def nine_digits(x: float) -> float:
    return float(f"{x:.9g}")


def grid_points(features: DataFrame, means: list[float], scales: list[float]) -> DataFrame:
    """(scenario_id, p0..p5): standardised features as integers. Rows with a
    missing or NaN feature are no points."""
    whole = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in FEATURE_COLS]
    kept = features.where(reduce(and_, whole))

    def point(c: str, mean: float, scale: float):
        z = (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)
        far = F.lit(float(FURTHEST))
        return F.greatest(F.least(F.floor(F.greatest(F.least(z * float(GRID) + 0.5, far), -far)), F.lit(FURTHEST)), F.lit(-FURTHEST))

    cols = zip(_POINT, FEATURE_COLS, means, scales, strict=True)
    return kept.select("scenario_id", *[point(c, m, s).cast("long").alias(p) for p, c, m, s in cols])


def first_centres(points: DataFrame, k: int, settings: Settings = DEFAULT) -> np.ndarray:
    """(starts, k, 6): for each start the k points with the least hash."""
    parts = []
    for s in range(settings.kmeans_starts):
        draw = F.md5(F.concat(F.col("scenario_id"), F.lit(f":{settings.seed + s}")))
        rows = points.select(F.lit(s).alias("start"), draw.alias("draw"), *_POINT)
        parts.append(rows.orderBy("draw", *_POINT).limit(k))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    rows = sorted(every.collect())  # starts * k rows
    return np.array([list(r)[2:] for r in rows], np.int64).reshape(settings.kmeans_starts, -1, len(_POINT))


def _round(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """Rows and sums of the points nearest each centre, and the cost, of the
    starts given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((len(c), 3 + c.shape[1]), np.int64) for s, c in centres.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([col.to_numpy(zero_copy_only=False) for col in batch.columns], 1)
            for s, c in centres.items():
                d = np.zeros((len(x), len(c)), np.int64)
                for j in range(x.shape[1]):
                    apart = x[:, j : j + 1] - c[:, j]
                    d += apart * apart
                near = d.argmin(1)
                least = d[np.arange(len(x)), near]
                one = np.ones(len(x), np.int64)
                np.add.at(sums[s], near, np.column_stack([one, least >> LOW, least & ((1 << LOW) - 1), x]))
        for s, t in sums.items():
            at = np.flatnonzero(t[:, 0])
            cols = [pa.array(np.full(len(at), s, np.int32)), pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(t[at, j]) for j in range(t.shape[1]))], names=names)

    values = ["n", "high", "low", *_POINT]
    names = ["start", "centre", *values]
    schema = "start int, centre int, " + ", ".join(f"{v} long" for v in values)
    out = {s: (np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64), 0) for s, c in centres.items()}
    found = points.select(*_POINT).mapInArrow(run, schema).groupBy("start", "centre").agg(*[F.sum(v).alias(v) for v in values])
    for r in found.collect():  # starts * k rows at most
        n, sums, cost = out[r["start"]]
        n[r["centre"]], sums[r["centre"]] = r["n"], [r[p] for p in _POINT]
        out[r["start"]] = n, sums, cost + (r["high"] << LOW) + r["low"]
    return out


def lloyd(points: DataFrame, centres: np.ndarray, settings: Settings = DEFAULT) -> np.ndarray:
    """The settled centres (k, 6) of the start with the least cost (ties: the
    first). An empty cluster keeps its centre."""
    centres, moving = centres.copy(), list(range(len(centres)))
    enough = int(settings.kmeans_tol * GRID * GRID)
    for _ in range(settings.kmeans_max_iter):
        if not moving:
            break
        still = []
        for s, (n, sums, _) in _round(points, {s: centres[s] for s in moving}).items():
            n = n[:, None]
            # sum / n, rounded to the grid.
            new = np.where(n > 0, (2 * sums + n) // np.maximum(2 * n, 1), centres[s])
            moved = sum(int(v) ** 2 for v in (new - centres[s]).ravel())
            centres[s] = new
            if moved > enough:
                still.append(s)
        moving = still
    costs = _round(points, dict(enumerate(centres)))
    return centres[min(costs, key=lambda s: (costs[s][2], s))]


def fit(features: DataFrame, stats, scale_of, k: int, settings: Settings = DEFAULT) -> list[list[float]]:
    """k centres of the standardised features; ``stats`` is the row of scaler
    statistics and ``scale_of`` gives a column's scale from it."""
    ensure_checkpoint_dir(features.sparkSession)
    means = [nine_digits(stats[f"_mean_{c}"]) for c in FEATURE_COLS]
    scales = [nine_digits(scale_of(stats, c)) for c in FEATURE_COLS]
    points = grid_points(features, means, scales).checkpoint(eager=True)
    centres = lloyd(points, first_centres(points, k, settings), settings)
    return [[v / GRID for v in c] for c in centres.tolist()]
