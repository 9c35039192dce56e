"""Exact nearest neighbours over vectors stored in cells around pivots.

Pivots are distinct vectors of the table, the first by hash. A row lies in the
cell of its nearest pivot, and a cell's files hold disjoint ranges of the distance
to it (``pivot_distance``), whatever the size of the cell. A manifest has a row a
file: its pivot, its rows, and its ``near`` and ``far`` distance. By the triangle
inequality no row of a file is nearer to a query q than
``max(near - d(q, pivot), d(q, pivot) - far)``.

A search reads files in the order of that bound, those of near pivots first
among equals, until they hold k rows besides the query, which gives a distance that the k-th neighbour does not exceed, then
all files whose bound is not above it. The result equals that of a whole scan,
ties included.

Rows whose vector is null, or has another length or components that are null or
not finite, lie in cell -1, which every search reads; a search for such a row
reads all files. Equal vectors lie in one cell, as ranges of ids.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions import bucket_value
from tracklake.operators.similar import nearest
from tracklake.operators.space import V_COLS
from tracklake.settings import DEFAULT, Settings

#: Cells at most: every row is compared with each pivot. A larger table has
#: larger cells, read by their ranges of distances.
MAX_CELLS = 1024
#: Rows that a task compares with the pivots at a time.
ROWS = 256
#: Cell of the rows that have no distance.
NO_CELL = -1
#: Room for rounding in a bound, relative to the distances it is made of.
SLACK = 1e-9


def usable(vector: str = "vector") -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == len(V_COLS)) & finite, F.lit(False))


def choose_pivots(vectors: DataFrame, settings: Settings = DEFAULT) -> list[list[float]]:
    """One pivot for every ``vector_cell_rows`` rows, at most ``MAX_CELLS``."""
    good = vectors.where(usable()).select("vector")
    n = min(MAX_CELLS, math.ceil(good.count() / settings.vector_cell_rows))
    # Hash first, then the components: one order for any partitioning.
    rows = good.distinct().orderBy(F.xxhash64("vector"), *[F.col("vector")[i] for i in range(len(V_COLS))]).limit(n)
    return [list(r["vector"]) for r in rows.collect()]


def add_cells(vectors: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """Add ``cell`` (ties to the lower number) and ``pivot_distance``. A task
    compares ``ROWS`` rows with all pivots at a time, as arrays."""
    if not pivots:
        return vectors.select("*", F.lit(NO_CELL).alias("cell"), F.lit(None).cast("double").alias("pivot_distance"))
    centres, names = np.array(pivots, "<f8"), [*vectors.columns, "cell", "pivot_distance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                good = np.array(batch.column(batch.num_columns - 2).to_pylist(), bool)
                flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
                rows = flat.astype("<f8").reshape(-1, centres.shape[1])
                squares = np.zeros((len(rows), len(centres)))
                for i in range(centres.shape[1]):
                    d = rows[:, i, None] - centres[:, i]
                    squares += d * d
                cell, far = np.full(len(good), NO_CELL, "<i4"), np.zeros(len(good))
                cell[good] = best = squares.argmin(axis=1)
                far[good] = np.sqrt(squares[np.arange(len(rows)), best])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-2], pa.array(cell, pa.int32()), pa.array(far, pa.float64(), mask=~good)], names=names
                )

    schema = T.StructType([*vectors.schema, T.StructField("cell", T.IntegerType()), T.StructField("pivot_distance", T.DoubleType())])
    return vectors.select("*", usable(), F.when(usable(), F.col("vector"))).mapInArrow(run, schema)


def file_manifest(cells: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """One row a file of a written table: ``file`` (below the table's folder),
    cell, rows, near, far, pivot; from the cell and the distance alone."""
    path = F.element_at(F.split(F.col("_metadata.file_path"), "/cells/"), -1)
    files = cells.groupBy(path.alias("file"), "cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("pivot_distance").alias("near"), F.max("pivot_distance").alias("far")
    )
    listed = cells.sparkSession.createDataFrame(list(enumerate(pivots)), "cell int, pivot array<double>")
    return files.join(F.broadcast(listed), "cell", "left").select("file", "cell", "rows", "near", "far", "pivot")


@dataclass(frozen=True)
class VectorIndex:
    """A stored table: its ``manifest``, its ``ids`` (scenario_id and vector, in
    folders of ``id_bucket``, ``buckets`` of them) and a reader of named files.
    The driver holds the manifest, a row a file."""

    manifest: DataFrame
    ids: DataFrame
    buckets: int
    read: Callable[[list[str]], DataFrame]

    def vector_of(self, scenario_id: str) -> list[float] | None:
        """The vector of an id, from its bucket's folder alone; raises
        ``ValueError`` when the id is not in the table."""
        bucket = bucket_value(scenario_id, self.buckets)
        row = self.ids.where((F.col("id_bucket") == bucket) & (F.col("scenario_id") == scenario_id)).select("vector").first()
        if row is None:
            raise ValueError(f"Scenario {scenario_id} not found")
        return row["vector"]

    def bounds(self, q: list[float]) -> list[tuple[float, float, str, int]]:
        """(bound, distance to the pivot, file, rows) of each file, in this order."""
        out = []
        for f in self.manifest.collect():
            bound = d = 0.0
            if f["pivot"] is not None:
                d = math.dist(q, f["pivot"])
                bound = max(0.0, max(f["near"] - d, d - f["far"]) - SLACK * (1 + d + f["far"]))
            out.append((bound, d, f["file"], f["rows"]))
        return sorted(out)

    def search(self, scenario_id: str, k: int = 5) -> DataFrame:
        """As ``search_similar`` of the whole table."""
        q = self.vector_of(scenario_id)
        every = [r["file"] for r in self.manifest.select("file").collect()]
        if k < 1 or q is None or len(q) != len(V_COLS) or not all(x is not None and math.isfinite(x) for x in q):
            return nearest(self.read(every), scenario_id, q, k)
        ordered, first, held = self.bounds(q), [], 0
        for _, _, file, rows in ordered:
            first.append(file)
            held += rows
            if held > k:
                break
        found = nearest(self.read(first), scenario_id, q, k)
        seen = found.agg(F.count(F.lit(1)).alias("n"), F.max("_distance").alias("far")).first()
        if seen["n"] < k or seen["far"] is None or not math.isfinite(seen["far"]):
            return nearest(self.read(every), scenario_id, q, k)
        limit = math.sqrt(seen["far"])
        return nearest(self.read([f for bound, _, f, _ in ordered if bound <= limit]), scenario_id, q, k)
