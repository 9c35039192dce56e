"""The stored vector index against a scan of the whole table."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tracklake import sinks, versions
from tracklake.operators.similar import search_similar
from tracklake.operators.vector_index import MAX_CELLS, add_cells, choose_pivots
from tracklake.schemas import VECTORS
from tracklake.settings import DEFAULT
from tracklake.sources import warehouse as src

SMALL = DEFAULT.with_(vector_cell_rows=20)


def _row(i, vector, name=None):
    return (name or f"s{i:04d}", vector, 1.0, 2.0, -1.0, 3.0, 4, 0.5, i % 2 == 0, "none")


def _stored(spark, path, rows, settings=SMALL):
    table = spark.createDataFrame(rows, VECTORS)
    versions.replace(
        spark, path, lambda p: sinks.write_vector_cells(table, p, settings), layout="cells", id_buckets=settings.scenario_bucket_count
    )
    return table, src.read_vector_index(spark, path)


def _same(table, index, sid, k):
    want = [(r["scenario_id"], r["_distance"], r["vector"]) for r in search_similar(table, sid, k).collect()]
    got = [(r["scenario_id"], r["_distance"], r["vector"]) for r in index.search(sid, k).collect()]
    assert str(got) == str(want)


def _clustered(n, seed=0):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(8)]
    return [[x + rng.gauss(0, 0.02) for x in rng.choice(centres)] for _ in range(n)]


def test_search_equals_scan_and_reads_fewer_files(spark, tmpdir_path):
    rows = [_row(i, v) for i, v in enumerate(_clustered(400))]
    table, index = _stored(spark, f"{tmpdir_path}/v", rows)
    for sid, k in (("s0000", 1), ("s0007", 5), ("s0123", 60), ("s0399", 399), ("s0001", 1000)):
        _same(table, index, sid, k)
    files = index.manifest.count()
    assert files >= 15 and len(index.search("s0007", 5).inputFiles()) < files / 2
    assert index.manifest.agg(F.sum("rows")).first()[0] == 400
    whole = src.read_vectors(spark, f"{tmpdir_path}/v")
    assert whole.columns == VECTORS.fieldNames() and sorted(map(str, whole.collect())) == sorted(map(str, table.collect()))


def test_ties_and_copies(spark, tmpdir_path):
    """A third of the rows are copies of one vector, the others lie on a grid."""
    rows = [_row(i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]
    rows += [_row(60 + i, [float(i % 5), float(i // 5 % 5), 0.0, 0.0, 0.0, float(i // 25)]) for i in range(120)]
    table, index = _stored(spark, f"{tmpdir_path}/v", rows)
    for sid, k in (("s0003", 5), ("s0003", 59), ("s0003", 61), ("s0072", 4), ("s0100", 30)):
        _same(table, index, sid, k)


def test_odd_vectors(spark, tmpdir_path):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0], [None] * 6, [nan] + [0.0] * 5, [inf] + [0.0] * 5, [3e38] * 6, [0.0] * 7]
    rows = [_row(i, v) for i, v in enumerate(odd)] + [_row(10 + i, v) for i, v in enumerate(_clustered(50, 1))]
    rows.append(_row(99, [0.1] * 6))
    rows.append((None, [0.1] * 6, *rows[0][2:]))
    table, index = _stored(spark, f"{tmpdir_path}/v", rows)
    for sid in ("s0000", "s0001", "s0004", "s0005", "s0006", "s0012", "s0099"):
        for k in (1, 6, 100):
            _same(table, index, sid, k)
    with pytest.raises(ValueError, match="not found"):
        index.search("none", 3)


def test_empty_table_and_missing_index(spark, tmpdir_path):
    table, index = _stored(spark, f"{tmpdir_path}/v", [])
    assert src.read_vectors(spark, f"{tmpdir_path}/v").count() == 0
    with pytest.raises(ValueError, match="not found"):
        index.search("s0000", 3)
    sinks.write_vectors(table, f"{tmpdir_path}/plain")
    assert src.read_vector_index(spark, f"{tmpdir_path}/plain") is None
    assert src.optional_vectors(spark, f"{tmpdir_path}/none") is None


def test_pivots_depend_on_rows_alone(spark):
    table = spark.createDataFrame([_row(i, v) for i, v in enumerate(_clustered(100, 2))], VECTORS)
    assert choose_pivots(table.repartition(7), SMALL) == choose_pivots(table.coalesce(1), SMALL)
    assert len(choose_pivots(table, SMALL)) == 5 <= MAX_CELLS


def test_cells_are_found_as_arrays_and_equal_a_plain_search(spark):
    """Every row meets every pivot: as one array expression of Spark, evaluated
    row by row, that took most of the embed job's time."""
    odd = [None, [], [None] * 6, [float("nan")] + [0.0] * 5, [0.0] * 7]
    vectors = [*odd, *_clustered(600, 3), [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]]
    table = spark.createDataFrame([_row(i, v) for i, v in enumerate(vectors)], VECTORS).repartition(3)
    pivots = [list(r["vector"]) for r in table.where("scenario_id >= 's0005'").orderBy("scenario_id").limit(300).collect()]
    pivots += [[0.0] * 6, [1.0, 1.0, 0.0, 0.0, 0.0, 0.0], pivots[7]]  # equally near to the last row; a pivot twice
    out = add_cells(table, pivots)
    assert "transform(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == [*VECTORS.fieldNames(), "cell", "pivot_distance"]
    rows = out.collect()
    assert len(rows) == len(vectors)
    for r in rows:
        if r["scenario_id"] < "s0005":
            assert r["cell"] == -1 and r["pivot_distance"] is None
            continue
        squares = []
        for p in pivots:
            total = 0.0
            for x, y in zip(r["vector"], p, strict=True):
                total += (x - y) * (x - y)
            squares.append(total)
        assert (r["cell"], r["pivot_distance"]) == (squares.index(min(squares)), math.sqrt(min(squares)))
