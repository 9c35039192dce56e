"""Exact near-duplicate join of vectors in a metric space (operator 9).

Vectors of one label are put on the unit sphere, where cosine ``c`` is the
distance ``sqrt(2 - 2c)``. Pivots partition them: a vector lives in the cell of
its nearest pivot. It is also sent to every lower cell that may hold a partner:
by the triangle inequality its distance to that pivot is at most the cell's
radius plus the range, and it lies at most the range behind the plane between
the two pivots. Each pair meets in exactly one cell, the lower one of the two,
and cells join independently, in blocks of at most ``BLOCK`` rows a side.

Equal vectors of a label are one vector with a weight. The pivots are at most
``PIVOTS`` vectors picked by hash; their choice decides the work and not the
links. Cosines are computed in double precision.

Results on odd input: a null vector or label, a zero vector and one with null
or non-finite components link with nothing and keep themselves; vectors of
different length do not link; rows with equal vec_id are vectors of their own;
an empty table gives an empty one. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.llm.common import find_package_on_workers, map_rows, materialize
from tracklake.llm.components import connected

#: Vectors a pivot, most pivots of all labels together, and rows of a block.
CELL, PIVOTS, BLOCK = 2048, 2048, 2048


def usable(vec: str = "embedding") -> Column:
    """Not null, finite in every component, and not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vec).isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _unit(rows: list) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    # Scaled first, so that no square of a component overflows or vanishes.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def pick_pivots(vectors: DataFrame) -> dict:
    """(label, length) -> unit pivots; at most about ``PIVOTS`` in all."""
    n = max(vectors.count(), 1)
    rate = min(1.0 / CELL, 0.8 * PIVOTS / n)
    picked = vectors.where(F.pmod(F.xxhash64("label", "vector"), F.lit(1 << 40)) < F.lit(int(rate * (1 << 40))))
    by: dict = {}
    for r in picked.orderBy("node").limit(PIVOTS).collect():
        by.setdefault((r["label"], len(r["vector"])), []).append(r["vector"])
    return {k: _unit(v) for k, v in by.items()}


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ p.T), 0))


def home_cells(vectors: DataFrame, pivots: dict) -> DataFrame:
    """Add ``home``, the number of the nearest pivot, and its distance ``near``."""

    def make():
        def apply(labels, rows):
            home, near = [0] * len(rows), [0.0] * len(rows)
            by: dict = {}
            for i, (k, v) in enumerate(zip(labels, rows, strict=True)):
                if (k, len(v)) in pivots:
                    by.setdefault((k, len(v)), []).append(i)
            for key, at in by.items():
                d = _distances(_unit([rows[i] for i in at]), pivots[key])
                least = d.argmin(1)
                for i, h, r in zip(at, least.tolist(), d[np.arange(len(at)), least].tolist(), strict=True):
                    home[i], near[i] = h, r
            return home, near

        return apply

    return map_rows(vectors, ["label", "vector"], [("home", T.IntegerType(), pa.int32()), ("near", T.DoubleType(), pa.float64())], make, 2048)


def boundary_cells(homes: DataFrame, pivots: dict, radii: dict, reach: float) -> DataFrame:
    """Add ``others``: the lower cells that may hold a partner of the vector."""
    slack = 1e-9  # for rounding of the distances

    def make():
        def apply(labels, rows, home):
            out: list[list[int]] = [[] for _ in rows]
            by: dict = {}
            for i, (k, v, h) in enumerate(zip(labels, rows, home, strict=True)):
                if h > 0:
                    by.setdefault((k, len(v)), []).append(i)
            for key, at in by.items():
                p, r = pivots[key], radii[key]
                between = _distances(p, p)
                d = _distances(_unit([rows[i] for i in at]), p)
                for i, di in zip(at, d, strict=True):
                    h = home[i]
                    in_ball = di[:h] <= r[:h] + reach + slack
                    in_slab = di[:h] ** 2 - di[h] ** 2 <= 2 * (reach + slack) * between[h, :h] + slack
                    out[i] = np.flatnonzero(in_ball & in_slab).tolist()
            return (out,)

        return apply

    return map_rows(homes, ["label", "vector", "home"], [("others", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], make, 2048)


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        side, nodes = table.column("side").to_numpy(), table.column("node").to_numpy()
        weights, rows = table.column("weight").to_numpy(), table.column("vector").to_pylist()
        order = np.lexsort((nodes, side))
        nodes, weights = nodes[order], weights[order]
        x = np.asarray([rows[i] for i in order], np.float64)
        length = np.sqrt((x * x).sum(1))
        split = int((side == 0).sum())
        within = bool(table.column("within")[0].as_py())
        root, links = list(range(len(nodes))), np.zeros(len(nodes), np.int64)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        first = 0 if within else split
        for lo in range(0, split, 512):
            hi = min(lo + 512, split)
            cosine = (x[lo:hi] @ x[first:].T) / (length[lo:hi, None] * length[None, first:])
            near = cosine >= threshold
            if within:
                near[np.arange(hi - lo), np.arange(lo, hi)] = False
            links[lo:hi] += near @ weights[first:]
            if not within:
                links[first:] += weights[lo:hi] @ near
            for i in np.flatnonzero(near.any(1)).tolist():
                for j in np.flatnonzero(near[i]).tolist():
                    a, b = find(lo + i), find(first + j)
                    if a != b:
                        root[max(a, b)] = min(a, b)
        at = np.flatnonzero(links)
        roots = nodes[[find(i) for i in at.tolist()]] if len(at) else nodes[:0]
        return pa.table({"node": pa.array(nodes[at]), "links": pa.array(links[at]), "root": pa.array(roots)})

    return run


def join_cells(reach_cells: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) of the vectors that link within each block pair."""
    cell = ["label", "length", "cell"]
    inner = reach_cells.select("label", "length", F.col("home").alias("cell"), F.lit(True).alias("inner"), "node", "weight", "vector")
    outer = reach_cells.select("label", "length", F.explode("others").alias("cell"), F.lit(False).alias("inner"), "node", "weight", "vector")
    rows = inner.unionAll(outer)
    counts = rows.groupBy(*cell).agg(F.count_if("inner").alias("n_in"), F.count_if(~F.col("inner")).alias("n_out"))
    parts = counts.select(
        *cell, F.ceil(F.col("n_in") / BLOCK).cast("int").alias("k_in"), F.ceil(F.col("n_out") / BLOCK).cast("int").alias("k_out")
    )
    placed = rows.join(parts, cell).where("k_in > 0").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.when(F.col("inner"), F.col("k_in")).otherwise(F.col("k_out"))).cast("int")
    )
    own = F.col("own")

    def job(within, x, y, side):
        return F.struct(F.lit(within).alias("within"), x.cast("int").alias("x"), y.cast("int").alias("y"), side.cast("int").alias("side"))

    to_inner = F.transform(
        F.sequence(F.lit(0), F.col("k_in") - 1), lambda b: job(True, F.least(own, b), F.greatest(own, b), F.lit(0))
    )
    to_outer = F.when(F.col("k_out") > 0, F.transform(F.sequence(F.lit(0), F.col("k_out") - 1), lambda b: job(False, own, b, F.lit(0))))
    from_outer = F.transform(F.sequence(F.lit(0), F.col("k_in") - 1), lambda a: job(False, a, own, F.lit(1)))
    none = F.array().cast("array<struct<within:boolean,x:int,y:int,side:int>>")
    jobs = F.when(F.col("inner"), F.concat(to_inner, F.coalesce(to_outer, none))).otherwise(from_outer)
    # Blocks x < y of one cell meet as two sides, as inner and outer vectors do.
    dealt = placed.withColumn("job", F.explode(jobs)).select(
        *cell, F.col("job.within").alias("inside"), F.col("job.x").alias("x"), F.col("job.y").alias("y"), "node", "weight", "vector",
        F.when(F.col("job.within") & (F.col("job.x") < F.col("job.y")), (own == F.col("job.y")).cast("int")).otherwise(F.col("job.side")).alias("side"),
        (F.col("job.within") & (F.col("job.x") == F.col("job.y"))).alias("within"),
    )
    return dealt.groupBy(*cell, "inside", "x", "y").applyInArrow(_compare(threshold), "node long, links long, root long")


def near_duplicates(table: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``table``."""
    find_package_on_workers(table.sparkSession)
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vec).alias("vector"))
    good = usable("vector") & F.col("label").isNotNull()
    alone = rows.where(~good).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    # One row for each different vector of a label, numbered once and for all.
    unique = rows.where(good).groupBy("label", "vector").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
    vectors = materialize(
        unique.select(F.monotonically_increasing_id().alias("node"), "label", F.size("vector").alias("length"), "vector", "first_id", "weight"),
        "vectors",
    )
    pivots = pick_pivots(vectors)
    homes = home_cells(vectors, pivots)
    radii = {k: np.zeros(len(p)) for k, p in pivots.items()}
    # One number a pivot.
    for r in homes.groupBy("label", "length", "home").agg(F.max("near").alias("far")).where("far > 0").collect():
        radii[r["label"], r["length"]][r["home"]] = r["far"]
    reach = float(np.sqrt(max(2 - 2 * threshold, 0)))
    reach_cells = materialize(boundary_cells(homes, pivots, radii, reach), "vector-cells")
    linked = materialize(join_cells(reach_cells, threshold), "vector-links")
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected(linked.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "c")
    node = vectors.select("node", "label", "vector", "first_id", "weight").join(counts, "node", "left").join(joined, "node", "left")
    node = node.withColumn("c", F.coalesce("c", "node"))
    names = node.groupBy("c").agg(F.min("first_id").alias("component_id"))
    named = node.join(names, "c").select(
        F.col("label").alias("k_label"), F.col("vector").alias("k_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id",
    )
    found = rows.where(good).join(named, (F.col("label") == F.col("k_label")) & (F.col("vector") == F.col("k_vector")))
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")) & F.col("vec_id").isNotNull()
    return found.select("vec_id", "n_links", "component_id", kept.alias("kept")).unionByName(alone)
