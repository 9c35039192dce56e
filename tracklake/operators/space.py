"""Feature space: standardisation, unit-vector embedding, k-means centres and
assignment of scenarios to their nearest centre."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.operators import kmeans
from tracklake.settings import DEFAULT, FEATURE_COLS, Settings

# Fixed value: float64 machine epsilon, used by the constant-column rule.
EPS = 2.220446049250313e-16


def z(c: str) -> str:
    return f"z_{c}"


Z_COLS = tuple(z(c) for c in FEATURE_COLS)
V_COLS = tuple(f"v{i}" for i in range(len(FEATURE_COLS)))


def scaler_stats(features: DataFrame, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """One row: count, mean and population variance of each column."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"_mean_{c}"), F.var_pop(x).alias(f"_var_{c}")]
    return features.agg(*aggs)


def scale_of(stats, c: str) -> float:
    """Population deviation of a column; 1 where it is constant up to rounding."""
    n, var, mean = float(stats["_n"]), stats[f"_var_{c}"], stats[f"_mean_{c}"]
    if var is None or var <= n * EPS * var + (n * mean * EPS) ** 2:
        return 1.0
    return var**0.5


def standardize_with(features: DataFrame, stats, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """``standardize`` with statistics already collected (one Row of
    ``scaler_stats``), as literals in the plan."""
    return features.select(
        *[F.col(c) for c in features.columns],
        *[
            ((F.col(c).cast("double") - F.lit(stats[f"_mean_{c}"])) / F.lit(scale_of(stats, c))).alias(z(c))
            for c in cols
        ],
    )


def standardize(features: DataFrame, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """Add ``z_<c>`` = (c - mean) / scale for each column.

    The statistics are one aggregated row (a single pass with partial
    aggregation); it is fetched and enters the plan as literals, so the
    standardisation is a per-row projection with no join.
    """
    return standardize_with(features, scaler_stats(features, cols).first(), cols)


def embed(scaled: DataFrame) -> DataFrame:
    """Add ``v0..v5``: the standardised row divided by its L2 norm (a zero
    norm divides by 1)."""
    sq = None
    for c in Z_COLS:
        term = F.col(c) * F.col(c)
        sq = term if sq is None else sq + term
    norm = F.sqrt(sq)
    norm = F.when(norm == 0, F.lit(1.0)).otherwise(norm)
    return scaled.select("*", *[(F.col(c) / norm).alias(v) for c, v in zip(Z_COLS, V_COLS)])


def fit_centres(features: DataFrame, stats, k: int, settings: Settings = DEFAULT) -> list[list[float]]:
    """k-means centres of the standardised features: the best (least cost) of
    ``kmeans_starts`` seeded starts. ``stats`` is the row of ``scaler_stats``."""
    return kmeans.fit(features, stats, scale_of, k, settings)


def first_rows_as_centres(scaled: DataFrame, k: int) -> list[list[float]]:
    """Deterministic centres: the standardised rows of the first k ids."""
    rows = scaled.orderBy("scenario_id").select(*Z_COLS).limit(k).collect()
    return [[float(r[c]) for c in Z_COLS] for r in rows]


def assign_clusters(
    scaled: DataFrame, centres: list[list[float]], round_dp: int | None = None
) -> DataFrame:
    """Add ``cluster`` (index of the nearest centre, ties to the lower index)
    and ``cluster_distance`` (Euclidean distance to it).

    The centres are a literal array (k x 6 numbers) in the plan, so the
    assignment is a per-row expression with no join or shuffle.
    """
    arr = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])

    def dist(c: Column) -> Column:
        s = None
        for j, zc in enumerate(Z_COLS):
            d = F.col(zc) - c.getItem(j)
            s = d * d if s is None else s + d * d
        d = F.sqrt(s)
        return F.round(d, round_dp) if round_dp is not None else d

    best = F.array_min(
        F.transform(arr, lambda c, i: F.struct(dist(c).alias("d"), i.alias("i")))
    )
    return scaled.withColumn("_best", best).select(
        *[F.col(c) for c in scaled.columns],
        F.col("_best.i").alias("cluster"),
        F.col("_best.d").alias("cluster_distance"),
    )
