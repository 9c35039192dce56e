"""Curation: near-duplicate removal by clustering, then a stratified sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators.ordered import top_n_per_group
from tracklake.operators.space import (
    Z_COLS,
    assign_clusters,
    first_rows_as_centres,
    fit_centres,
    scaler_stats,
    standardize_with,
)
from tracklake.functions import bucket_of
from tracklake.schemas import BUCKET_COL
from tracklake.settings import DEFAULT, NO_EVENT, Settings

HELPERS = ("primary_event", "cluster", "cluster_distance")


def nearest_per_cluster(clustered: DataFrame, n_rows: int, k: int, settings: Settings = DEFAULT) -> DataFrame:
    """The ``max(1, n_rows // k)`` rows closest to their centre in each
    cluster (ties by id)."""
    n = max(1, n_rows // k)
    return top_n_per_group(
        clustered, ["cluster"], ["cluster_distance", "scenario_id"], n, settings, few_groups=True
    )


def cluster_and_dedup(
    features: DataFrame,
    settings: Settings = DEFAULT,
    centres: list[list[float]] | None = None,
    fixed_centres: bool = False,
    round_dp: int | None = None,
) -> DataFrame:
    """Standardise, cluster (k = min(dedup_cluster_count, N)), keep the rows
    nearest each centre. Returns the feature columns plus ``cluster`` and
    ``cluster_distance``.

    ``fixed_centres`` takes the first k rows by id as centres instead of a
    k-means fit (deterministic, used by the oracle checks).
    """
    stats = scaler_stats(features).first()  # one row: count, means, variances
    n_rows = stats["_n"]
    if n_rows == 0:
        return features.withColumn("cluster", F.lit(None).cast("int")).withColumn(
            "cluster_distance", F.lit(None).cast("double")
        )
    k = min(settings.dedup_cluster_count, n_rows)
    scaled = standardize_with(features, stats)
    if centres is None:
        centres = (
            first_rows_as_centres(scaled, k)
            if fixed_centres
            else fit_centres(features, stats, k, settings)
        )
    clustered = assign_clusters(scaled, centres, round_dp=round_dp).drop(*Z_COLS)
    return nearest_per_cluster(clustered, n_rows, k, settings)


def kmeans_invariants(features: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row that holds a fitted clustering against its rules: rows in, rows
    allowed per cluster, clusters allowed, and whether the kept rows stay
    within both, are the closest of their cluster, and the fit costs no more
    than the fixed centres do."""
    stats = scaler_stats(features).first()
    n_rows = stats["_n"]
    k = min(settings.dedup_cluster_count, n_rows)
    n = max(1, n_rows // max(k, 1))
    scaled = standardize_with(features, stats)
    fitted = fit_centres(features, stats, k, settings)
    kept = cluster_and_dedup(features, settings, centres=fitted).select("scenario_id", F.lit(True).alias("kept"))
    cost = F.sum(F.col("cluster_distance") * F.col("cluster_distance"))
    fixed = assign_clusters(scaled, first_rows_as_centres(scaled, k)).select(cost).scalar()
    rows = assign_clusters(scaled, fitted).join(kept, "scenario_id", "left")
    here = F.col("kept").isNotNull()
    per = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(here).alias("kept_rows"),
        F.max(F.when(here, F.col("cluster_distance"))).alias("farthest_kept"),
        F.min(F.when(~here, F.col("cluster_distance"))).alias("nearest_left"),
        cost.alias("cost"),
    )
    closest = F.col("nearest_left").isNull() | (F.col("farthest_kept") <= F.col("nearest_left"))
    return per.agg(
        F.sum("rows").alias("rows_in"),
        F.lit(n).cast("long").alias("per_cluster"),
        F.lit(k).cast("long").alias("k"),
        (F.count(F.lit(1)) <= k).alias("clusters_ok"),
        F.bool_and(F.col("kept_rows") == F.least(F.col("rows"), F.lit(n))).alias("kept_ok"),
        F.bool_and(closest).alias("closest_ok"),
        (F.sum("cost") <= fixed).alias("cost_ok"),
    )


def dedup_report(features: DataFrame, deduped: DataFrame) -> DataFrame:
    """One row: scenarios in, kept, and removed as near-duplicates."""
    n_out = deduped.select(F.count(F.lit(1))).scalar()
    return features.agg(F.count(F.lit(1)).alias("rows_in")).select(
        "rows_in", n_out.alias("rows_out"), (F.col("rows_in") - n_out).alias("removed")
    )


def primary_events(events: DataFrame) -> DataFrame:
    """One label per scenario with events: the least event type name (files
    are read in path order, so the first type read is the least)."""
    # array_min over the (at most three) distinct types: a hash aggregation,
    # where min() over strings would sort.
    return events.groupBy("scenario_id").agg(
        F.array_min(F.collect_set("event_type")).alias("primary_event")
    )


def stratified_sample(
    features: DataFrame,
    events: DataFrame,
    settings: Settings = DEFAULT,
    cap: int | None = None,
    keep_all_rare: bool | None = None,
) -> DataFrame:
    """At most ``cap`` scenarios per capped stratum, drawn by a seeded hash
    order (independent of partitioning); with ``keep_all_rare`` only NO_EVENT
    is capped. Without any event the input passes unchanged.

    "Any event" is an EXISTS subquery, so no action runs while planning.
    """
    cap = settings.curated_max_per_event if cap is None else cap
    keep_all_rare = settings.curated_keep_all_rare if keep_all_rare is None else keep_all_rare
    labeled = features.join(primary_events(events), on="scenario_id", how="left").withColumn(
        "primary_event", F.coalesce(F.col("primary_event"), F.lit(NO_EVENT))
    )
    capped_cond = (F.col("primary_event") == NO_EVENT) if keep_all_rare else F.lit(True)
    draw = F.md5(F.concat(F.col("scenario_id"), F.lit(f":{settings.seed}")))
    sampled = top_n_per_group(
        labeled.where(capped_cond).withColumn("_draw", draw),
        ["primary_event"],
        ["_draw", "scenario_id"],
        cap,
        settings,
        few_groups=True,
    ).drop("_draw")
    if keep_all_rare:
        sampled = sampled.unionByName(labeled.where(~capped_cond))
    any_event = events.exists()
    drop = [c for c in HELPERS if c in labeled.columns]
    with_events = sampled.where(any_event).drop(*drop)
    without_events = features.where(~any_event).drop(*drop)
    return with_events.unionByName(without_events)


def curated_tracks(tracks: DataFrame, curated: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Tracks of the curated scenarios (left semi join, no id list).

    On bucket-partitioned tracks, the distinct buckets of the curated ids (at
    most ``scenario_bucket_count`` values) become a partition filter, so
    folders without a curated scenario are not read.
    """
    ids = curated.select("scenario_id")
    if BUCKET_COL in tracks.columns:
        bucket = bucket_of("scenario_id", settings.scenario_bucket_count)
        buckets = [r[0] for r in ids.select(bucket.alias("b")).distinct().collect()]
        tracks = tracks.where(F.col(BUCKET_COL).isin(buckets))
    return tracks.join(ids, on="scenario_id", how="left_semi")


def curation_yield(curated: DataFrame, features: DataFrame) -> DataFrame:
    """kept / max(feature rows, 1)."""
    total = features.select(F.count(F.lit(1))).scalar()
    return curated.agg(F.count(F.lit(1)).alias("curated_count")).select(
        "curated_count",
        total.alias("feature_count"),
        (F.col("curated_count").cast("double") / F.greatest(total, F.lit(1)).cast("double")).alias(
            "yield"
        ),
    )
