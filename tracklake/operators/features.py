"""One kinematic feature row per scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators.kinematics import copy_accel, copy_step, ego_kinematics
from tracklake.settings import DEFAULT, Settings


def ego_features(
    tracks: DataFrame, settings: Settings = DEFAULT, ego: DataFrame | None = None
) -> DataFrame:
    """Per scenario over ego rows: mean and max speed, minimum acceleration,
    path length and sample variance of heading (NULLs not yet filled).

    A scenario without an ego row has no feature row. ``max`` skips NaN, the
    path length of a single-row ego is 0.0. Rows of ``ego_kinematics`` carry
    ``copies``: mean and variance are weighted by it, and copies add their own
    acceleration and step. The variance is put together from the built-in
    (stable) moments of the rows with equal ``copies``, of which a scenario has
    few, around the common mean.
    """
    ego = ego_kinematics(tracks, settings) if ego is None else ego
    s, m, h = F.col("speed"), F.col("copies").cast("double"), F.col("heading")
    parts = ego.groupBy("scenario_id", "copies").agg(
        (F.sum(s) * m).alias("s"),
        (F.count(s) * m).alias("n"),
        F.max(F.when(~F.isnan(s), s)).alias("top"),
        F.least(F.min("accel_ms2"), F.min(copy_accel(settings))).alias("low"),
        (F.sum("step_dist")).alias("path"),
        (F.sum(copy_step()) * (m - 1)).alias("path_copies"),
        (F.count(h) * m).alias("hn"),
        F.avg(h).alias("hm"),
        (F.var_pop(h) * F.count(h) * m).alias("h2"),
    )
    agg = parts.groupBy("scenario_id").agg(
        (F.sum("s") / F.nullif(F.sum("n"), F.lit(0.0))).alias("mean_speed"),
        F.max("top").alias("max_speed"),
        F.min("low").alias("max_decel"),
        (F.coalesce(F.sum("path"), F.lit(0.0)) + F.coalesce(F.sum("path_copies"), F.lit(0.0))).alias("trajectory_length"),
        F.collect_list(F.when(F.col("hn") > 0, F.struct("hn", "hm", "h2"))).alias("h"),
    )
    total = lambda x, e: F.aggregate(x, F.lit(0.0), lambda a, p: a + e(p))
    n = total(F.col("h"), lambda p: p["hn"])
    agg = agg.withColumn("hn", n).withColumn("hm", total(F.col("h"), lambda p: p["hn"] * p["hm"]) / F.nullif(n, F.lit(0.0)))
    spread = total(F.col("h"), lambda p: p["h2"] + p["hn"] * (p["hm"] - F.col("hm")) * (p["hm"] - F.col("hm")))
    variance = F.when(F.col("hn") > 1, spread / (F.col("hn") - 1))
    return agg.select(
        "scenario_id", "mean_speed", "max_speed", "max_decel", "trajectory_length", variance.alias("heading_variance")
    )


def agent_counts(tracks: DataFrame) -> DataFrame:
    """Distinct objects per scenario, ego included."""
    return tracks.groupBy("scenario_id").agg(F.countDistinct("object_id").alias("n_agents"))


def event_scenarios(events: DataFrame) -> DataFrame:
    """Distinct scenario ids that have at least one event."""
    return events.select("scenario_id").distinct()


def add_agent_count(features: DataFrame, counts: DataFrame) -> DataFrame:
    return features.join(counts, on="scenario_id", how="left")


def add_event_flag(features: DataFrame, events: DataFrame) -> DataFrame:
    """``has_event``: membership of the scenario in the event table, as a left
    join on the distinct ids (no id list through the driver)."""
    flags = event_scenarios(events).withColumn("_flag", F.lit(True))
    return (
        features.join(flags, on="scenario_id", how="left")
        .withColumn("has_event", F.col("_flag").isNotNull())
        .drop("_flag")
    )


def build_features(
    tracks: DataFrame,
    events: DataFrame,
    settings: Settings = DEFAULT,
    ego: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Feature rows; ``ego`` may pass an ``ego_kinematics`` frame shared with
    event detection, ``counts`` the agent counts where they come cheaper."""
    if settings.valid_only:
        tracks = tracks.where(F.col("valid"))
    counts = agent_counts(tracks) if counts is None else counts
    f = add_event_flag(add_agent_count(ego_features(tracks, settings, ego), counts), events)
    return f.select(
        "scenario_id",
        "mean_speed",
        "max_speed",
        F.coalesce(F.col("max_decel"), F.lit(0.0)).alias("max_decel"),
        "trajectory_length",
        F.coalesce(F.col("heading_variance"), F.lit(0.0)).alias("heading_variance"),
        F.col("n_agents").cast("bigint").alias("n_agents"),
        "has_event",
    )


def event_rate(features: DataFrame) -> DataFrame:
    """Share of feature rows with an event; 0 rows count as 1."""
    return features.agg(
        (
            F.count_if(F.col("has_event")).cast("double")
            / F.greatest(F.count(F.lit(1)), F.lit(1)).cast("double")
        ).alias("event_rate")
    )
