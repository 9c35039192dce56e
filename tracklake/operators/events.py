"""Rule-based safety events: hard brake, cut-in, near miss.

One event per (scenario, object) and type, spanning the first to the last
matching timestep (gaps included).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions import clip01, euclid
from tracklake.operators.kinematics import copy_accel, ego_kinematics
from tracklake.schemas import EVENTS
from tracklake.settings import CUT_IN, DEFAULT, EVENT_COLS, HARD_BRAKE, NEAR_MISS, Settings


def empty_events(spark) -> DataFrame:
    return spark.createDataFrame([], EVENTS)


def hard_brakes_from_accel(ego: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Ego rows whose acceleration is below the threshold (strict), from
    ``ego_kinematics``: against the object's previous row, ego or not. A copy
    after the first has its own acceleration."""
    thr = settings.hard_brake_threshold_ms2
    again = copy_accel(settings)
    first_hit, copy_hit = F.col("accel_all") < thr, again < thr
    braking = ego.where(F.col("is_ego") & (first_hit | F.coalesce(copy_hit, F.lit(False))))
    agg = braking.groupBy("scenario_id", "object_id").agg(
        F.min("timestep").alias("timestep_start"),
        F.max("timestep").alias("timestep_end"),
        F.min(F.least(F.when(first_hit, F.col("accel_all")), F.when(copy_hit, again))).alias("_min_accel"),
    )
    return agg.select(
        "scenario_id",
        "object_id",
        F.lit(HARD_BRAKE).alias("event_type"),
        "timestep_start",
        "timestep_end",
        clip01(F.abs(F.col("_min_accel")) / F.lit(10.0)).alias("severity"),
    )


def detect_hard_brakes(
    tracks: DataFrame, settings: Settings = DEFAULT, ego: DataFrame | None = None
) -> DataFrame:
    """HARD_BRAKE events from the ego kinematics pass (``ego`` may be given
    to share it with the features)."""
    ego = ego_kinematics(tracks, settings) if ego is None else ego
    return hard_brakes_from_accel(ego, settings)


def agent_ego_pairs(tracks: DataFrame) -> DataFrame:
    """Every non-ego row paired with the ego position(s) of the same scenario
    and timestep (inner equi-join on both keys), with axis gaps and distance.

    Identical ego positions are deduplicated first (partial aggregation
    before the shuffle): the events only take min/max over pairs, so copies
    of an ego row change nothing but would multiply the join output.
    """
    ego = (
        tracks.where(F.col("is_ego"))
        .select(
            "scenario_id",
            "timestep",
            F.col("position_x").alias("ego_x"),
            F.col("position_y").alias("ego_y"),
        )
        .dropDuplicates()
    )
    agents = tracks.where(~F.col("is_ego")).select(
        "scenario_id", "object_id", "timestep", "position_x", "position_y"
    )
    joined = agents.join(ego, on=["scenario_id", "timestep"], how="inner")
    return joined.select(
        "scenario_id",
        "object_id",
        "timestep",
        F.abs(F.col("position_x") - F.col("ego_x")).alias("dx"),
        F.abs(F.col("position_y") - F.col("ego_y")).alias("dy"),
        euclid(F.col("position_x") - F.col("ego_x"), F.col("position_y") - F.col("ego_y")).alias(
            "distance"
        ),
    )


def _box(settings: Settings):
    return (F.col("dx") < settings.cut_in_distance_m * 3) & (F.col("dy") < settings.cut_in_distance_m)


def _circle(settings: Settings):
    return F.col("distance") < settings.near_miss_gap_m


def proximity_events(
    pairs: DataFrame, settings: Settings = DEFAULT, kinds=(CUT_IN, NEAR_MISS)
) -> DataFrame:
    """CUT_IN (box dx < 3 * d and dy < d) and NEAR_MISS (distance < gap)
    events from one aggregation with conditional aggregates, so the join and
    its shuffle are shared by both rules."""
    box, circle = _box(settings), _circle(settings)
    conds = {CUT_IN: box, NEAR_MISS: circle}
    keep = None
    for k in kinds:
        keep = conds[k] if keep is None else keep | conds[k]
    aggs = []
    for k in kinds:
        cond = conds[k]
        metric = F.col("dy") if k == CUT_IN else F.col("distance")
        aggs += [
            F.min(F.when(cond, F.col("timestep"))).alias(f"{k}_start"),
            F.max(F.when(cond, F.col("timestep"))).alias(f"{k}_end"),
            F.min(F.when(cond, metric)).alias(f"{k}_metric"),
            F.max(cond).alias(f"{k}_hit"),
        ]
    agg = pairs.where(keep).groupBy("scenario_id", "object_id").agg(*aggs)
    scale = {CUT_IN: settings.cut_in_distance_m, NEAR_MISS: settings.near_miss_gap_m}
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("event_type"),
                F.col(f"{k}_start").alias("timestep_start"),
                F.col(f"{k}_end").alias("timestep_end"),
                clip01(F.lit(1.0) - F.col(f"{k}_metric") / F.lit(scale[k])).alias("severity"),
                F.col(f"{k}_hit").alias("hit"),
            )
            for k in kinds
        ]
    )
    out = agg.select("scenario_id", "object_id", F.inline(rows)).where(F.col("hit"))
    return out.select(*EVENT_COLS)


def detect_cut_ins(tracks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return proximity_events(agent_ego_pairs(tracks), settings, kinds=(CUT_IN,))


def detect_near_misses(tracks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return proximity_events(agent_ego_pairs(tracks), settings, kinds=(NEAR_MISS,))


def detect_events(
    tracks: DataFrame, settings: Settings = DEFAULT, ego: DataFrame | None = None
) -> DataFrame:
    """All events in the canonical column order, duplicates kept."""
    if settings.valid_only:
        tracks = tracks.where(F.col("valid"))
    hb = detect_hard_brakes(tracks, settings, ego).select(*EVENT_COLS)
    prox = proximity_events(agent_ego_pairs(tracks), settings)
    return hb.unionByName(prox)
