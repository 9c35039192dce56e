"""Per-row kinematics over tracks: speed, acceleration, step distance,
integrated positions and default dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions import dimension_default, euclid, speed
from tracklake.operators.ordered import lag_columns, running_sum
from tracklake.settings import DEFAULT, Settings

TRACK_KEYS = ("scenario_id", "object_id")
#: Copies expanded from one array; a row with more takes two arrays.
_COPIES = 1 << 16


def collapse_copies(df: DataFrame) -> DataFrame:
    """Identical rows as one row with ``copies``, by partial aggregation
    before the shuffle, so a heavily repeated row never builds up in one
    window partition. (Grouping turns -0.0 into 0.0.)"""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def _copy_index(df: DataFrame) -> DataFrame:
    """One row per copy again, with ``_copy`` = 1..copies; no array holds more
    than ``_COPIES`` numbers."""
    last = (F.col("copies") - 1) / F.lit(_COPIES)
    blocks = df.select("*", F.explode(F.sequence(F.lit(0), F.floor(last))).alias("_block"))
    left = F.col("copies") - F.col("_block") * _COPIES
    within = F.sequence(F.lit(1), F.least(left, F.lit(_COPIES)).cast("int"))
    rows = blocks.select("*", F.explode(within).alias("_within"))
    return rows.withColumn("_copy", F.col("_block") * _COPIES + F.col("_within")).drop("_block", "_within")


def _change(now: str, before: Column, settings: Settings) -> Column:
    return (F.col(now) - before) / F.lit(settings.dt)


def speed_accel(
    tracks: DataFrame, settings: Settings = DEFAULT, columns: Sequence[str] | None = None
) -> DataFrame:
    """Add ``speed`` and ``accel_ms2`` = (speed - previous speed) / dt per
    (scenario, object) in timestep order; the first row's accel is NULL.

    The ordered pass runs over distinct rows; a copy follows an identical
    row, so every copy after the first gets (speed - speed) / dt: 0, NaN for
    a NaN or infinite speed, NULL for a NULL one. ``columns`` names the track
    columns to carry (keys and timestep always): both shuffles, of the
    collapse and of the window, move these only.
    """
    names = list(tracks.columns if columns is None else dict.fromkeys([*TRACK_KEYS, "timestep", *columns]))
    rows = tracks.select(*names, speed().alias("speed"))
    lagged = lag_columns(
        collapse_copies(rows), TRACK_KEYS, "timestep", ["speed"], settings=settings, tails_from=rows
    )
    before = F.when(F.col("_copy") == 1, F.col("prev_speed")).otherwise(F.col("speed"))
    return _copy_index(lagged).select(*names, "speed", _change("speed", before, settings).alias("accel_ms2"))


def ego_rows(tracks: DataFrame) -> DataFrame:
    """Rows of every object that is an ego at some step (the columns the ego
    pass needs). The ego flag may change along a track."""
    rows = tracks.select(
        "scenario_id",
        "object_id",
        "timestep",
        "is_ego",
        "heading",
        "position_x",
        "position_y",
        speed().alias("speed"),
    )
    egos = tracks.where(F.col("is_ego")).select(*TRACK_KEYS).distinct()
    return rows.join(egos, on=list(TRACK_KEYS), how="left_semi")


def ego_kinematics(tracks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Distinct ego rows with ``copies`` (how many identical rows there are),
    ``speed`` and, for the first copy: ``accel_all`` against the object's
    previous row, ego or not (hard brakes), ``accel_ms2`` and ``step_dist``
    against its previous ego row (features). Two ordered passes over the same
    chunks, shared by hard-brake detection and the scenario features.

    Identical copies are collapsed by a partial aggregation before any
    shuffle of the ordered pass. In timestep order a copy follows an identical
    row; consumers use ``copies`` for that. ``valid_only`` drops invalid rows
    here too, so a frame shared by several consumers agrees with them.
    """
    if settings.valid_only:
        tracks = tracks.where(F.col("valid"))
    rows = ego_rows(tracks)
    names = rows.columns
    every = lag_columns(
        collapse_copies(rows), TRACK_KEYS, "timestep", ["speed"], "any_", settings, tails_from=rows
    )
    cols = ["speed", "position_x", "position_y"]
    both = lag_columns(
        every, TRACK_KEYS, "timestep", cols, "ego_", settings, tails_from=rows, among=F.col("is_ego")
    )
    return both.where(F.col("is_ego")).select(
        *[F.col(c) for c in names],
        "copies",
        _change("speed", F.col("any_speed"), settings).alias("accel_all"),
        _change("speed", F.col("ego_speed"), settings).alias("accel_ms2"),
        euclid(
            F.col("position_x") - F.col("ego_position_x"),
            F.col("position_y") - F.col("ego_position_y"),
        ).alias("step_dist"),
    )


def copy_accel(settings: Settings = DEFAULT) -> Column:
    """Acceleration of a copy after the first, NULL where there is none."""
    return F.when(F.col("copies") > 1, _change("speed", F.col("speed"), settings))


def copy_step() -> Column:
    """Step of a copy after the first, NULL where there is none."""
    x, y = F.col("position_x"), F.col("position_y")
    return F.when(F.col("copies") > 1, euclid(x - x, y - y))


def step_distance(tracks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Ego rows with ``step_dist``; NULL on an object's first row."""
    step = F.when(F.col("_copy") == 1, F.col("step_dist")).otherwise(copy_step())
    return _copy_index(ego_kinematics(tracks, settings)).select(*TRACK_KEYS, "timestep", step.alias("step_dist"))


def integrate_positions(
    tracks: DataFrame, settings: Settings = DEFAULT, columns: Sequence[str] | None = None
) -> DataFrame:
    """Dead-reckoned positions: running sum of ``v * dt`` per (scenario,
    object) in timestep order, the current step included.

    The running sum runs over distinct rows weighted by ``copies``; copy i of
    m then sits (m - i) steps of ``v * dt`` before the weighted total.
    ``columns`` names the track columns to carry, as for ``speed_accel``.
    """
    names = list(tracks.columns if columns is None else dict.fromkeys([*TRACK_KEYS, "timestep", *columns]))
    needed = list(dict.fromkeys([*names, "velocity_x", "velocity_y"]))
    dt, m = F.lit(settings.dt), F.col("copies")
    steps = {"x_integrated": F.col("velocity_x") * dt, "y_integrated": F.col("velocity_y") * dt}
    summed = running_sum(
        collapse_copies(tracks.select(*needed)),
        TRACK_KEYS,
        "timestep",
        {n: e * m for n, e in steps.items()},
        settings=settings,
        totals_from=(tracks, steps),
    )
    back = m - F.col("_copy")
    return _copy_index(summed).select(
        *names,
        *[
            F.when(back == 0, F.col(n))
            .otherwise(F.col(n) - back * F.coalesce(F.col(v), F.lit(0.0)) * dt)
            .alias(n)
            for n, v in (("x_integrated", "velocity_x"), ("y_integrated", "velocity_y"))
        ],
    )


def fill_dimensions(tracks: DataFrame) -> DataFrame:
    """Fill a missing length or width from the object type's default."""
    return tracks.withColumn(
        "length_m", F.coalesce(F.col("length_m"), dimension_default("object_type", 0))
    ).withColumn("width_m", F.coalesce(F.col("width_m"), dimension_default("object_type", 1)))
