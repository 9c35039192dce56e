"""Work on tracks as they are stored: co-located scenarios and spread ones.

A warehouse keeps the rows of a scenario in one bucket file a load
(``colocated``), so work by scenario needs no exchange of tracks. Scenarios with
more than ``Settings.hot_scenario_rows`` rows in a load are kept apart as sorted
ranges over many files (``spread``): a bucket would put each into one task. There
are at most rows / hot_scenario_rows of them, so their ids may be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators.curate import curated_tracks
from tracklake.operators.features import agent_counts
from tracklake.settings import DEFAULT, Settings


@dataclass(frozen=True)
class StoredTracks:
    """``every`` row; the ``colocated`` part, hash-partitioned on scenario_id as
    it is read (in ``buckets``; None: it is not), and the ``spread`` part (None:
    no hot scenario)."""

    every: DataFrame
    colocated: DataFrame
    spread: DataFrame | None = None
    buckets: int | None = None

    def hot_ids(self) -> DataFrame:
        return F.broadcast(self.spread.select("scenario_id").distinct())


def agent_counts_stored(tracks: StoredTracks) -> DataFrame:
    """``agent_counts`` without an exchange of the co-located rows. Rows that a
    hot scenario has in the co-located part (it was not hot in that load) are
    counted with its others, by distinct pairs that are combined before the
    shuffle."""
    if tracks.spread is None:
        return agent_counts(tracks.colocated)
    hot = tracks.hot_ids()
    lone = tracks.colocated.join(hot, "scenario_id", "left_anti")
    cols = ["scenario_id", "object_id"]
    mixed = tracks.colocated.join(hot, "scenario_id", "left_semi").select(*cols).unionByName(tracks.spread.select(*cols))
    return agent_counts(lone).unionByName(agent_counts(mixed))


def curated_tracks_stored(tracks: StoredTracks, curated: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``curated_tracks`` without an exchange of tracks: the co-located part
    meets the ids bucket by bucket, the spread part the hot ids among them by
    broadcast."""
    ids = curated.select("scenario_id")
    if tracks.buckets:
        # Dealt as the buckets are; Spark could deal the tracks anew as the ids lie.
        ids = ids.repartition(tracks.buckets, "scenario_id")
    cold = curated_tracks(tracks.colocated, ids, settings)
    if tracks.spread is None:
        return cold
    ids = F.broadcast(tracks.hot_ids().join(curated.select("scenario_id"), "scenario_id", "left_semi"))
    return cold.unionByName(tracks.spread.join(ids, "scenario_id", "left_semi").select(*cold.columns))


def hot_scenarios(tracks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Ids with more rows than a bucket file should hold of one scenario."""
    n = tracks.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") > settings.hot_scenario_rows).select("scenario_id")
