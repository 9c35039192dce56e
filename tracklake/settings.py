"""Pipeline parameters.

Fixed values that must equal the reference's defaults for the same results
(thresholds in m/s^2 and metres, bucket count, dedup and curation sizes, the
integration step):

    hard_brake_threshold_ms2 = -4.0
    cut_in_distance_m        = 5.0
    near_miss_gap_m          = 2.0
    scenario_bucket_count    = 32
    target_file_size_mb      = 100
    dedup_cluster_count      = 50
    dedup_distance_threshold = 0.3   (declared by the reference, never applied)
    curated_max_per_event    = 80
    curated_keep_all_rare    = True
    dt                       = 0.1
    seed                     = 42
    kmeans_starts            = 10

The remaining fields are Spark execution knobs of our own.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    hard_brake_threshold_ms2: float = -4.0
    cut_in_distance_m: float = 5.0
    near_miss_gap_m: float = 2.0
    scenario_bucket_count: int = 32
    target_file_size_mb: int = 100  # unused, here as in the reference
    dedup_cluster_count: int = 50
    dedup_distance_threshold: float = 0.3  # unused, here as in the reference
    curated_max_per_event: int = 80
    curated_keep_all_rare: bool = True
    dt: float = 0.1
    seed: int = 42
    kmeans_starts: int = 10
    kmeans_max_iter: int = 300
    kmeans_tol: float = 1e-4
    # The reference never filters on ``valid``; True drops invalid rows
    # before detection and features.
    valid_only: bool = False
    # Ingest: False validates in a scan before writing (a failed check leaves
    # the old table untouched); True counts the contract rules while writing
    # (one read) and raises after the write if any rule is broken.
    validate_while_writing: bool = False

    # Stored tracks: bucket files per folder of ``scenario_bucket`` (one task
    # reads a bucket: choose about table bytes / 1 GB on a cluster), and rows
    # of a scenario in one load beyond which it is kept apart in ranges.
    track_buckets: int = 8
    hot_scenario_rows: int = 50_000_000
    # Stored vectors: rows a cell is meant to hold (cells are bounded, see
    # operators/vector_index.py).
    vector_cell_rows: int = 4096

    # Ordered per-object computations (lag, running sums) run per chunk of
    # this many timesteps, so one very long track never becomes one task.
    timestep_chunk: int = 1 << 16
    # Partitions for range-partitioned ranking; None means
    # spark.sql.shuffle.partitions.
    rank_partitions: int | None = None

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)


DEFAULT = Settings()

# The order of the vector components, and of the event columns.
FEATURE_COLS = (
    "mean_speed",
    "max_speed",
    "max_decel",
    "trajectory_length",
    "n_agents",
    "heading_variance",
)

EVENT_COLS = (
    "scenario_id",
    "object_id",
    "event_type",
    "timestep_start",
    "timestep_end",
    "severity",
)

# Event labels, object types and their default dimensions
# (length_m, width_m), and the label of scenarios without events.
HARD_BRAKE = "HARD_BRAKE"
CUT_IN = "CUT_IN"
NEAR_MISS = "NEAR_MISS"
EVENT_TYPES = (HARD_BRAKE, CUT_IN, NEAR_MISS)
OBJECT_TYPES = ("VEHICLE", "PEDESTRIAN", "CYCLIST")
OBJECT_DIMENSIONS = {
    "VEHICLE": (4.5, 2.0),
    "PEDESTRIAN": (0.5, 0.5),
    "CYCLIST": (1.8, 0.7),
}
NO_EVENT = "NO_EVENT"
NO_EVENT_LIST = "none"
