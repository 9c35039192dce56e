"""Table sinks of the warehouse."""

from tracklake.sinks.warehouse import (
    write_curated_tracks,
    write_events,
    write_features,
    write_load,
    write_manifest,
    write_metrics,
    write_raw,
    write_shards,
    write_tracks,
    write_vector_cells,
    write_vectors,
)

__all__ = [
    "write_curated_tracks",
    "write_events",
    "write_features",
    "write_load",
    "write_manifest",
    "write_metrics",
    "write_raw",
    "write_shards",
    "write_tracks",
    "write_vector_cells",
    "write_vectors",
]
