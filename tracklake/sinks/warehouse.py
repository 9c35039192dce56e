"""Writers of the warehouse tables.

The batch jobs write every table into a folder of its own version, which
readers see once it is whole (``tracklake.versions``). Tracks of a load are
co-located: bucket files hold whole scenarios. Scenarios too large for that, and
tracks written by ``write_tracks``, are range-partitioned on (bucket, scenario,
object, timestep): files of a bucket hold disjoint id ranges, so a lookup opens
one or two of them, and a hot bucket, scenario or object is cut into as many
ranges as it needs. The other partitioned write uses the REBALANCE hint: AQE splits a partition that is too
large (a hot bucket or event type) and merges small ones, so files stay near
the advisory size whatever the key skew, with no task holding a whole hot
key. Rows are sorted within each file by (scenario, object, timestep), which
keeps row-group statistics tight for id lookups.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions import bucket_of
from tracklake.operators.vector_index import add_cells, choose_pivots, file_manifest
from tracklake.schemas import BUCKET_COL, PARTITIONED_TRACKS, VECTORS
from tracklake.settings import DEFAULT, EVENT_COLS, Settings
from tracklake.sources.warehouse import LOADS, TRACK_ORDER


def write_raw(df: DataFrame, out_dir: str) -> None:
    """A raw shard folder of plain Parquet files."""
    df.write.mode("overwrite").parquet(out_dir)


def write_tracks(df: DataFrame, out_dir: str) -> None:
    """Tracks partitioned by ``scenario_bucket``, as sorted ranges of ids."""
    ordered = df.repartitionByRange(BUCKET_COL, *TRACK_ORDER).sortWithinPartitions(BUCKET_COL, *TRACK_ORDER)
    ordered.write.mode("overwrite").partitionBy(BUCKET_COL).parquet(out_dir)


def write_load(
    tracks: DataFrame, tracks_dir: str, load: str, buckets: int, hot: DataFrame, spread_from: DataFrame | None = None
) -> bool:
    """Rows with their bucket key as one load of a table: bucket files, one
    for each folder and bucket, and ranges of the scenarios in ``hot`` (few, see
    ``hot_scenarios``; read from ``spread_from``, the same rows, if given).
    Returns whether there are any of the latter. No version lists the load yet."""
    folder, hot = f"{tracks_dir}/{LOADS}/load={load}", F.broadcast(hot)
    cols = PARTITIONED_TRACKS.fieldNames()
    # The exchange is the buckets' own hash, so a task writes one bucket.
    name = f"tracklake_load_{uuid.uuid4().hex}"
    (
        tracks.select(*cols).join(hot, "scenario_id", "left_anti")
        .repartition(buckets, "scenario_id")
        .write.partitionBy(BUCKET_COL).bucketBy(buckets, "scenario_id").sortBy(*TRACK_ORDER)
        .option("path", f"{folder}/spread=0").format("parquet").saveAsTable(name)
    )
    tracks.sparkSession.sql(f"DROP TABLE {name}")  # external: the files stay
    spread = hot.limit(1).count() > 0
    if spread:
        rows = tracks if spread_from is None else spread_from
        write_tracks(rows.select(*cols).join(hot, "scenario_id", "left_semi"), f"{folder}/spread=1")
    return spread


def write_shards(shards: DataFrame, tracks_dir: str) -> None:
    """Rows of the shard manifest are added; those of loads that no version
    lists are never read."""
    shards.coalesce(1).write.mode("append").parquet(f"{tracks_dir}/shards")


def write_events(events: DataFrame, out_dir: str) -> None:
    """Events partitioned by ``event_type`` (also when empty: the folder is
    replaced, so no stale partition survives)."""
    (
        events.select(*EVENT_COLS)
        .hint("rebalance", "event_type")
        .sortWithinPartitions("event_type", "scenario_id", "object_id")
        .write.mode("overwrite")
        .partitionBy("event_type")
        .parquet(out_dir)
    )


def write_features(features: DataFrame, path: str) -> None:
    features.hint("rebalance").sortWithinPartitions("scenario_id").write.mode("overwrite").parquet(path)


def write_curated_tracks(tracks: DataFrame, out_dir: str) -> None:
    tracks.hint("rebalance").sortWithinPartitions(*TRACK_ORDER).write.mode("overwrite").parquet(out_dir)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.hint("rebalance").write.mode("overwrite").parquet(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """The vector table: ``vector ARRAY<FLOAT>`` plus metadata columns."""
    vectors.hint("rebalance").write.mode("overwrite").parquet(path)


def write_vector_cells(vectors: DataFrame, out_dir: str, settings: Settings = DEFAULT) -> None:
    """The vector table as an exact index (``operators.vector_index``): cells
    cut into ranges of the distance to their pivot, the manifest of their files,
    and the vectors by id, in hash buckets. ``vectors`` is read several times."""
    spark, pivots = vectors.sparkSession, choose_pivots(vectors, settings)
    order = ("cell", "pivot_distance", "scenario_id")
    cells = add_cells(vectors.select(*VECTORS.fieldNames()), pivots)
    ordered = cells.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").partitionBy("cell").parquet(f"{out_dir}/cells")
    written = spark.read.schema(ordered.schema).parquet(f"{out_dir}/cells")
    file_manifest(written, pivots).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/files")
    ids = vectors.select("scenario_id", "vector", bucket_of("scenario_id", settings.scenario_bucket_count).alias("id_bucket"))
    by_id = ids.repartitionByRange("id_bucket", "scenario_id").sortWithinPartitions("id_bucket", "scenario_id")
    by_id.write.mode("overwrite").partitionBy("id_bucket").parquet(f"{out_dir}/ids")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Stage metrics are appended, one row per (run_id, stage, metric)."""
    metrics.coalesce(1).write.mode("append").parquet(path)
