"""Readers of raw shards and warehouse tables."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake import versions
from tracklake.operators.stored import StoredTracks
from tracklake.operators.vector_index import VectorIndex
from tracklake.schemas import BUCKET_COL, EVENTS, FEATURES, PARTITIONED_TRACKS, TRACKS, VECTORS
from tracklake.settings import EVENT_COLS

#: Folder of the loads of tracks, below the table's own.
LOADS = "loads"
#: Row order within the files of tracks.
TRACK_ORDER = ("scenario_id", "object_id", "timestep")
#: The manifest of a vector table stored in cells.
VECTOR_FILES = "file string, cell int, rows long, near double, far double, pivot array<double>"


def read_raw_shards(spark: SparkSession, *raw: str) -> DataFrame:
    """All ``*.parquet`` files directly in a folder, or the files named,
    appended (one multi-file scan). Types are kept as stored; the track contract
    checks them. Raises ``FileNotFoundError`` when there is no file."""
    try:
        return spark.read.parquet(*(p if p.endswith(".parquet") else f"{p.rstrip('/')}/*.parquet" for p in raw))
    except AnalysisException as e:
        if _missing(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise FileNotFoundError(f"No parquet files in {', '.join(raw)}") from e
        raise


def list_shards(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(path, name, bytes) of the shards in a folder; no content is read."""
    files = spark.read.format("binaryFile").load(f"{raw_dir.rstrip('/')}/*.parquet")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


def read_tracks(spark: SparkSession, tracks_dir: str) -> DataFrame:
    """Bucket-partitioned tracks; ``scenario_bucket`` comes back as INT and
    filters on it prune folders. A table of several loads reads as one."""
    reader = spark.read.schema(PARTITIONED_TRACKS)
    if versions.current(spark, tracks_dir) is not None:
        reader = reader.option("basePath", f"{tracks_dir}/{LOADS}")
    return reader.parquet(*versions.folders(spark, tracks_dir)).select(*PARTITIONED_TRACKS.fieldNames())


def bucketed_name(tracks_dir: str, buckets: int) -> str:
    """Name under which the session's catalog knows the bucketed files."""
    return "tracklake_" + hashlib.md5(f"{tracks_dir}|{buckets}".encode()).hexdigest()


def read_stored_tracks(spark: SparkSession, tracks_dir: str) -> StoredTracks:
    """Tracks with their co-located and spread parts.

    The bucket files are registered as an external table of the session's
    catalog (the only way to tell Spark about buckets), from the file names
    alone. A folder without versions has neither part: plain reads serve."""
    every, entry = read_tracks(spark, tracks_dir), versions.current(spark, tracks_dir)
    if entry is None:
        return StoredTracks(every, every)
    name, n = bucketed_name(tracks_dir, entry["buckets"]), entry["buckets"]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRACKS.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, load STRING, spread INT, {BUCKET_COL} INT) USING parquet"
        f" PARTITIONED BY (load, spread, {BUCKET_COL})"
        f" CLUSTERED BY (scenario_id) SORTED BY ({', '.join(TRACK_ORDER)}) INTO {n} BUCKETS"
        f" LOCATION '{tracks_dir}/{LOADS}'"
    )
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    loads = [f.split("=", 1)[1] for f in entry["folders"]]
    names = PARTITIONED_TRACKS.fieldNames()
    cold = spark.table(name).where(F.col("load").isin(loads) & (F.col("spread") == 0)).select(*names)
    spread = None
    if entry["spread"]:
        folders = [f"{tracks_dir}/{f}/spread=1" for f in entry["spread"]]
        reader = spark.read.schema(PARTITIONED_TRACKS).option("basePath", f"{tracks_dir}/{LOADS}")
        spread = reader.parquet(*folders).select(*names)
    return StoredTracks(every, cold, spread, n)


def read_shards(spark: SparkSession, tracks_dir: str) -> DataFrame | None:
    """The shards that the current tracks were loaded from: load, name, bytes,
    rows, digest. None without versions."""
    entry = versions.current(spark, tracks_dir)
    if entry is None:
        return None
    loads = [f.split("=", 1)[1] for f in entry["folders"]]
    return spark.read.parquet(f"{tracks_dir}/shards").where(F.col("load").isin(loads))


def _missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


def read_events(spark: SparkSession, events_dir: str) -> DataFrame:
    """Events partitioned by ``event_type``; a typed empty table when the
    folder does not exist (only a missing folder falls back)."""
    try:
        return spark.read.schema(EVENTS).parquet(*versions.folders(spark, events_dir)).select(*EVENT_COLS)
    except AnalysisException as e:
        if _missing(e):
            return spark.createDataFrame([], EVENTS)
        raise


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURES).parquet(*versions.folders(spark, path))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The whole vector table, stored in cells or plain."""
    entry = versions.current(spark, path)
    below = "/cells" if entry and entry.get("layout") == "cells" else ""
    names = VECTORS.fieldNames()
    return spark.read.schema(VECTORS).parquet(*(f + below for f in versions.folders(spark, path))).select(*names)


def optional_vectors(spark: SparkSession, path: str) -> DataFrame | None:
    """``read_vectors``, or None when the folder does not exist."""
    try:
        return read_vectors(spark, path)
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def read_vector_index(spark: SparkSession, path: str) -> VectorIndex | None:
    """The index of a vector table stored in cells; None without one. Opening
    it lists the folders of ids, but not those of the cells."""
    entry = versions.current(spark, path)
    if not entry or entry.get("layout") != "cells":
        return None
    (root,) = versions.folders(spark, path)
    cells = f"{root}/cells"

    def read(files: list[str]) -> DataFrame:
        reader = spark.read.schema(VECTORS).option("basePath", cells)
        return reader.parquet(*(f"{cells}/{f}" for f in files)).select(*VECTORS.fieldNames())

    manifest = spark.read.schema(VECTOR_FILES).parquet(f"{root}/files")
    ids = spark.read.schema("scenario_id string, vector array<float>, id_bucket int").parquet(f"{root}/ids")
    return VectorIndex(manifest, ids, entry["id_buckets"], read)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(*versions.folders(spark, path))


def optional_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when the folder does not exist."""
    try:
        return spark.read.parquet(*versions.folders(spark, path))
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


__all__ = [
    "read_raw_shards",
    "list_shards",
    "read_tracks",
    "read_stored_tracks",
    "read_shards",
    "read_events",
    "read_features",
    "read_vectors",
    "optional_vectors",
    "read_vector_index",
    "read_table",
    "optional_table",
]
