"""Batch jobs: ingest, detect, featurize, curate, embed, and the whole run.

Each stage reads the previous stage's tables from the warehouse and writes
its own, so lineage is cut at every stage boundary and a lost executor only
recomputes within one stage. Results that are validated and then written
are checkpointed to the session's reliable checkpoint folder first, so the
checked rows are the written rows and nothing is computed twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake import sinks, versions
from tracklake.operators.contracts import (
    TRACK_CONTRACT,
    ContractError,
    observed,
    schema_problems,
    validate_events,
    validate_features,
)
from tracklake.operators.curate import (
    cluster_and_dedup,
    curation_yield,
    dedup_report,
    stratified_sample,
)
from tracklake.operators.events import detect_events
from tracklake.operators.features import build_features, event_rate
from tracklake.operators.layout import add_partition_key, layout_summary
from tracklake.operators.similar import vector_table
from tracklake.operators.stored import agent_counts_stored, curated_tracks_stored, hot_scenarios
from tracklake.schemas import TRACKS
from tracklake.session import ensure_checkpoint_dir
from tracklake.settings import DEFAULT, Settings
from tracklake.sources import warehouse as src


@dataclass(frozen=True)
class Warehouse:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def tracks(self) -> str:
        return self._p("tracks")

    @property
    def events(self) -> str:
        return self._p("events")

    @property
    def features(self) -> str:
        return self._p("features")

    @property
    def curated(self) -> str:
        return self._p("curated", "curated_tracks")

    @property
    def manifest(self) -> str:
        return self._p("curated", "curated_manifest")

    @property
    def vectors(self) -> str:
        return self._p("vectors")

    @property
    def metrics(self) -> str:
        return self._p("metrics")


METRICS = "run_id STRING, recorded_at TIMESTAMP, stage STRING, metric STRING, value DOUBLE"


def metrics_frame(spark: SparkSession, stage: str, values: dict[str, float], run_id: str | None = None) -> DataFrame:
    """Rows of the metrics table, keyed by (run_id, stage, metric); a stage
    run by itself is a run of its own."""
    run, now = run_id or uuid.uuid4().hex, datetime.now(timezone.utc)
    rows = [(run, now, stage, k, float(v) if v is not None else None) for k, v in values.items()]
    return spark.createDataFrame(rows, METRICS)


def stage_metrics(
    tracks: DataFrame,
    events: DataFrame,
    features: DataFrame,
    curated_manifest: DataFrame,
    vectors: DataFrame,
) -> DataFrame:
    """(stage, metric, value) for every stage, from one-row aggregates."""

    def rows(df: DataFrame, stage: str, aggs: dict) -> DataFrame:
        one = df.agg(*[e.cast("double").alias(k) for k, e in aggs.items()])
        return one.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(stage).alias("stage"), F.lit(k).alias("metric"), F.col(k).alias("value")
                        )
                        for k in aggs
                    ]
                )
            )
        )

    n = F.count(F.lit(1))
    parts = [
        rows(tracks, "tracks", {"row_count": n, "scenario_count": F.countDistinct("scenario_id")}),
        rows(events, "events", {"event_count": n}),
        rows(
            features,
            "features",
            {
                "feature_count": n,
                "event_rate": F.count_if(F.col("has_event")).cast("double")
                / F.greatest(n, F.lit(1)).cast("double"),
            },
        ),
        rows(curated_manifest, "curated", {"curated_scenarios": n}),
        rows(vectors, "embeddings", {"indexed_scenarios": n}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _shard_profile(raw: DataFrame) -> DataFrame:
    """One row a shard: path, name, bytes, rows, a digest of its rows (in any
    order), and how many rows break each rule, from one scan. The digest is two
    sums of 64-bit row hashes, so equal rows do not cancel out."""
    h = F.xxhash64(*raw.columns)
    rules = TRACK_CONTRACT.all_rules()
    return raw.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.first("_metadata.file_name").alias("name"),
        F.first("_metadata.file_size").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws(
            "-", *(F.hex(F.sum(F.pmod(F.shiftrightunsigned(h, k), F.lit(1 << 32)))) for k in (0, 32))
        ).alias("digest"),
        F.array(*[F.count_if(r.bad()) for r in rules]).alias("broken"),
    )


def _check_broken(shards: DataFrame) -> None:
    rules = TRACK_CONTRACT.all_rules()
    counts = shards.agg(*[F.coalesce(F.sum(F.col("broken")[i]), F.lit(0)) for i in range(len(rules))]).first()
    failures = [(TRACK_CONTRACT.name, r.column, r.check, n) for r, n in zip(rules, counts, strict=True) if n]
    if failures:
        raise ContractError(TRACK_CONTRACT.name, failures)


def _load(spark: SparkSession, raw: DataFrame, wh: Warehouse, settings: Settings, base: dict | None) -> None:
    """Rows of raw shards as a load of the tracks: after the loads of ``base``,
    or instead of all."""
    ensure_checkpoint_dir(spark)
    load = uuid.uuid4().hex
    buckets = base["buckets"] if base else settings.track_buckets
    hot = hot_scenarios(raw, settings).checkpoint(eager=True)
    tracks = add_partition_key(raw.select(*TRACKS.fieldNames()), settings)
    if settings.validate_while_writing:
        checked, check = observed(tracks, TRACK_CONTRACT)
        spread = sinks.write_load(checked, wh.tracks, load, buckets, hot, spread_from=tracks)
        check()
        files = spark.createDataFrame([(_uri(spark, p),) for p in raw.inputFiles()], "path string")
        shards = files.select(
            F.element_at(F.split("path", "/"), -1).alias("name"), F.lit(None).cast("long").alias("bytes"),
            F.lit(None).cast("long").alias("rows"), F.lit(None).cast("string").alias("digest"),
        )
    else:
        profile = _shard_profile(raw).checkpoint(eager=True)
        _check_broken(profile)
        spread = sinks.write_load(tracks, wh.tracks, load, buckets, hot)
        shards = profile.select("name", "bytes", "rows", "digest")
    sinks.write_shards(shards.select(F.lit(load).alias("load"), "*"), wh.tracks)
    folder = f"{src.LOADS}/load={load}"
    versions.commit(
        spark,
        wh.tracks,
        {
            "folders": [*(base["folders"] if base else []), folder],
            "spread": [*(base["spread"] if base else []), *([folder] if spread else [])],
            "buckets": buckets,
        },
    )


def _uri(spark: SparkSession, path: str) -> str:
    return spark._jvm.java.net.URI.create(path).getPath()


def _raw_tracks(spark: SparkSession, *paths: str) -> DataFrame:
    raw = src.read_raw_shards(spark, *paths)
    if problems := schema_problems(raw, TRACK_CONTRACT):
        raise ContractError(TRACK_CONTRACT.name, problems)
    return raw


def _loaded(spark: SparkSession, wh: Warehouse, run_id: str | None) -> dict:
    m = layout_summary(src.read_tracks(spark, wh.tracks)).first().asDict()
    sinks.write_metrics(metrics_frame(spark, "tracks", m, run_id), wh.metrics)
    return m


def ingest(
    spark: SparkSession, raw_dir: str, wh: Warehouse, settings: Settings = DEFAULT, run_id: str | None = None
) -> dict:
    """Raw shards -> contract check -> bucket key -> tracks, which replace
    those before. With ``validate_while_writing`` the rows are checked as they
    are written; in both modes a failed check leaves the old table."""
    _load(spark, _raw_tracks(spark, raw_dir), wh, settings, None)
    return _loaded(spark, wh, run_id)


def append(
    spark: SparkSession, raw_dir: str, wh: Warehouse, settings: Settings = DEFAULT, run_id: str | None = None
) -> dict:
    """Take the shards of ``raw_dir`` that the tracks do not hold yet, as a new
    load; files of earlier loads are neither read nor written.

    A shard is taken already if one of its name and size was, or one of other
    name with the same rows (known unless loaded with
    ``validate_while_writing``). One of the same name and another size raises
    ``ValueError``. Shards that arrive together are all taken. The driver holds
    the names of the new shards."""
    base = versions.current(spark, wh.tracks)
    if base is None:
        return ingest(spark, raw_dir, wh, settings, run_id)
    ensure_checkpoint_dir(spark)
    taken = src.read_shards(spark, wh.tracks)
    by_name = taken.groupBy("name").agg(F.max("bytes").alias("known"), F.lit(True).alias("taken"))
    found = src.list_shards(spark, raw_dir).join(by_name, "name", "left")
    changed = found.where(F.col("known") != F.col("bytes")).select("name").limit(5).collect()
    if changed:
        raise ValueError(f"shards changed since they were taken: {', '.join(r['name'] for r in changed)}")
    new = [r["path"] for r in found.where(F.col("taken").isNull()).select("path").collect()]
    if new:
        digests = taken.where(F.col("digest").isNotNull()).select("digest", "rows").distinct()
        profile = _shard_profile(_raw_tracks(spark, *new))
        new = [r["path"] for r in profile.join(digests, ["digest", "rows"], "left_anti").select("path").collect()]
    if new:
        _load(spark, _raw_tracks(spark, *new), wh, settings, base)
    return _loaded(spark, wh, run_id) | {"shards_taken": len(new)}


def detect(spark: SparkSession, wh: Warehouse, settings: Settings = DEFAULT, run_id: str | None = None) -> dict:
    """Tracks -> hard brakes, cut-ins, near misses -> contract -> events."""
    ensure_checkpoint_dir(spark)
    tracks = src.read_tracks(spark, wh.tracks)
    events = detect_events(tracks, settings).checkpoint(eager=True)
    validate_events(events)
    versions.replace(spark, wh.events, lambda p: sinks.write_events(events, p))
    by_type = {r["event_type"]: r["n"] for r in events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    m = {"event_count": sum(by_type.values()), **{f"{k.lower()}_count": v for k, v in by_type.items()}}
    sinks.write_metrics(metrics_frame(spark, "events", m, run_id), wh.metrics)
    return m


def featurize(spark: SparkSession, wh: Warehouse, settings: Settings = DEFAULT, run_id: str | None = None) -> dict:
    """Tracks + events -> one feature row per scenario -> contract -> features."""
    ensure_checkpoint_dir(spark)
    tracks = src.read_stored_tracks(spark, wh.tracks)
    events = src.read_events(spark, wh.events)
    counts = None if settings.valid_only else agent_counts_stored(tracks)
    features = build_features(tracks.every, events, settings, counts=counts).checkpoint(eager=True)
    validate_features(features)
    versions.replace(spark, wh.features, lambda p: sinks.write_features(features, p))
    rate = event_rate(features).first()["event_rate"]
    m = {"feature_count": features.count(), "event_rate": rate}
    sinks.write_metrics(metrics_frame(spark, "features", m, run_id), wh.metrics)
    return m


def curate(
    spark: SparkSession,
    wh: Warehouse,
    settings: Settings = DEFAULT,
    run_id: str | None = None,
    fixed_centres: bool = False,
    round_dp: int | None = None,
) -> dict:
    """Features -> k-means dedup -> stratified sample -> curated tracks and
    manifest. ``fixed_centres`` and ``round_dp`` as in ``cluster_and_dedup``."""
    ensure_checkpoint_dir(spark)
    features = src.read_features(spark, wh.features)
    events = src.read_events(spark, wh.events)
    deduped = cluster_and_dedup(features, settings, fixed_centres=fixed_centres, round_dp=round_dp).checkpoint(eager=True)
    report = dedup_report(features, deduped).first()
    curated = stratified_sample(deduped, events, settings).checkpoint(eager=True)
    kept = curated_tracks_stored(src.read_stored_tracks(spark, wh.tracks), curated, settings)
    versions.replace(spark, wh.curated, lambda p: sinks.write_curated_tracks(kept, p))
    versions.replace(spark, wh.manifest, lambda p: sinks.write_manifest(curated, p))
    y = curation_yield(curated, features).first()
    m = {
        "dedup_removed": report["removed"],
        "features_in": y["feature_count"],
        "curated_scenarios": y["curated_count"],
        "yield": y["yield"],
        "curated_track_rows": src.read_table(spark, wh.curated).count(),
    }
    sinks.write_metrics(metrics_frame(spark, "curated", m, run_id), wh.metrics)
    return m


def embed(
    spark: SparkSession, wh: Warehouse, settings: Settings = DEFAULT, probe_k: int = 5, run_id: str | None = None
) -> dict:
    """Features + events -> unit vectors -> vector table in cells around
    pivots; one probe search."""
    ensure_checkpoint_dir(spark)
    features = src.read_features(spark, wh.features)
    events = src.read_events(spark, wh.events)
    table = vector_table(features, events).checkpoint(eager=True)
    versions.replace(
        spark, wh.vectors, lambda p: sinks.write_vector_cells(table, p, settings),
        layout="cells", id_buckets=settings.scenario_bucket_count,
    )
    vectors = src.read_vectors(spark, wh.vectors)
    m = {"indexed_scenarios": vectors.count()}
    probe_id = vectors.agg(F.min("scenario_id")).first()[0]
    if probe_id is not None:
        m["probe_neighbours"] = len(src.read_vector_index(spark, wh.vectors).search(probe_id, probe_k).collect())
    sinks.write_metrics(metrics_frame(spark, "embeddings", m, run_id), wh.metrics)
    return m


def run_pipeline(spark: SparkSession, raw_dir: str, warehouse: str, settings: Settings = DEFAULT) -> dict:
    """All stages in order, starting from given raw shards; their metrics
    share one run id."""
    wh, run_id = Warehouse(warehouse), uuid.uuid4().hex
    return {
        "tracks": ingest(spark, raw_dir, wh, settings, run_id),
        "events": detect(spark, wh, settings, run_id),
        "features": featurize(spark, wh, settings, run_id),
        "curated": curate(spark, wh, settings, run_id),
        "embeddings": embed(spark, wh, settings, run_id=run_id),
    }
