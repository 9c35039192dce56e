"""Named query plans over the driver's test tables.

Every plan reads ``events.parquet`` of a scale-factor folder, derives the
track fixture from it (``sources.fixture``) and runs the pipeline operators on
the whole of it. Float outputs that depend on summation order are snapped to
a grid of 2^-20 (``floor(x * 2^20 + 0.5) / 2^20``, exact in IEEE arithmetic)
so that the DuckDB oracle can compare them: a decimal grid would put exact
ties on the nice decimal values of the fixture.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.operators import contracts as ct
from tracklake.operators import curate as cu
from tracklake.operators import events as ev
from tracklake.operators import features as ft
from tracklake.operators import kinematics as kin
from tracklake.operators import similar as sim
from tracklake.operators import space as sp
from tracklake.operators.layout import add_partition_key, bucket_counts, bucket_range
from tracklake import sinks
from tracklake.plans import jobs, marts
from tracklake.plans.catalog import Catalog
from tracklake.plans.jobs import Warehouse, stage_metrics
from tracklake.session import ensure_checkpoint_dir
from tracklake.settings import CUT_IN, DEFAULT
from tracklake.sources import warehouse as src
from tracklake.sources.fixture import fixture_tracks, plant_bad_tracks

Query = Callable[[SparkSession, str], DataFrame]


GRID = 1048576.0  # 2^20


def snap(x):
    return F.floor(x * F.lit(GRID) + F.lit(0.5)).cast("double") / F.lit(GRID)


def _r(c: str):
    return snap(F.col(c)).alias(c)


class Stages:
    """The pipeline over the fixture as shared DataFrames, built on first
    use: one ego kinematics pass feeds both event detection and the features.

    ``materialize`` checkpoints events and features (as the batch jobs write
    them to the warehouse) for plans that read them several times."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize

    def _keep(self, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    @cached_property
    def tracks(self) -> DataFrame:
        return fixture_tracks(self.spark, self.sf_dir)

    @cached_property
    def ego(self) -> DataFrame:
        return kin.ego_kinematics(self.tracks)

    @cached_property
    def events(self) -> DataFrame:
        return self._keep(ev.detect_events(self.tracks, ego=self.ego))

    @cached_property
    def features(self) -> DataFrame:
        return self._keep(ft.build_features(self.tracks, self.events, ego=self.ego))


def _tracks(spark, sf_dir):
    return fixture_tracks(spark, sf_dir)


def _events(spark, sf_dir):
    return Stages(spark, sf_dir).events


def _features(spark, sf_dir):
    return Stages(spark, sf_dir).features


FEATURE_OUT = (
    "mean_speed",
    "max_speed",
    "max_decel",
    "trajectory_length",
    "heading_variance",
)


def q_tracks(spark, sf_dir):
    return add_partition_key(_tracks(spark, sf_dir))


def q_speed_accel(spark, sf_dir):
    return kin.speed_accel(_tracks(spark, sf_dir), columns=()).select(
        "scenario_id", "object_id", "timestep", "speed", "accel_ms2"
    )


def q_step_distance(spark, sf_dir):
    return kin.step_distance(_tracks(spark, sf_dir))


def q_integrate_positions(spark, sf_dir):
    return kin.integrate_positions(_tracks(spark, sf_dir), columns=()).select(
        "scenario_id", "object_id", "timestep", _r("x_integrated"), _r("y_integrated")
    )


def q_fill_dimensions(spark, sf_dir):
    t = _tracks(spark, sf_dir)
    holed = t.withColumn("length_m", F.when(F.col("valid"), F.col("length_m"))).withColumn(
        "width_m", F.when(F.col("valid"), F.col("width_m"))
    )
    return kin.fill_dimensions(holed).select(
        "scenario_id", "object_id", "timestep", "object_type", "length_m", "width_m"
    )


def q_bucket_counts(spark, sf_dir):
    return bucket_counts(q_tracks(spark, sf_dir))


def q_bucket_range(spark, sf_dir):
    return bucket_range(bucket_counts(q_tracks(spark, sf_dir)))


def q_hard_brakes(spark, sf_dir):
    return ev.detect_hard_brakes(_tracks(spark, sf_dir))


def q_cut_ins(spark, sf_dir):
    return ev.detect_cut_ins(_tracks(spark, sf_dir))


def q_near_misses(spark, sf_dir):
    return ev.detect_near_misses(_tracks(spark, sf_dir))


def q_all_events(spark, sf_dir):
    return _events(spark, sf_dir)


def q_ego_features(spark, sf_dir):
    return ft.ego_features(_tracks(spark, sf_dir)).select(
        "scenario_id", *[_r(c) for c in FEATURE_OUT]
    )


def q_agent_counts(spark, sf_dir):
    return ft.agent_counts(_tracks(spark, sf_dir))


def q_features(spark, sf_dir):
    return _features(spark, sf_dir).select(
        "scenario_id", *[_r(c) for c in FEATURE_OUT], "n_agents", "has_event"
    )


def q_event_rate(spark, sf_dir):
    return ft.event_rate(_features(spark, sf_dir)).select(_r("event_rate"))


def q_event_scenarios(spark, sf_dir):
    return ft.event_scenarios(_events(spark, sf_dir))


# -- space ------------------------------------------------------------------

SIMILAR_TO = "sc_00003"
DETAIL_OF = "sc_00003"
SAMPLE_CAP = 20


def _stored_features(spark, sf_dir):
    """Features as the embed job reads them: materialized once, so the
    scaler-statistics pass and the main scan read the same rows."""
    return Stages(spark, sf_dir, materialize=True).features


def q_scaled_features(spark, sf_dir):
    sc = sp.standardize(_stored_features(spark, sf_dir))
    return sc.select("scenario_id", *[_r(z) for z in sp.Z_COLS])


def q_embeddings(spark, sf_dir):
    e = sp.embed(sp.standardize(_stored_features(spark, sf_dir)))
    return e.select("scenario_id", *[_r(v) for v in sp.V_COLS])


def q_event_lists(spark, sf_dir):
    return sim.event_lists(_events(spark, sf_dir))


def _vectors(spark, sf_dir, materialize: bool = False):
    st = Stages(spark, sf_dir, materialize=True)
    v = sim.vector_table(st.features, st.events)
    # The embed job writes the vector table once; searches read it.
    if not materialize:
        return v
    ensure_checkpoint_dir(spark)
    return v.checkpoint(eager=True)


def _vector_cols(df):
    return [snap(F.col("vector").getItem(i).cast("double")).alias(v) for i, v in enumerate(sp.V_COLS)]


def q_vector_table(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return v.select(
        "scenario_id",
        *_vector_cols(v),
        *[_r(c) for c in FEATURE_OUT],
        "n_agents",
        "has_event",
        "event_types",
    )


def q_knn(spark, sf_dir):
    res = sim.search_similar(_vectors(spark, sf_dir, materialize=True), SIMILAR_TO, 5)
    return res.select(
        "scenario_id", "event_types", _r("mean_speed"), _r("max_decel"), _r("_distance")
    )


# -- curation ---------------------------------------------------------------


def _deduped(spark, sf_dir, features=None):
    if features is None:
        features = Stages(spark, sf_dir, materialize=True).features
    return cu.cluster_and_dedup(features, fixed_centres=True, round_dp=9)


def _manifest(spark, sf_dir, cap=None, keep_all_rare=None, st=None):
    st = Stages(spark, sf_dir, materialize=True) if st is None else st
    return cu.stratified_sample(
        _deduped(spark, sf_dir, st.features), st.events, cap=cap, keep_all_rare=keep_all_rare
    )


def _feature_cols(df):
    return df.select("scenario_id", *[_r(c) for c in FEATURE_OUT], "n_agents", "has_event")


def q_primary_events(spark, sf_dir):
    return cu.primary_events(_events(spark, sf_dir))


def q_nearest_per_cluster(spark, sf_dir):
    d = _deduped(spark, sf_dir)
    return d.select("scenario_id", F.col("cluster").cast("bigint").alias("cluster"), "cluster_distance")


def q_stratified_sample(spark, sf_dir):
    return _feature_cols(_manifest(spark, sf_dir, cap=SAMPLE_CAP))


def q_stratified_sample_all_capped(spark, sf_dir):
    return _feature_cols(_manifest(spark, sf_dir, cap=SAMPLE_CAP, keep_all_rare=False))


def q_curated_manifest(spark, sf_dir):
    return _feature_cols(_manifest(spark, sf_dir))


def q_curated_tracks(spark, sf_dir):
    st = Stages(spark, sf_dir, materialize=True)
    return cu.curated_tracks(st.tracks, _manifest(spark, sf_dir, st=st))


def q_curation_yield(spark, sf_dir):
    st = Stages(spark, sf_dir, materialize=True)
    return cu.curation_yield(_manifest(spark, sf_dir, st=st), st.features).select(
        "curated_count", "feature_count", _r("yield")
    )


def q_dedup_report(spark, sf_dir):
    st = Stages(spark, sf_dir, materialize=True)
    return cu.dedup_report(st.features, _deduped(spark, sf_dir, st.features))


def q_kmeans_dedup(spark, sf_dir):
    d = cu.cluster_and_dedup(Stages(spark, sf_dir, materialize=True).features, round_dp=9)
    return d.select("scenario_id", "cluster", "cluster_distance")


# -- catalog, marts, panels -------------------------------------------------


def _catalog(spark, sf_dir, needs: tuple[str, ...] = ("tracks", "events")) -> Catalog:
    """Catalog over the fixture with the tables a request needs; curated
    tables (which run the clustering) only when asked for."""
    curated = "curated_manifest" in needs or "curated" in needs
    st = Stages(spark, sf_dir, materialize=curated or "vectors" in needs)
    man = _manifest(spark, sf_dir, st=st) if curated else None
    return Catalog(
        spark,
        tracks=st.tracks,
        events=st.events if "events" in needs else None,
        features=st.features if "features" in needs else None,
        curated=cu.curated_tracks(st.tracks, man) if "curated" in needs else None,
        curated_manifest=man,
        vectors=sim.vector_table(st.features, st.events) if "vectors" in needs else None,
    )


def q_list_events(spark, sf_dir):
    return _catalog(spark, sf_dir).list_events()


def q_list_events_by_type(spark, sf_dir):
    return _catalog(spark, sf_dir).list_events(CUT_IN, 20)


def q_scenario_detail(spark, sf_dir):
    return _catalog(spark, sf_dir, ("tracks",)).scenario_detail(DETAIL_OF)


def q_stats_summary(spark, sf_dir):
    return _catalog(spark, sf_dir).stats_summary()


def q_stats_breakdown(spark, sf_dir):
    return _catalog(spark, sf_dir).stats_breakdown()


def q_adhoc_sql(spark, sf_dir):
    return marts.panel_default_query(_catalog(spark, sf_dir))


def q_stage_metrics(spark, sf_dir):
    c = _catalog(spark, sf_dir, ("tracks", "events", "features", "curated_manifest", "vectors"))
    m = stage_metrics(c.tracks, c.events, c.features, c.curated_manifest, c.vectors)
    return m.select("stage", "metric", _r("value"))


def _mart(fn, needs: tuple[str, ...] = ("tracks", "events")):
    def q(spark, sf_dir):
        return fn(_catalog(spark, sf_dir, needs))

    q.__name__ = f"q_{fn.__name__}"
    return q


def q_panel_yield(spark, sf_dir):
    return marts.panel_yield(_catalog(spark, sf_dir, ("tracks", "curated_manifest"))).select("raw", "curated", _r("yield_pct"))


def q_kmeans_invariants(spark, sf_dir):
    return cu.kmeans_invariants(Stages(spark, sf_dir, materialize=True).features)


def q_adhoc_sql_by_name(spark, sf_dir):
    """SQL by plain table name, in a session of its own so that the names of
    the caller's session stay."""
    cat = _catalog(spark.newSession(), sf_dir)
    cat.register()
    return cat.sql("SELECT event_type, COUNT(*) AS n, 'one {brace}' AS note FROM events GROUP BY event_type")


def q_sql_over_mart_view(spark, sf_dir):
    cat = _catalog(spark.newSession(), sf_dir)
    cat.register()
    return cat.sql(
        "SELECT f.event_type, f.event_count, SUM(s.count) AS binned FROM mart_event_frequency f"
        " JOIN mart_severity_distribution s ON s.event_type = f.event_type GROUP BY f.event_type, f.event_count"
    )


# -- the stored pipeline ------------------------------------------------------


def _stored(spark, sf_dir, *stages: str) -> Warehouse:
    """A new warehouse in the shared folder: the fixture as raw shards, then
    the batch jobs named, in order."""
    root = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    wh = Warehouse(f"{root}/warehouse")
    sinks.write_raw(_tracks(spark, sf_dir), f"{root}/raw")
    jobs.ingest(spark, f"{root}/raw", wh)
    for stage in stages:
        if stage == "curate":
            jobs.curate(spark, wh, fixed_centres=True, round_dp=9)
        elif stage == "embed":
            jobs.embed(spark, wh, DEFAULT.with_(vector_cell_rows=16))
        else:
            getattr(jobs, stage)(spark, wh)
    return wh


def q_stored_tracks(spark, sf_dir):
    return src.read_tracks(spark, _stored(spark, sf_dir).tracks)


def q_stored_tracks_appended(spark, sf_dir):
    """Two loads: the rows of egos, then those of all others, beside the shards
    that are taken already."""
    root = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    wh, tracks = Warehouse(f"{root}/warehouse"), _tracks(spark, sf_dir)
    sinks.write_raw(tracks.where("is_ego"), f"{root}/raw-1")
    sinks.write_raw(tracks.where("NOT is_ego"), f"{root}/raw-2")
    for part in ("raw-1", "raw-1", "raw-2"):
        jobs.append(spark, f"{root}/{part}", wh)
    return src.read_tracks(spark, wh.tracks)


def q_stored_events(spark, sf_dir):
    return src.read_events(spark, _stored(spark, sf_dir, "detect").events)


def q_stored_features(spark, sf_dir):
    f = src.read_features(spark, _stored(spark, sf_dir, "detect", "featurize").features)
    return f.select("scenario_id", *[_r(c) for c in FEATURE_OUT], "n_agents", "has_event")


def q_stored_curated_tracks(spark, sf_dir):
    wh = _stored(spark, sf_dir, "detect", "featurize", "curate")
    return src.read_table(spark, wh.curated)


def q_stored_vectors(spark, sf_dir):
    v = src.read_vectors(spark, _stored(spark, sf_dir, "detect", "featurize", "embed").vectors)
    return v.select(
        "scenario_id", *_vector_cols(v), *[_r(c) for c in FEATURE_OUT], "n_agents", "has_event", "event_types"
    )


def q_stored_scenario_detail(spark, sf_dir):
    wh = _stored(spark, sf_dir)
    return Catalog.from_warehouse(spark.newSession(), wh.root).request("scenario", scenario_id=DETAIL_OF)


def q_stored_similar(spark, sf_dir):
    wh = _stored(spark, sf_dir, "detect", "featurize", "embed")
    near = Catalog.from_warehouse(spark.newSession(), wh.root).request("similar", scenario_id=SIMILAR_TO, limit=5)
    return near.select("scenario_id", "event_types", _r("mean_speed"), _r("max_decel"), _r("_distance"))


def q_stored_metrics(spark, sf_dir):
    """The metrics that the jobs of one run wrote."""
    wh = _stored(spark, sf_dir, "detect", "featurize", "curate", "embed")
    wanted = ("row_count", "scenario_count", "event_count", "feature_count", "event_rate", "curated_scenarios", "indexed_scenarios")
    m = src.read_table(spark, wh.metrics).where(F.col("metric").isin(*wanted))
    return m.select("stage", "metric", _r("value"))


# -- contracts --------------------------------------------------------------


def q_violations_tracks(spark, sf_dir):
    return ct.violation_report(plant_bad_tracks(_tracks(spark, sf_dir)), ct.TRACK_CONTRACT)


def q_violations_events(spark, sf_dir):
    e = _events(spark, sf_dir)
    bad = e.withColumn(
        "severity",
        F.when(F.col("event_type") == CUT_IN, F.col("severity") + 1).otherwise(F.col("severity")),
    )
    return ct.violation_report(bad, ct.EVENT_CONTRACT)


def q_violations_features(spark, sf_dir):
    f = _features(spark, sf_dir)
    bad = f.withColumn(
        "n_agents", F.when(F.col("has_event"), F.lit(0).cast("bigint")).otherwise(F.col("n_agents"))
    )
    return ct.violation_report(bad, ct.FEATURE_CONTRACT)


QUERIES: dict[str, Query] = {
    "tracks": q_tracks,
    "speed_accel": q_speed_accel,
    "step_distance": q_step_distance,
    "integrate_positions": q_integrate_positions,
    "fill_dimensions": q_fill_dimensions,
    "bucket_counts": q_bucket_counts,
    "bucket_range": q_bucket_range,
    "hard_brakes": q_hard_brakes,
    "cut_ins": q_cut_ins,
    "near_misses": q_near_misses,
    "all_events": q_all_events,
    "ego_features": q_ego_features,
    "agent_counts": q_agent_counts,
    "features": q_features,
    "event_rate": q_event_rate,
    "event_scenarios": q_event_scenarios,
    "scaled_features": q_scaled_features,
    "embeddings": q_embeddings,
    "event_lists": q_event_lists,
    "vector_table": q_vector_table,
    "knn": q_knn,
    "primary_events": q_primary_events,
    "nearest_per_cluster": q_nearest_per_cluster,
    "stratified_sample": q_stratified_sample,
    "stratified_sample_all_capped": q_stratified_sample_all_capped,
    "curated_manifest": q_curated_manifest,
    "curated_tracks": q_curated_tracks,
    "curation_yield": q_curation_yield,
    "dedup_report": q_dedup_report,
    "kmeans_dedup": q_kmeans_dedup,
    "list_events": q_list_events,
    "list_events_by_type": q_list_events_by_type,
    "scenario_detail": q_scenario_detail,
    "stats_summary": q_stats_summary,
    "stats_breakdown": q_stats_breakdown,
    "adhoc_sql": q_adhoc_sql,
    "stage_metrics": q_stage_metrics,
    "mart_event_frequency": _mart(marts.mart_event_frequency),
    "mart_severity_distribution": _mart(marts.mart_severity_distribution),
    "mart_agent_types": _mart(marts.mart_agent_types, ("tracks",)),
    "mart_data_engine_yield": _mart(marts.mart_data_engine_yield, ("tracks", "features", "curated_manifest")),
    "mart_scenario_complexity": _mart(marts.mart_scenario_complexity),
    "panel_summary": _mart(marts.panel_summary),
    "panel_events_by_type": _mart(marts.panel_events_by_type),
    "panel_severity": _mart(marts.panel_severity),
    "panel_agents": _mart(marts.panel_agents, ("tracks",)),
    "panel_yield": q_panel_yield,
    "kmeans_invariants": q_kmeans_invariants,
    "adhoc_sql_by_name": q_adhoc_sql_by_name,
    "sql_over_mart_view": q_sql_over_mart_view,
    "stored_tracks": q_stored_tracks,
    "stored_tracks_appended": q_stored_tracks_appended,
    "stored_events": q_stored_events,
    "stored_features": q_stored_features,
    "stored_curated_tracks": q_stored_curated_tracks,
    "stored_vectors": q_stored_vectors,
    "stored_scenario_detail": q_stored_scenario_detail,
    "stored_similar": q_stored_similar,
    "stored_metrics": q_stored_metrics,
    "violations_tracks": q_violations_tracks,
    "violations_events": q_violations_events,
    "violations_features": q_violations_features,
}
