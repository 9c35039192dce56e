"""End-to-end batch run through the warehouse, and plan-shape checks."""

import os

import pytest
from pyspark.sql import functions as F
from conftest import SF01, SF001

from tracklake.plans.catalog import Catalog
from tracklake.plans.jobs import Warehouse, run_pipeline
from tracklake.sinks import write_raw
from tracklake.sources import warehouse as src
from tracklake.sources.fixture import fixture_tracks


def test_empty_raw_dir(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "raw"))
    with pytest.raises(FileNotFoundError):
        src.read_raw_shards(spark, os.path.join(tmpdir_path, "raw"))


def test_missing_events_read_as_empty(spark, tmpdir_path):
    ev = src.read_events(spark, os.path.join(tmpdir_path, "nothing"))
    assert ev.count() == 0 and len(ev.columns) == 6


def test_full_pipeline(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    write_raw(fixture_tracks(spark, SF001), raw)
    m = run_pipeline(spark, raw, os.path.join(tmpdir_path, "wh"))
    assert m["tracks"]["row_count"] == 1000
    assert m["tracks"]["scenario_count"] == 10
    assert m["events"]["event_count"] == 10
    assert m["events"]["hard_brake_count"] == 2
    assert m["features"]["feature_count"] == 10
    # k = min(50, 10) = 10 clusters of one: nothing is removed, nothing capped
    assert m["curated"]["curated_scenarios"] == 10
    assert m["embeddings"]["indexed_scenarios"] == 10
    assert m["embeddings"]["probe_neighbours"] == 5

    wh = Warehouse(os.path.join(tmpdir_path, "wh"))
    tracks = src.read_tracks(spark, wh.tracks)
    assert dict(tracks.dtypes)["scenario_bucket"] == "int"
    # every scenario lives in exactly one bucket folder
    per = tracks.groupBy("scenario_id").agg(F.countDistinct("scenario_bucket").alias("n"))
    assert per.where(F.col("n") > 1).count() == 0
    metrics = src.read_table(spark, wh.metrics)
    assert metrics.select("stage").distinct().count() == 5
    assert metrics.select("run_id").distinct().count() == 1

    cat = Catalog(
        spark,
        tracks=tracks,
        events=src.read_events(spark, wh.events),
        features=src.read_features(spark, wh.features),
        curated_manifest=src.read_table(spark, wh.manifest),
        vectors=src.read_vectors(spark, wh.vectors),
    )
    detail = cat.scenario_detail("sc_00003")
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scenario_bucket" in plan
    assert "PushedFilters: [IsNotNull(scenario_id), EqualTo(scenario_id,sc_00003)]" in plan
    assert detail.count() == 4
    sim = cat.similar("sc_00003", 3).collect()
    assert len(sim) == 3
    # a second run replaces the tables and adds its metrics
    run_pipeline(spark, raw, os.path.join(tmpdir_path, "wh"))
    metrics = src.read_table(spark, wh.metrics)
    assert metrics.select("run_id").distinct().count() == 2
    assert metrics.groupBy("run_id", "stage", "metric").count().where("count > 1").count() == 0


def test_column_pruning_on_events_scan(spark, tmpdir_path):
    from tracklake.operators.events import detect_events
    from tracklake.sinks import write_tracks
    from tracklake.operators.layout import add_partition_key

    wh = Warehouse(tmpdir_path)
    write_tracks(add_partition_key(fixture_tracks(spark, SF001)), wh.tracks)
    ev = detect_events(src.read_tracks(spark, wh.tracks))
    plan = ev._jdf.queryExecution().executedPlan().toString()
    # speed inputs and positions are read; dimensions, validity, timestamps are not
    assert "length_m" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert ev.count() == 10


def test_catalog_from_warehouse_optional_tables(spark, tmpdir_path):
    from tracklake.operators.layout import add_partition_key
    from tracklake.sinks import write_tracks

    wh = Warehouse(tmpdir_path)
    write_tracks(add_partition_key(fixture_tracks(spark, SF001)), wh.tracks)
    cat = Catalog.from_warehouse(spark, tmpdir_path)
    assert cat.features is None and cat.curated_manifest is None and cat.vectors is None
    assert cat.events.count() == 0
    assert sorted(cat.frames()) == ["events", "tracks"]
    assert cat.stats_summary().first().total_scenarios == 10


def test_valid_only_setting(spark):
    from tracklake.operators.events import detect_events
    from tracklake.settings import DEFAULT

    t = fixture_tracks(spark, SF001)
    all_ev = detect_events(t).count()
    valid_ev = detect_events(t, DEFAULT.with_(valid_only=True)).count()
    assert valid_ev <= all_ev and all_ev == 10


def test_valid_only_with_a_shared_ego(spark):
    """A shared ego frame drops invalid rows as the rest does."""
    from helpers import ego_track, frame
    from tracklake.operators.events import detect_events
    from tracklake.operators.features import build_features
    from tracklake.operators.kinematics import ego_kinematics
    from tracklake.settings import DEFAULT

    rows = ego_track("v", [20.0, 20.0, 5.0, 20.0])
    rows[2] = (*rows[2][:-1], False)
    t, s = frame(spark, rows), DEFAULT.with_(valid_only=True)
    assert detect_events(t).count() == 1
    ego = ego_kinematics(t, s)
    assert detect_events(t, s).count() == detect_events(t, s, ego=ego).count() == 0
    none = detect_events(t, s)
    assert build_features(t, none, s).collect() == build_features(t, none, s, ego=ego).collect()


def test_curated_tracks_prune_bucket_folders(spark, tmpdir_path):
    """Curated tracks on the bucketed table read only the buckets of the
    curated ids (a partition filter on the scan)."""
    from tracklake.operators.curate import curated_tracks
    from tracklake.operators.layout import add_partition_key
    from tracklake.sinks import write_tracks

    wh = Warehouse(tmpdir_path)
    write_tracks(add_partition_key(fixture_tracks(spark, SF001)), wh.tracks)
    t = src.read_tracks(spark, wh.tracks)
    ids = spark.createDataFrame([("sc_00003",)], "scenario_id STRING")
    ct = curated_tracks(t, ids)
    rows = ct.collect()
    assert {r.scenario_id for r in rows} == {"sc_00003"} and len(rows) == 100
    plan = ct._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scenario_bucket" in plan and "scenario_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "IN (6)" in plan or "= 6)" in plan


def test_ingest_validating_while_writing(spark, tmpdir_path):
    from tracklake.operators.contracts import ContractError
    from tracklake.plans.jobs import ingest
    from tracklake.settings import DEFAULT
    from tracklake.sources.fixture import plant_bad_tracks

    one_pass = DEFAULT.with_(validate_while_writing=True)
    good = os.path.join(tmpdir_path, "good")
    write_raw(fixture_tracks(spark, SF001), good)
    m = ingest(spark, good, Warehouse(os.path.join(tmpdir_path, "wh1")), one_pass)
    assert m["row_count"] == 1000
    bad = os.path.join(tmpdir_path, "bad")
    write_raw(plant_bad_tracks(fixture_tracks(spark, SF001)), bad)
    with pytest.raises(ContractError) as ex:
        ingest(spark, bad, Warehouse(os.path.join(tmpdir_path, "wh2")), one_pass)
    got = {(c, k): n for _, c, k, n in ex.value.failures}
    assert got == {
        ("object_type", "in (VEHICLE,PEDESTRIAN,CYCLIST)"): 6,
        ("heading", "<= 4.0"): 33,
        ("length_m", "> 0.0"): 9,
    }
    # a good table survives a bad load, and nothing is left beside it
    with pytest.raises(ContractError):
        ingest(spark, bad, Warehouse(os.path.join(tmpdir_path, "wh1")), one_pass)
    assert src.read_tracks(spark, os.path.join(tmpdir_path, "wh1", "tracks")).where("object_type = 'TRUCK'").count() == 0
    m = ingest(spark, good, Warehouse(os.path.join(tmpdir_path, "wh1")), one_pass)
    assert m["row_count"] == 1000 and not os.path.exists(os.path.join(tmpdir_path, "wh1", "tracks__staged"))
    # the default validates before writing: nothing lands for bad input
    with pytest.raises(ContractError):
        ingest(spark, bad, Warehouse(os.path.join(tmpdir_path, "wh3")))
    assert not os.path.exists(os.path.join(tmpdir_path, "wh3", "tracks"))


def test_track_files_of_a_bucket_hold_disjoint_ids(spark, tmpdir_path):
    from tracklake.operators.layout import add_partition_key
    from tracklake.sinks import write_tracks

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_tracks(add_partition_key(fixture_tracks(spark, SF01)), tmpdir_path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    t = src.read_tracks(spark, tmpdir_path).withColumn("f", F.input_file_name())
    spans = t.groupBy("scenario_bucket", "f").agg(F.min("scenario_id").alias("a"), F.max("scenario_id").alias("b")).collect()
    for x in spans:
        for y in spans:
            if x.f < y.f and x.scenario_bucket == y.scenario_bucket:
                assert x.b <= y.a or y.b <= x.a
    assert len(spans) > 32


def test_sql_by_name_on_a_warehouse(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    write_raw(fixture_tracks(spark, SF001), raw)
    run_pipeline(spark, raw, os.path.join(tmpdir_path, "wh"))
    cat = Catalog.from_warehouse(spark.newSession(), os.path.join(tmpdir_path, "wh"))
    n = cat.request("sql", text="SELECT count(*) AS n, '{events} {x' AS note FROM events").first()
    assert (n.n, n.note) == (10, "{events} {x")
    assert cat.sql("SELECT count(*) AS n, \"it's {tracks}\" AS t FROM {tracks}").first().asDict() == {"n": 1000, "t": "it's {tracks}"}
    for mart in ("event_frequency", "severity_distribution", "agent_types", "data_engine_yield", "scenario_complexity"):
        assert cat.sql(f"SELECT * FROM mart_{mart}").count() > 0, mart
    assert not spark.newSession().catalog.tableExists("mart_event_frequency")
