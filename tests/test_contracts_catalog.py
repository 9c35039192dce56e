"""Contracts, catalog requests, marts and panels."""

import pytest
from helpers import frame, row
from pyspark.sql import functions as F

from tracklake.operators import contracts as ct
from tracklake.plans import marts
from tracklake.plans.catalog import Catalog
from tracklake.schemas import EVENTS, FEATURES, TRACKS


def test_valid_tracks_and_event_pass(spark):
    t = frame(spark, [row("s", 0, "s_ego", ego=True), row("s", 1, "s_ego", ego=True)])
    ct.validate_tracks(t)
    e = spark.createDataFrame([("sc_00717", "sc_00717_ego", "NEAR_MISS", 3, 41, 0.35)], EVENTS)
    ct.validate_events(e)


def test_bad_event_type_rejected(spark):
    e = spark.createDataFrame([("sc_00717", "sc_00717_ego", "SWERVE", 3, 41, 0.35)], EVENTS)
    with pytest.raises(ct.ContractError) as ex:
        ct.validate_events(e)
    assert ex.value.failures == [("events", "event_type", "in (HARD_BRAKE,CUT_IN,NEAR_MISS)", 1)]


def test_one_violation_each(spark):
    e = spark.createDataFrame([("s", "o", "CUT_IN", 1, 2, 1.2)], EVENTS)
    rep = {(r.column_name, r.check_name): r.violations for r in ct.violation_report(e, ct.EVENT_CONTRACT).collect()}
    assert rep[("severity", "<= 1.0")] == 1 and sum(rep.values()) == 1
    bad = [
        row("s", -1, "o"),
        row("s", 1, "o", otype="TRUCK"),
        row("s", 2, "o", heading=5.0),
        row("s", 3, "o", width=0.0),
    ]
    t = frame(spark, bad).union(spark.createDataFrame([(None, 4, 0.4, "o", "VEHICLE", False, 0.0, 0.0, 0.0, 0.0, 0.0, 4.5, 2.0, True)], TRACKS))
    rep = {(r.column_name, r.check_name): r.violations for r in ct.violation_report(t, ct.TRACK_CONTRACT).collect()}
    nonzero = {k: v for k, v in rep.items() if v}
    assert nonzero == {
        ("timestep", ">= 0"): 1,
        ("timestamp_s", ">= 0.0"): 1,
        ("object_type", "in (VEHICLE,PEDESTRIAN,CYCLIST)"): 1,
        ("heading", "<= 4.0"): 1,
        ("width_m", "> 0.0"): 1,
        ("scenario_id", "not_null"): 1,
    }


def test_wrong_type_and_missing_column(spark):
    e = spark.createDataFrame([("s", "o", "CUT_IN", 1, 2)], "scenario_id STRING, object_id STRING, event_type STRING, timestep_start INT, timestep_end BIGINT")
    with pytest.raises(ct.ContractError) as ex:
        ct.validate_events(e)
    checks = {(c, k) for _, c, k, _ in ex.value.failures}
    assert ("timestep_start", "type bigint") in checks and ("severity", "present") in checks


def test_feature_contract(spark):
    f = spark.createDataFrame([("a", 1.0, 1.0, 0.0, 1.0, 0.0, 0, True)], FEATURES)
    with pytest.raises(ct.ContractError):
        ct.validate_features(f)


def _catalog(spark):
    tracks = frame(
        spark,
        [row("a", t, "a_ego", ego=True, vx=3.0, vy=4.0) for t in range(3)]
        + [row("a", t, "a_agent_00", otype="PEDESTRIAN", vx=1.0) for t in range(3)]
        + [row("b", t, "b_ego", ego=True, vx=1.0) for t in range(2)],
    )
    events = spark.createDataFrame(
        [
            ("a", "a_agent_00", "CUT_IN", 0, 2, 0.0),
            ("a", "a_agent_00", "NEAR_MISS", 0, 1, 0.2),
            ("a", "a_ego", "HARD_BRAKE", 1, 1, 0.4),
            ("b", "b_ego", "HARD_BRAKE", 1, 1, 1.0),
            ("b", "b_ego", "CUT_IN", 1, 1, 0.6),
            ("b", "b_ego", "CUT_IN", 1, 1, 0.8),
        ],
        EVENTS,
    )
    feats = spark.createDataFrame(
        [("a", 5.0, 5.0, 0.0, 1.0, 0.0, 2, True), ("b", 1.0, 1.0, 0.0, 1.0, 0.0, 1, True)], FEATURES
    )
    man = feats.where(F.col("scenario_id") == "a")
    return Catalog(spark, tracks=tracks, events=events, features=feats, curated_manifest=man)


def test_histogram_edges(spark):
    cat = _catalog(spark)
    h = {(r.event_type, r.severity_bucket): r["count"] for r in marts.mart_severity_distribution(cat).collect()}
    assert h == {
        ("CUT_IN", "0.0-0.2"): 1,
        ("NEAR_MISS", "0.2-0.4"): 1,
        ("HARD_BRAKE", "0.4-0.6"): 1,
        ("HARD_BRAKE", "0.8-1.0"): 1,
        ("CUT_IN", "0.6-0.8"): 1,
        ("CUT_IN", "0.8-1.0"): 1,
    }


def test_catalog_requests(spark):
    cat = _catalog(spark)
    top = cat.list_events(limit=2).collect()
    assert [(r.scenario_id, r.event_type, r.severity) for r in top] == [
        ("b", "HARD_BRAKE", 1.0), ("b", "CUT_IN", 0.8)
    ]
    assert cat.list_events("NEAR_MISS").count() == 1
    det = cat.scenario_detail("a").collect()
    assert [(r.object_id, r.is_ego, r.t_start, r.t_end, r.avg_speed) for r in det] == [
        ("a_ego", True, 0, 2, 5.0), ("a_agent_00", False, 0, 2, 1.0)
    ]
    s = cat.stats_summary().first()
    assert (s.total_scenarios, s.total_events, s.scenarios_with_events) == (2, 6, 2)
    assert cat.sql("SELECT count(*) AS n FROM {events} WHERE event_type = 'CUT_IN'").first().n == 3
    cat.register(prefix="t_")
    assert spark.sql("SELECT count(*) FROM t_tracks").first()[0] == 8
    stats, breakdown = cat.request("stats")
    assert breakdown.first().event_type in ("CUT_IN", "HARD_BRAKE")


def test_yield_definitions(spark):
    cat = _catalog(spark)
    y = marts.mart_data_engine_yield(cat).first()
    assert (y.total_scenarios, y.featurized, y.curated_count, y.yield_pct) == (2, 2, 1, 50.0)
    p = marts.panel_yield(cat).first()
    assert p.yield_pct == 50.0
    empty = Catalog(
        spark,
        tracks=spark.createDataFrame([], TRACKS),
        events=spark.createDataFrame([], EVENTS),
        features=spark.createDataFrame([], FEATURES),
        curated_manifest=cat.curated_manifest,
    )
    assert marts.mart_data_engine_yield(empty).first().yield_pct is None
    assert marts.panel_yield(empty).first().yield_pct == 100.0


def test_complexity_top_n(spark):
    # a and b both have 3 events; the tie breaks by id
    r = marts.mart_scenario_complexity(_catalog(spark), top=1).collect()
    assert [(x.scenario_id, x.event_count, x.event_types, x.worst_severity) for x in r] == [("a", 3, 3, 0.4)]


def test_event_contract_report_property(spark):
    """Random events (NULLs, NaN, out-of-range values, unknown types): each
    rule's count equals a row-by-row count."""
    import math

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    sev = st.one_of(st.none(), st.just(float("nan")), st.floats(min_value=-1, max_value=2, allow_nan=False))
    row_st = st.tuples(
        st.one_of(st.none(), st.just("s")),
        st.just("o"),
        st.one_of(st.none(), st.sampled_from(["HARD_BRAKE", "CUT_IN", "NEAR_MISS", "OTHER"])),
        st.one_of(st.none(), st.integers(min_value=-3, max_value=3)),
        st.integers(min_value=-3, max_value=3),
        sev,
    )

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows=st.lists(row_st, min_size=1, max_size=25))
    def check(rows):
        df = spark.createDataFrame(rows, EVENTS)
        rep = {(r.column_name, r.check_name): r.violations for r in ct.violation_report(df, ct.EVENT_CONTRACT).collect()}
        names = ["scenario_id", "object_id", "event_type", "timestep_start", "timestep_end", "severity"]
        for i, n in enumerate(names):
            assert rep[(n, "not_null")] == sum(r[i] is None for r in rows)
        assert rep[("event_type", "in (HARD_BRAKE,CUT_IN,NEAR_MISS)")] == sum(r[2] == "OTHER" for r in rows)
        assert rep[("timestep_start", ">= 0")] == sum(r[3] is not None and r[3] < 0 for r in rows)
        assert rep[("timestep_end", ">= 0")] == sum(r[4] < 0 for r in rows)
        bad_lo = sum(r[5] is not None and (math.isnan(r[5]) or r[5] < 0) for r in rows)
        bad_hi = sum(r[5] is not None and (math.isnan(r[5]) or r[5] > 1) for r in rows)
        assert rep[("severity", ">= 0.0")] == bad_lo and rep[("severity", "<= 1.0")] == bad_hi

    check()


def test_request_dispatch_all_kinds(spark):
    from tracklake.operators.similar import vector_table

    cat = _catalog(spark)
    cat.vectors = vector_table(cat.features, cat.events)
    assert cat.request("events", event_type="CUT_IN", limit=1).count() == 1
    assert cat.request("scenario", scenario_id="a").count() == 2
    assert cat.request("sql", text="SELECT count(*) AS n FROM {tracks}").first().n == 8
    sim = cat.request("similar", scenario_id="a", limit=5)
    assert sim.columns == ["scenario_id", "event_types", "mean_speed", "max_decel", "_distance"]
    assert [r.scenario_id for r in sim.collect()] == ["b"]
    summary, breakdown = cat.request("stats")
    assert summary.count() == 1 and breakdown.count() == 3
    with pytest.raises(ValueError):
        cat.request("nope")
