"""Invariants on the fixture and plan-shape checks."""

from conftest import SF01
from pyspark.sql import functions as F

import __spark_entry__ as E
from tracklake.operators.events import detect_events
from tracklake.plans.catalog import Catalog
from tracklake.plans.suite import Stages
from tracklake.sources.fixture import fixture_tracks


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_every_near_miss_is_a_cut_in(spark):
    ev = detect_events(fixture_tracks(spark, SF01))
    nm = ev.where(F.col("event_type") == "NEAR_MISS").select("scenario_id", "object_id")
    ci = ev.where(F.col("event_type") == "CUT_IN").select("scenario_id", "object_id")
    assert nm.count() > 0
    assert nm.join(ci, ["scenario_id", "object_id"], "left_anti").count() == 0


def test_filtered_listing_prunes_hard_brake_branch(spark):
    t = fixture_tracks(spark, SF01)
    cat = Catalog(spark, tracks=t, events=detect_events(t))
    plan = _final_plan(cat.list_events("CUT_IN"))
    assert "Window [" not in plan  # the ordered hard-brake pass is not planned
    assert "TakeOrderedAndProject" in plan


def test_agent_mart_does_not_expand_rows(spark):
    assert "Expand" not in _final_plan(E.queries()["mart_agent_types"](spark, SF01))


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Exchange hashpartitioning(scenario_id")


def test_ordered_pass_shuffles(spark):
    """speed_accel: one shuffle of the collapse and one of the window over the
    narrow rows; the other three move one row per chunk of a track. The plan
    has no action behind it and is the same whatever the chunk size."""
    from tracklake.operators.kinematics import speed_accel
    from tracklake.settings import DEFAULT

    t = fixture_tracks(spark, SF01)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for s in (DEFAULT, DEFAULT.with_(timestep_chunk=4)):
            assert _exchanges(speed_accel(t, s, columns=()))[0] == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_knn_is_top_k_with_scalar_query_vector(spark):
    plan = _final_plan(E.queries()["knn"](spark, SF01))
    assert "TakeOrderedAndProject" in plan and "Subquery" in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_no_sort_aggregate_or_nested_loop_join(spark):
    for name in ("features", "curated_manifest", "stats_summary", "mart_data_engine_yield", "scaled_features"):
        plan = _final_plan(E.queries()[name](spark, SF01))
        assert "SortAggregate" not in plan, name
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_shared_stages_agree(spark):
    st = Stages(spark, SF01)
    assert st.events.count() == 97 and st.features.count() == 98
    assert st.features.where("has_event").count() == 52


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["scenario_id", "object_id", "event_type", "timestep_start", "timestep_end", "severity"]
    assert df.count() == 10


def test_every_query_has_oracle_or_is_documented():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from tracklake.plans.suite import QUERIES

    assert set(QUERIES) <= set(o)


def test_skew_paths_equal_default_paths(spark):
    """Tiny timestep chunks (carry across chunks on every track) and the
    range-partitioned exact rank give the same events, features and curated
    set as the default plans."""
    from tracklake.operators import curate as cu
    from tracklake.operators.features import build_features
    from tracklake.settings import DEFAULT

    t = fixture_tracks(spark, SF01)
    skew = DEFAULT.with_(timestep_chunk=4, rank_partitions=5)
    ev_a, ev_b = detect_events(t), detect_events(t, skew)
    assert sorted(ev_a.collect()) == sorted(ev_b.collect())
    f_a, f_b = build_features(t, ev_a), build_features(t, ev_b, skew)
    assert sorted(f_a.collect()) == sorted(f_b.collect())
    d_a = cu.cluster_and_dedup(f_a, fixed_centres=True, round_dp=9)
    d_b = cu.cluster_and_dedup(f_b, skew, fixed_centres=True, round_dp=9)
    assert sorted(d_a.collect()) == sorted(d_b.collect()) and d_a.count() == 50
    s_a = cu.stratified_sample(d_a, ev_a, cap=20)
    s_b = cu.stratified_sample(d_b, ev_b, skew, cap=20)
    assert sorted(s_a.collect()) == sorted(s_b.collect()) and s_a.count() == 47
