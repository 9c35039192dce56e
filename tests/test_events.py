"""Event rules on hand-computed frames (exact expected rows)."""

from helpers import ego_track, frame, pair_scene, row

from tracklake.operators.events import (
    detect_cut_ins,
    detect_events,
    detect_hard_brakes,
    detect_near_misses,
)
from tracklake.operators.kinematics import speed_accel


def events_of(df):
    return sorted(
        (r.event_type, r.object_id, r.timestep_start, r.timestep_end, round(r.severity, 12))
        for r in df.collect()
    )


def test_hard_brake_found(spark):
    # 12 m/s for four steps, then 11.5, 9, 9, 6.2 m/s: accelerations -5, -25, 0, -28
    speeds = [12.0, 12.0, 12.0, 12.0, 11.5, 9.0, 9.0, 6.2]
    ev = detect_hard_brakes(frame(spark, ego_track("fast", speeds)))
    assert events_of(ev) == [("HARD_BRAKE", "fast_ego", 4, 7, 1.0)]
    acc = speed_accel(frame(spark, ego_track("fast", speeds)))
    low = min(r.accel_ms2 for r in acc.collect() if r.accel_ms2 is not None)
    assert round(low, 9) == -28.0


def test_hard_brake_where_the_ego_flag_changes(spark):
    """The row before counts, ego or not; the event needs an ego row."""
    rows = [
        row("m", 0, "m_obj", vx=20.0), row("m", 1, "m_obj", ego=True, vx=10.0), row("m", 2, "m_obj", ego=True, vx=10.0),
        row("m", 3, "m_obj", vx=2.0), row("m", 4, "m_obj", ego=True, vx=2.0),
    ]
    assert events_of(detect_hard_brakes(frame(spark, rows))) == [("HARD_BRAKE", "m_obj", 1, 1, 1.0)]
    from tracklake.operators.features import ego_features
    from tracklake.settings import DEFAULT

    for s in (DEFAULT, DEFAULT.with_(timestep_chunk=1)):
        assert detect_hard_brakes(frame(spark, rows), s).count() == 1
        # features go from ego row to ego row: 10, 10, 2 m/s
        assert ego_features(frame(spark, rows), s).first().max_decel == -80.0


def test_copies_of_odd_speeds(spark):
    """The difference of a NaN, infinite or NULL speed to itself is no 0."""
    import math

    from tracklake.operators.features import ego_features

    for odd, want in ((float("nan"), True), (float("inf"), True), (None, None)):
        base = list(row("n", 1, "n_ego", ego=True, vx=0.0))
        base[9] = odd
        t = frame(spark, [row("n", 0, "n_ego", ego=True, vx=1.0), tuple(base), tuple(base)])
        got = [r.accel_ms2 for r in speed_accel(t).collect() if r.timestep == 1]
        assert len(got) == 2 and all((a is None) if want is None else math.isnan(a) or math.isinf(a) for a in got)
        assert 0.0 not in got
        assert ego_features(t).first().max_decel != 0.0


def test_a_million_copies_of_one_row(spark):
    from pyspark.sql import functions as F

    from tracklake.operators.kinematics import integrate_positions

    one = frame(spark, [row("c", 1, "c_ego", ego=True, vx=2.0, vy=1.0)])
    many = one.crossJoin(spark.range(1_000_000).select()).union(frame(spark, [row("c", 0, "c_ego", ego=True, vx=1.0)]))
    acc = speed_accel(many, columns=()).agg(F.count("*"), F.max("accel_ms2"), F.count_if(F.col("accel_ms2") == 0)).first()
    assert acc[0] == 1_000_001 and acc[1] > 12 and acc[2] == 999_999
    last = integrate_positions(many, columns=()).agg(F.max("x_integrated"), F.max("y_integrated")).first()
    assert abs(last[0] - 200_000.1) < 1e-3 and abs(last[1] - 100_000) < 1e-3


def test_no_false_positive(spark):
    assert detect_hard_brakes(frame(spark, ego_track("smooth", [15.0] * 20))).count() == 0


def test_threshold_is_strict(spark):
    # (0.0 - 0.4) / 0.1 is exactly -4.0: no event
    assert detect_hard_brakes(frame(spark, ego_track("s", [0.4, 0.0]))).count() == 0
    # (9.6 - 10.0) / 0.1 is -4.0000000000000036: an event
    ev = events_of(detect_hard_brakes(frame(spark, ego_track("s", [10.0, 9.6]))))
    assert ev == [("HARD_BRAKE", "s_ego", 1, 1, 0.4)]


def test_first_row_has_no_accel(spark):
    acc = speed_accel(frame(spark, ego_track("one", [12.0]))).collect()
    assert acc[0].accel_ms2 is None
    assert detect_hard_brakes(frame(spark, ego_track("one", [12.0]))).count() == 0


def test_agent_braking_is_not_an_event(spark):
    rows = ego_track("a", [10.0] * 5) + [
        row("a", t, "a_agent_00", vx=v, x=50.0) for t, v in enumerate([20.0, 10.0, 0.0, 0.0, 0.0])
    ]
    assert detect_hard_brakes(frame(spark, rows)).count() == 0


def test_cut_in_inside_and_edges(spark):
    inside = frame(spark, pair_scene("c", [(14.9, 1.0)]))
    assert events_of(detect_cut_ins(inside)) == [("CUT_IN", "c_agent_00", 0, 0, 0.8)]
    assert detect_cut_ins(frame(spark, pair_scene("c", [(15.0, 1.0)]))).count() == 0
    assert detect_cut_ins(frame(spark, pair_scene("c", [(1.0, 5.0)]))).count() == 0


def test_near_miss_is_also_cut_in(spark):
    ev = events_of(detect_events(frame(spark, pair_scene("n", [(0.0, 1.0)]))))
    assert ev == [("CUT_IN", "n_agent_00", 0, 0, 0.8), ("NEAR_MISS", "n_agent_00", 0, 0, 0.5)]


def test_near_miss_edge(spark):
    df = frame(spark, pair_scene("e", [(2.0, 0.0)]))
    assert detect_near_misses(df).count() == 0
    assert events_of(detect_cut_ins(df)) == [("CUT_IN", "e_agent_00", 0, 0, 1.0)]


def test_gap_spans_one_event(spark):
    offs = [None] * 12
    offs[3] = (1.0, 1.0)
    offs[9] = (3.0, 2.0)
    ev = events_of(detect_cut_ins(frame(spark, pair_scene("g", offs))))
    assert ev == [("CUT_IN", "g_agent_00", 3, 9, 0.8)]


def test_no_ego_no_event(spark):
    rows = [row("x", t, "x_agent_00", x=0.0, y=0.0) for t in range(3)] + [
        row("x", t, "x_agent_01", x=0.5, y=0.5) for t in range(3)
    ]
    assert detect_events(frame(spark, rows)).count() == 0


def test_invalid_rows_still_count(spark):
    rows = [row("v", 0, "v_ego", ego=True), row("v", 0, "v_agent_00", x=1.0, y=1.0, valid=False)]
    assert detect_cut_ins(frame(spark, rows)).count() == 1


def test_event_columns_and_types(spark):
    ev = detect_events(frame(spark, pair_scene("n", [(0.0, 1.0)])))
    assert ev.columns == ["scenario_id", "object_id", "event_type", "timestep_start", "timestep_end", "severity"]
    assert [f.dataType.simpleString() for f in ev.schema.fields] == [
        "string", "string", "string", "bigint", "bigint", "double"
    ]


def test_fixture_event_counts(spark):
    from conftest import SF01

    from tracklake.sources.fixture import fixture_tracks

    t = fixture_tracks(spark, SF01)
    assert t.count() == 10_000
    counts = {r.event_type: r["count"] for r in detect_events(t).groupBy("event_type").count().collect()}
    assert counts == {"HARD_BRAKE": 22, "CUT_IN": 48, "NEAR_MISS": 27}


def test_fixture_keeps_every_row_and_whole_ids(spark):
    from pyspark.sql import functions as F

    from tracklake.sources.fixture import derive_tracks

    source = spark.range(9_999_950, 10_000_450).select(F.col("id").alias("event_id"), F.lit(12.5).alias("value"))
    t = derive_tracks(source)
    ids = {r.scenario_id for r in t.select("scenario_id").distinct().collect()}
    assert t.count() == 500 and ids == {"sc_99999", *(f"sc_{i}" for i in range(100_000, 100_005))}


def test_per_row_operators_with_copies(spark):
    """speed_accel and integrate_positions keep one output row per input row
    when rows repeat, with the row-by-row values: a copy follows an identical
    row (acceleration 0) and adds its own v*dt to the running sum."""
    import pytest

    from tracklake.operators.kinematics import integrate_positions

    speeds = [10.0, 12.0, 7.0, 7.5]
    mult = [2, 1, 3, 1]
    base = [row("p", t, "p_agent_00", vx=v, vy=1.0) for t, v in enumerate(speeds)]
    rows = [r for r, k in zip(base, mult) for _ in range(k)]
    df = frame(spark, rows)
    seq = [v for v, k in zip(speeds, mult) for _ in range(k)]
    spd = [(v * v + 1.0) ** 0.5 for v in seq]
    acc = [(r.timestep, r.accel_ms2) for r in speed_accel(df).collect()]
    exp = sorted(
        [(t, None if i == 0 else (spd[i] - spd[i - 1]) / 0.1)
         for i, t in enumerate(t for t, k in enumerate(mult) for _ in range(k))],
        key=lambda x: (x[0], -1e18 if x[1] is None else x[1]),
    )
    got = sorted(acc, key=lambda x: (x[0], -1e18 if x[1] is None else x[1]))
    assert [t for t, _ in got] == [t for t, _ in exp]
    for (_, a), (_, b) in zip(got, exp):
        assert (a is None and b is None) or a == pytest.approx(b)
    ip = sorted((r.timestep, r.x_integrated, r.y_integrated) for r in integrate_positions(df).collect())
    run, want = 0.0, []
    for i, v in enumerate(seq):
        run += v * 0.1
        want.append(run)
    assert [x for _, x, _ in ip] == pytest.approx(want)
    assert [y for _, _, y in ip] == pytest.approx([0.1 * (i + 1) for i in range(len(seq))])
