"""Features, standardisation, embeddings, similarity, curation."""

import math

import pytest
from helpers import ego_track, frame, row
from pyspark.sql import functions as F

from tracklake.operators import curate as cu
from tracklake.operators import features as ft
from tracklake.operators import similar as sim
from tracklake.operators import space as sp
from tracklake.operators.events import detect_events
from tracklake.schemas import EVENTS, FEATURES
from tracklake.settings import DEFAULT, FEATURE_COLS


def test_single_row_ego_features(spark):
    tracks = frame(spark, ego_track("one", [12.0]))
    f = ft.build_features(tracks, detect_events(tracks)).collect()[0]
    assert f.mean_speed == 12.0 and f.max_speed == 12.0
    assert f.max_decel == 0.0 and f.trajectory_length == 0.0 and f.heading_variance == 0.0
    assert f.n_agents == 1 and f.has_event is False


def test_agent_count_and_flags(spark):
    rows = ego_track("s", [10.0, 10.0, 10.0], x_of=lambda t: 3.0 * t)
    for a in range(3):
        rows += [row("s", t, f"s_agent_0{a}", x=200.0 + a) for t in range(3)]
    rows += [row("none", 0, "none_agent_00")]  # no ego: no feature row
    tracks = frame(spark, rows)
    f = ft.build_features(tracks, spark.createDataFrame([], EVENTS)).collect()
    assert len(f) == 1
    assert f[0].n_agents == 4 and f[0].has_event is False
    assert f[0].trajectory_length == pytest.approx(6.0)


def test_event_rate(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, 0.0, 1.0, 0.0, 2, True), ("b", 1.0, 1.0, 0.0, 1.0, 0.0, 2, False)], FEATURES
    )
    assert ft.event_rate(df).first()[0] == 0.5
    assert ft.event_rate(spark.createDataFrame([], FEATURES)).first()[0] == 0.0


def _features(spark, n, seed=42):
    import random

    rnd = random.Random(seed)
    rows = [
        (
            f"sc_{i:05d}",
            rnd.uniform(10, 20),
            rnd.uniform(15, 30),
            rnd.uniform(-8, 0),
            rnd.uniform(50, 200),
            rnd.uniform(0, 0.5),
            rnd.randint(2, 9),
            i % 3 == 0,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, FEATURES)


def test_standardize_population_std_and_constant(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 5.0, 0.0, 1.0, 0.0, 3, True), ("b", 2.0, 5.0, 0.0, 1.0, 0.0, 3, True),
         ("c", 4.0, 5.0, 0.0, 1.0, 0.0, 3, True)],
        FEATURES,
    )
    z = {r.scenario_id: r for r in sp.standardize(df).collect()}
    std = math.sqrt(((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3)
    assert z["a"].z_mean_speed == pytest.approx((1 - 7 / 3) / std)
    # constant columns scale by 1, so they centre to 0
    assert z["a"].z_max_speed == 0.0 and z["c"].z_n_agents == 0.0


def test_zero_vector_for_single_scenario(spark):
    df = _features(spark, 1)
    v = sp.embed(sp.standardize(df)).first()
    assert [v[c] for c in sp.V_COLS] == [0.0] * 6


def test_unit_vectors(spark):
    v = sp.embed(sp.standardize(_features(spark, 30))).collect()
    for r in v:
        assert sum(r[c] ** 2 for c in sp.V_COLS) == pytest.approx(1.0)


def test_event_lists(spark):
    ev = spark.createDataFrame(
        [("s", "o1", "CUT_IN", 1, 2, 0.5), ("s", "o2", "NEAR_MISS", 1, 2, 0.5),
         ("s", "o3", "CUT_IN", 3, 4, 0.1)],
        EVENTS,
    )
    assert sim.event_lists(ev).collect()[0].event_types == "CUT_IN,NEAR_MISS"
    f = _features(spark, 3)
    vt = {r.scenario_id: r.event_types for r in sim.vector_table(f, ev).collect()}
    assert set(vt.values()) == {"none"}


def test_vector_table_schema(spark):
    vt = sim.vector_table(_features(spark, 5), spark.createDataFrame([], EVENTS))
    assert vt.schema["vector"].dataType.simpleString() == "array<float>"
    assert vt.columns[:2] == ["scenario_id", "vector"]


def test_search_similar(spark):
    vt = sim.vector_table(_features(spark, 40), spark.createDataFrame([], EVENTS))
    res = sim.search_similar(vt, "sc_00003", 5).collect()
    assert len(res) == 5
    assert all(r.scenario_id != "sc_00003" for r in res)
    d = [r._distance for r in res]
    assert d == sorted(d)
    # brute force over all rows
    q = [float(x) for x in vt.where(F.col("scenario_id") == "sc_00003").first().vector]
    allrows = [(sum((float(a) - b) ** 2 for a, b in zip(r.vector, q)), r.scenario_id)
               for r in vt.collect() if r.scenario_id != "sc_00003"]
    assert [r.scenario_id for r in res] == [s for _, s in sorted(allrows)[:5]]


def test_search_unknown_id(spark):
    vt = sim.vector_table(_features(spark, 4), spark.createDataFrame([], EVENTS))
    with pytest.raises(ValueError):
        sim.search_similar(vt, "nope", 3)


def test_kmeans_dedup_reduces(spark):
    df = _features(spark, 100)
    d = cu.cluster_and_dedup(df)
    rows = d.collect()
    assert 0 < len(rows) < 100
    per = {}
    for r in rows:
        per[r.cluster] = per.get(r.cluster, 0) + 1
    assert len(per) <= 50 and max(per.values()) <= 2


def _brute_kmeans(points, k, starts, seed, tol, rounds=300):
    """Lloyd on integers, start by start."""
    import hashlib

    best = None
    for s in range(starts):
        order = sorted(points, key=lambda r: (hashlib.md5(f"{r[0]}:{seed + s}".encode()).hexdigest(), r[1]))
        centres = [r[1] for r in order[:k]]
        near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c)), i) for i, c in enumerate(centres))  # noqa: E731, B023
        for _ in range(rounds):
            held = {}
            for _, p in points:
                held.setdefault(near(p)[1], []).append(p)
            new = [
                tuple((2 * sum(v) + len(v)) // (2 * len(v)) for v in zip(*held[i])) if i in held else centres[i]
                for i in range(len(centres))
            ]
            moved = sum((a - b) ** 2 for c, d in zip(new, centres) for a, b in zip(c, d))
            centres = new
            if moved <= tol:
                break
        cost = sum(near(p)[0] for _, p in points)
        if best is None or cost < best[0]:
            best = (cost, s, centres)
    return best[2]


def test_kmeans_against_plain_lloyd(spark):
    """Also with repeated points (empty clusters), outliers and tol = 0."""
    import random

    from tracklake.operators import kmeans

    rng = random.Random(3)
    rows = [(f"s{i}", tuple(rng.randrange(-3, 4) * 50_000 + rng.randrange(9_000) for _ in range(6))) for i in range(120)]
    rows += [(f"d{i}", (7, 7, 7, 7, 7, 7)) for i in range(40)] + [("far", (1 << 28, -(1 << 28), 0, 0, 0, 0))]
    df = spark.createDataFrame([(i, *p) for i, p in rows], "scenario_id string, " + ", ".join(f"p{j} long" for j in range(6)))
    for tol in (0.0, 1e-4):
        s = DEFAULT.with_(kmeans_starts=4, kmeans_tol=tol)
        want = _brute_kmeans(rows, 12, 4, s.seed, int(tol * (1 << 32)))
        for parts in (1, 7):
            points = df.repartition(parts)
            assert kmeans.lloyd(points, kmeans.first_centres(points, 12, s), s).tolist() == [list(c) for c in want]


def test_kmeans_follows_the_rows_alone(spark):
    """The same centres for any partitioning; one job a round."""
    df = _features(spark, 300)
    fits = []
    for d in (df.coalesce(1), df.repartition(9), df.orderBy(F.desc("mean_speed"))):
        fits.append(sp.fit_centres(d, sp.scaler_stats(d).first(), 20))
    assert fits[0] == fits[1] == fits[2] and len(fits[0]) == 20


def test_kmeans_of_odd_rows(spark):
    df = _features(spark, 8)
    same = df.withColumn("mean_speed", F.lit(1.0))
    assert len(sp.fit_centres(same, sp.scaler_stats(same).first(), 8)) == 8
    holed = df.withColumn("max_speed", F.when(F.col("scenario_id") == "sc_00003", float("nan")).otherwise(F.col("max_speed")))
    assert len(sp.fit_centres(holed, sp.scaler_stats(df).first(), 8)) == 7


def test_fixed_centre_dedup_keeps_closest(spark):
    df = _features(spark, 100)
    kept = cu.cluster_and_dedup(df, fixed_centres=True)
    allc = sp.assign_clusters(sp.standardize(df), sp.first_rows_as_centres(sp.standardize(df), 50))
    full = sorted((r.cluster, r.cluster_distance, r.scenario_id) for r in allc.collect())
    expect = []
    seen = {}
    for c, dist, sid in full:
        seen[c] = seen.get(c, 0) + 1
        if seen[c] <= 2:
            expect.append(sid)
    assert sorted(r.scenario_id for r in kept.collect()) == sorted(expect)


def test_primary_event_and_sample(spark):
    ev = spark.createDataFrame(
        [("sc_00000", "o", "HARD_BRAKE", 1, 2, 0.5), ("sc_00000", "o", "CUT_IN", 1, 2, 0.5)], EVENTS
    )
    assert cu.primary_events(ev).first().primary_event == "CUT_IN"
    f = _features(spark, 30)
    s = cu.stratified_sample(f, ev, cap=5)
    ids = {r.scenario_id for r in s.collect()}
    assert "sc_00000" in ids and len(ids) == 6
    assert s.columns == f.columns
    s2 = cu.stratified_sample(f, ev, cap=5, keep_all_rare=False)
    assert s2.count() == 6


def test_sample_without_events_is_uncapped(spark):
    f = _features(spark, 30)
    s = cu.stratified_sample(f, spark.createDataFrame([], EVENTS), cap=5)
    assert s.count() == 30


def test_sample_is_deterministic_across_partitionings(spark):
    f = _features(spark, 50)
    ev = spark.createDataFrame([("sc_00001", "o", "CUT_IN", 1, 2, 0.5)], EVENTS)
    a = {r.scenario_id for r in cu.stratified_sample(f.repartition(7), ev, cap=10).collect()}
    b = {r.scenario_id for r in cu.stratified_sample(f.coalesce(1), ev, cap=10).collect()}
    assert a == b and len(a) == 11


def test_feature_cols_order():
    assert FEATURE_COLS == (
        "mean_speed", "max_speed", "max_decel", "trajectory_length", "n_agents", "heading_variance"
    )


def test_copies_collapse_exactly(spark):
    """Identical ego rows (copies) give the same features and events as the
    row-by-row definition: a copy follows an identical row (accel 0, step 0)
    and weighs in means and the variance."""
    import statistics

    speeds = [10.0, 10.0, 9.0, 3.0, 3.5, 3.5]
    heads = [0.1, 0.2, 0.2, 0.4, 0.1, 0.3]
    base = [row("d", t, "d_ego", ego=True, x=1.5 * t, vx=v, heading=h)
            for t, (v, h) in enumerate(zip(speeds, heads))]
    mult = [1, 3, 1, 4, 1, 2]
    rows = [r for r, k in zip(base, mult) for _ in range(k)]
    tracks = frame(spark, rows)
    f = ft.build_features(tracks, detect_events(tracks)).collect()[0]
    # expected, row by row in timestep order
    seq = [(v, h, t) for t, (v, h, k) in enumerate(zip(speeds, heads, mult)) for _ in range(k)]
    acc = [(b[0] - a[0]) / 0.1 for a, b in zip(seq, seq[1:])]
    steps = [1.5 * (b[2] - a[2]) for a, b in zip(seq, seq[1:])]
    assert f.mean_speed == pytest.approx(sum(v for v, _, _ in seq) / len(seq))
    assert f.max_decel == pytest.approx(min(acc))
    assert f.trajectory_length == pytest.approx(sum(steps))
    assert f.heading_variance == pytest.approx(statistics.variance([h for _, h, _ in seq]))
    hb = [r for r in detect_events(tracks).collect() if r.event_type == "HARD_BRAKE"]
    assert [(r.timestep_start, r.timestep_end) for r in hb] == [(2, 3)]
    assert hb[0].severity == 1.0
    from tracklake.operators.kinematics import step_distance

    assert step_distance(tracks).count() == len(rows)


def test_variance_of_close_headings_with_copies(spark):
    """Repeats must not cost accuracy: the spread is 1e-8 of the value."""
    import statistics
    from fractions import Fraction

    h = [3.0 + i * 1e-8 for i in range(20)] + [3.0 + 4e-8] * 3
    rows = [row("v", min(i, 4 if i >= 20 else i), "v_ego", ego=True, heading=x) for i, x in enumerate(h)]
    rows = rows[:20] + [rows[4]] * 3
    want = float(statistics.variance([Fraction(r[8]) for r in rows]))
    assert ft.ego_features(frame(spark, rows)).first().heading_variance == pytest.approx(want, rel=1e-6)


def test_fit_does_not_follow_the_session(spark):
    feats = _features(spark, 300).cache()
    before, kept = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            kept.append(sorted(r.scenario_id for r in cu.cluster_and_dedup(feats).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert kept[0] == kept[1]
