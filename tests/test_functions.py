"""Scalar helpers against plain Python definitions."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklake.functions import bucket_of, bucket_value, clip01, severity_bin

VALUES = st.lists(
    st.one_of(st.none(), st.just(float("nan")), st.floats(min_value=-3, max_value=3, allow_nan=False)),
    min_size=1,
    max_size=30,
)


def _clip(x):
    if x is None or math.isnan(x):
        return x
    return min(1.0, max(0.0, x))


def _bin(x):
    for i, label in enumerate(("0.0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8")):
        if x is not None and not math.isnan(x) and x < round(0.2 * (i + 1), 1):
            return label
    return "0.8-1.0"


def test_clip_and_bins(spark):
    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(values=VALUES)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
        got = df.select(clip01("x").alias("c"), severity_bin("x").alias("b")).collect()
        for v, r in zip(values, got):
            want = _clip(v)
            assert (want is None and r.c is None) or (isinstance(want, float) and math.isnan(want) and math.isnan(r.c)) or r.c == want
            assert r.b == _bin(v)

    check()


def test_bucket_twins_agree(spark):
    ids = [f"sc_{i:05d}" for i in range(0, 2000, 37)] + ["", "x", "sc_99999_ego"]
    df = spark.createDataFrame([(i,) for i in ids], "scenario_id STRING")
    for n in (1, 7, 32, 4096):
        got = {r.scenario_id: r.b for r in df.select("scenario_id", bucket_of("scenario_id", n).alias("b")).collect()}
        assert got == {i: bucket_value(i, n) for i in ids}
        assert all(0 <= b < n for b in got.values())
    assert df.select(F.count_distinct(bucket_of("scenario_id", 32))).first()[0] > 16
