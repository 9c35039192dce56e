"""Table schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

TRACKS = T.StructType(
    [
        T.StructField("scenario_id", T.StringType()),
        T.StructField("timestep", T.LongType()),
        T.StructField("timestamp_s", T.DoubleType()),
        T.StructField("object_id", T.StringType()),
        T.StructField("object_type", T.StringType()),
        T.StructField("is_ego", T.BooleanType()),
        T.StructField("position_x", T.DoubleType()),
        T.StructField("position_y", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("velocity_x", T.DoubleType()),
        T.StructField("velocity_y", T.DoubleType()),
        T.StructField("length_m", T.DoubleType()),
        T.StructField("width_m", T.DoubleType()),
        T.StructField("valid", T.BooleanType()),
    ]
)

BUCKET_COL = "scenario_bucket"

PARTITIONED_TRACKS = T.StructType(
    TRACKS.fields + [T.StructField(BUCKET_COL, T.IntegerType())]
)

EVENTS = T.StructType(
    [
        T.StructField("scenario_id", T.StringType()),
        T.StructField("object_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestep_start", T.LongType()),
        T.StructField("timestep_end", T.LongType()),
        T.StructField("severity", T.DoubleType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("scenario_id", T.StringType()),
        T.StructField("mean_speed", T.DoubleType()),
        T.StructField("max_speed", T.DoubleType()),
        T.StructField("max_decel", T.DoubleType()),
        T.StructField("trajectory_length", T.DoubleType()),
        T.StructField("heading_variance", T.DoubleType()),
        T.StructField("n_agents", T.LongType()),
        T.StructField("has_event", T.BooleanType()),
    ]
)

VECTORS = T.StructType(
    [
        T.StructField("scenario_id", T.StringType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("mean_speed", T.DoubleType()),
        T.StructField("max_speed", T.DoubleType()),
        T.StructField("max_decel", T.DoubleType()),
        T.StructField("trajectory_length", T.DoubleType()),
        T.StructField("n_agents", T.LongType()),
        T.StructField("heading_variance", T.DoubleType()),
        T.StructField("has_event", T.BooleanType()),
        T.StructField("event_types", T.StringType()),
    ]
)
