"""Track fixture derived from the driver's click-stream ``events`` table.

The test data has no trajectory table, so tracks are derived from it: a block
of 100 event ids is one scenario of 4 objects x 25 steps, object 0 is the ego.
Every source row becomes one track row. Some rows move, so that scenarios
differ: agent counts vary (rows of an object go on another object's later
steps), some egos have one row only, some have repeated rows, and in some the
ego flag is set from step 5 on. All arithmetic is on integers followed by one
division, so the doubles equal those of the SQL form in FIXTURES.md bit for
bit. The work grows with the events table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value")


def derive_tracks(source_events: DataFrame) -> DataFrame:
    """Per-timestep object tracks (the 14 contract columns), as the SQL
    expressions of FIXTURES.md (one JVM-side parse per column)."""
    raw = source_events.selectExpr(
        "CAST(floor(CAST(event_id AS DOUBLE) / 100) AS BIGINT) AS sc",
        "CAST(floor(CAST(event_id % 100 AS DOUBLE) / 25) AS BIGINT) AS o",
        "event_id % 25 AS s",
        "CAST(round(value * 100) AS BIGINT) AS v",
    )
    lone, two, one = "o = 0 AND sc % 10 = 7 AND s > 0", "o = 3 AND sc % 4 = 1", "o = 2 AND sc % 6 = 1"
    again = "o = 0 AND sc % 9 = 4 AND s >= 20"
    base = raw.selectExpr(
        "sc",
        f"CASE WHEN {lone} THEN 1 WHEN {two} THEN 2 WHEN {one} THEN 1 ELSE o END AS ob",
        f"CASE WHEN {lone} THEN s + 50 WHEN {two} OR {one} THEN s + 25 WHEN {again} THEN 20 ELSE s END AS t",
        f"CASE WHEN {again} THEN 777 ELSE v END AS c",
    )
    # At least five digits; longer numbers are kept whole.
    sid = "'sc_' || lpad(CAST(sc AS STRING), greatest(5, length(CAST(sc AS STRING))), '0')"
    ped = "ob = 2 AND sc % 2 = 1"
    late = "sc % 8 = 5 AND t < 5"
    return base.selectExpr(
        f"{sid} AS scenario_id",
        "CAST(t AS BIGINT) AS timestep",
        "CAST(t AS DOUBLE) / 10 AS timestamp_s",
        f"{sid} || CASE WHEN ob = 0 THEN '_ego' ELSE '_agent_0' || CAST(ob - 1 AS STRING) END AS object_id",
        f"CASE WHEN {ped} THEN 'PEDESTRIAN' WHEN ob = 3 THEN 'CYCLIST' ELSE 'VEHICLE' END AS object_type",
        f"ob = 0 AND NOT ({late}) AS is_ego",
        """CAST(CASE WHEN ob = 0 THEN t * 100
                    WHEN ob = 2 AND sc % 5 = 0 THEN t * 100 + c % 300
                    ELSE t * 100 + ob * 400 - 600 + c % 400 END AS DOUBLE) / 100 AS position_x""",
        """CAST(CASE WHEN ob = 0 THEN c % 10
                    WHEN ob = 1 AND sc % 3 = 0 THEN 800 - t * 25
                    WHEN ob = 2 AND sc % 5 = 0 THEN 50 + c % 100
                    ELSE 2000 + c % 500 END AS DOUBLE) / 100 AS position_y""",
        "CAST((sc % 7 - 3) * 500 + c % 20 AS DOUBLE) / 1000 AS heading",
        f"""CAST(1000 + sc % 11 * 50 + c % 30 + CASE WHEN ob = 0 AND {late} THEN 1000 ELSE 0 END
               - CASE WHEN ob = 0 AND sc % 7 = 0 AND t >= 10
                      THEN 60 * (CASE WHEN t < 18 THEN t - 9 ELSE 9 END) ELSE 0 END
               AS DOUBLE) / 100 AS velocity_x""",
        "CAST(c % 7 AS DOUBLE) / 100 AS velocity_y",
        f"CASE WHEN {ped} THEN CAST(0.5 AS DOUBLE) WHEN ob = 3 THEN CAST(1.8 AS DOUBLE) ELSE CAST(4.5 AS DOUBLE) END AS length_m",
        f"CASE WHEN {ped} THEN CAST(0.5 AS DOUBLE) WHEN ob = 3 THEN CAST(0.7 AS DOUBLE) ELSE CAST(2.0 AS DOUBLE) END AS width_m",
        "c % 50 <> 0 AS valid",
    )


def fixture_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_tracks(read_source_events(spark, sf_dir))


def plant_bad_tracks(tracks: DataFrame) -> DataFrame:
    """Tracks with the contract violations listed in FIXTURES.md planted."""
    return tracks.select(
        *[
            F.when(~F.col("valid"), F.lit("TRUCK")).otherwise(F.col(c)).alias(c)
            if c == "object_type"
            else F.when(F.col("timestep") == 24, F.col(c) + 10).otherwise(F.col(c)).alias(c)
            if c == "heading"
            else F.when(F.col("is_ego") & (F.col("timestep") == 0), F.lit(0.0)).otherwise(F.col(c)).alias(c)
            if c == "length_m"
            else F.col(c)
            for c in tracks.columns
        ]
    )
