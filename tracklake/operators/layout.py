"""Physical layout of tracks: the scenario bucket key and its balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions import bucket_of
from tracklake.schemas import BUCKET_COL
from tracklake.settings import DEFAULT, Settings


def add_partition_key(tracks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``scenario_bucket`` INT in 0..n-1, the same for every row of a scenario."""
    return tracks.withColumn(BUCKET_COL, bucket_of("scenario_id", settings.scenario_bucket_count))


def bucket_counts(tracks: DataFrame) -> DataFrame:
    """Rows per bucket, buckets ascending."""
    return (
        tracks.groupBy(BUCKET_COL)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(BUCKET_COL)
    )


def bucket_range(counts: DataFrame) -> DataFrame:
    """Number of buckets and the smallest and largest bucket."""
    return counts.agg(
        F.count(F.lit(1)).alias("n_buckets"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
    )


def layout_summary(tracks: DataFrame) -> DataFrame:
    """One row: rows, scenarios, buckets and the smallest and largest bucket,
    from one aggregation (a scenario lies in one bucket)."""
    per = tracks.groupBy(BUCKET_COL).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("scenario_id").alias("scenarios"))
    return per.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("scenarios"), F.lit(0)).alias("scenario_count"),
        F.count(F.lit(1)).alias("n_buckets"),
        F.min("rows").alias("min_bucket_rows"),
        F.max("rows").alias("max_bucket_rows"),
    )
