"""KPI marts and dashboard panels over the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions import severity_bin, speed
from tracklake.plans.catalog import Catalog


def _scenario_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.countDistinct("scenario_id").alias(name))


def mart_event_frequency(cat: Catalog) -> DataFrame:
    return (
        cat.events.groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("scenario_id").alias("scenarios_affected"),
            F.round(F.avg("severity"), 3).alias("avg_severity"),
            F.round(F.max("severity"), 3).alias("max_severity"),
            F.round(F.min("severity"), 3).alias("min_severity"),
        )
        .orderBy(F.col("event_count").desc(), F.col("event_type").asc())
    )


def _severity_hist(cat: Catalog, bin_name: str) -> DataFrame:
    return (
        cat.events.groupBy("event_type", severity_bin("severity").alias(bin_name))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("event_type", bin_name)
    )


def mart_severity_distribution(cat: Catalog) -> DataFrame:
    return _severity_hist(cat, "severity_bucket")


def _agents(cat: Catalog) -> DataFrame:
    """Rows and summed speed of each agent, by partial aggregation."""
    agents = cat.tracks.where(~F.col("is_ego"))
    return agents.groupBy("object_type", "object_id").agg(F.sum(speed()).alias("speeds"), F.count(speed()).alias("rows"))


def _agent_totals(cat: Catalog, name: str) -> DataFrame:
    return _agents(cat).groupBy("object_type").agg(
        F.count("object_id").alias(name), F.round(F.sum("speeds") / F.sum("rows"), 2).alias("avg_speed")
    )


def mart_agent_types(cat: Catalog) -> DataFrame:
    """Agents and scenarios are counted over one row each, in two branches
    joined on the type: two distinct counts in one aggregation would expand
    every row."""
    seen = cat.tracks.where(~F.col("is_ego")).select("object_type", "scenario_id").distinct()
    scenarios = seen.groupBy("object_type").agg(F.count("scenario_id").alias("scenarios_present"))
    scenarios = scenarios.withColumnRenamed("object_type", "_type")
    both = _agent_totals(cat, "unique_agents").join(scenarios, F.col("object_type").eqNullSafe(F.col("_type")))
    return both.select("object_type", "unique_agents", "scenarios_present", "avg_speed").orderBy(
        F.col("unique_agents").desc(), F.col("object_type").asc()
    )


def mart_data_engine_yield(cat: Catalog) -> DataFrame:
    """Scenarios in tracks, featurized scenarios, curated rows, and curated
    as a percentage of track scenarios (NULL without scenarios)."""
    feat = cat.features.select(F.countDistinct("scenario_id")).scalar()
    cur = cat.curated_manifest.select(F.count(F.lit(1))).scalar()
    total = _scenario_count(cat.tracks, "total_scenarios")
    return total.select(
        "total_scenarios",
        feat.alias("featurized"),
        cur.alias("curated_count"),
        F.round(
            cur.cast("double")
            * F.lit(100.0)
            / F.nullif(F.col("total_scenarios"), F.lit(0)).cast("double"),
            1,
        ).alias("yield_pct"),
    )


def mart_scenario_complexity(cat: Catalog, top: int = 50) -> DataFrame:
    return (
        cat.events.groupBy("scenario_id")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("event_type").alias("event_types"),
            F.round(F.max("severity"), 3).alias("worst_severity"),
        )
        .orderBy(F.col("event_count").desc(), F.col("scenario_id").asc())
        .limit(top)
    )


def panel_summary(cat: Catalog) -> DataFrame:
    s = cat.stats_summary()
    return s.select(
        F.col("total_scenarios").alias("scenarios"),
        F.col("total_events").alias("events"),
        F.col("scenarios_with_events").alias("with_events"),
    )


def panel_events_by_type(cat: Catalog) -> DataFrame:
    return (
        cat.events.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("count"), F.round(F.avg("severity"), 3).alias("avg_severity"))
        .orderBy(F.col("count").desc(), F.col("event_type").asc())
    )


def panel_severity(cat: Catalog) -> DataFrame:
    return _severity_hist(cat, "bucket")


def panel_agents(cat: Catalog) -> DataFrame:
    return _agent_totals(cat, "agents").orderBy(F.col("agents").desc(), F.col("object_type").asc())


def panel_yield(cat: Catalog) -> DataFrame:
    """Curated scenarios over max(track scenarios, 1), in percent."""
    cur = cat.curated_manifest.select(F.count(F.lit(1))).scalar()
    return _scenario_count(cat.tracks, "raw").select(
        "raw",
        cur.alias("curated"),
        (
            cur.cast("double") / F.greatest(F.col("raw"), F.lit(1)).cast("double") * F.lit(100.0)
        ).alias("yield_pct"),
    )


DEFAULT_ADHOC = "SELECT event_type, COUNT(*) AS n FROM {events} GROUP BY event_type"


def panel_default_query(cat: Catalog) -> DataFrame:
    return cat.sql(DEFAULT_ADHOC)


def mart_views(cat: Catalog) -> dict[str, DataFrame]:
    """The marts whose tables the catalog has, by view name."""
    views = {
        "mart_event_frequency": mart_event_frequency(cat),
        "mart_severity_distribution": mart_severity_distribution(cat),
        "mart_agent_types": mart_agent_types(cat),
        "mart_scenario_complexity": mart_scenario_complexity(cat),
    }
    if cat.features is not None and cat.curated_manifest is not None:
        views["mart_data_engine_yield"] = mart_data_engine_yield(cat)
    return views
