"""Scenario vectors and exact nearest-neighbour search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.operators.space import V_COLS, embed, standardize
from tracklake.settings import FEATURE_COLS, NO_EVENT_LIST


def event_lists(events: DataFrame) -> DataFrame:
    """Sorted distinct event types per scenario, comma-joined."""
    return events.groupBy("scenario_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("event_types")
    )


def vector_table(features: DataFrame, events: DataFrame) -> DataFrame:
    """One row per scenario: id, unit vector (FLOAT), the six features,
    has_event and its event list (``none`` without events)."""
    emb = embed(standardize(features))
    lists = event_lists(events)
    return emb.join(lists, on="scenario_id", how="left").select(
        "scenario_id",
        F.array(*[F.col(v) for v in V_COLS]).cast("array<float>").alias("vector"),
        *[
            F.col(c).cast("bigint").alias(c) if c == "n_agents" else F.col(c)
            for c in FEATURE_COLS
        ],
        "has_event",
        F.coalesce(F.col("event_types"), F.lit(NO_EVENT_LIST)).alias("event_types"),
    )


def search_similar(vectors: DataFrame, scenario_id: str, k: int = 5) -> DataFrame:
    """The k scenarios nearest to ``scenario_id`` by squared L2 distance of
    their vectors (``_distance``), the query itself excluded; exact scan.

    Raises ``ValueError`` when the id is not in the table.
    """
    target = vectors.where(F.col("scenario_id") == F.lit(scenario_id)).select("vector").limit(1)
    if target.isEmpty():
        raise ValueError(f"Scenario {scenario_id} not found")
    return nearest(vectors, scenario_id, target.scalar(), k)  # one value computed once


def nearest(vectors: DataFrame, scenario_id: str, q: Column | list[float] | None, k: int) -> DataFrame:
    """The k rows nearest to the vector ``q`` of ``scenario_id``, without it."""
    if not isinstance(q, Column):
        q = F.lit(None).cast("array<float>") if q is None else F.array(*[F.lit(x).cast("float") for x in q])
    d = None
    for i in range(len(V_COLS)):
        diff = F.get("vector", F.lit(i)).cast("double") - F.get(q, F.lit(i)).cast("double")
        d = diff * diff if d is None else d + diff * diff
    scored = vectors.where(F.col("scenario_id") != F.lit(scenario_id)).withColumn("_distance", d)
    return scored.orderBy(F.col("_distance").asc(), F.col("scenario_id").asc()).limit(k)


__all__ = ["event_lists", "vector_table", "search_similar", "nearest"]
