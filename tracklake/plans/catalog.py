"""Scenario catalog: the serving requests over tracks, events, features,
curated tracks and the vector table (event listing, scenario detail,
statistics, ad-hoc SQL, similar scenarios)."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.functions import bucket_value, speed
from tracklake.operators.similar import search_similar
from tracklake.operators.vector_index import VectorIndex
from tracklake.schemas import BUCKET_COL
from tracklake.settings import DEFAULT, Settings


@dataclass
class Catalog:
    spark: SparkSession
    tracks: DataFrame
    events: DataFrame
    features: DataFrame | None = None
    curated: DataFrame | None = None
    curated_manifest: DataFrame | None = None
    vectors: DataFrame | None = None
    vector_index: VectorIndex | None = None
    settings: Settings = field(default_factory=lambda: DEFAULT)

    @classmethod
    def from_warehouse(cls, spark: SparkSession, warehouse: str, settings: Settings = DEFAULT) -> "Catalog":
        """Tracks and events always (events empty when not yet detected);
        features, curated tracks, manifest and vectors when present. The
        tables and marts are registered as temp views of ``spark``, so SQL by
        plain name works at once; pass ``spark.newSession()`` to keep the
        names out of a session that uses them otherwise."""
        from tracklake.plans.jobs import Warehouse
        from tracklake.sources import warehouse as src

        wh = Warehouse(warehouse)
        cat = cls(
            spark,
            tracks=src.read_tracks(spark, wh.tracks),
            events=src.read_events(spark, wh.events),
            features=src.optional_table(spark, wh.features),
            curated=src.optional_table(spark, wh.curated),
            curated_manifest=src.optional_table(spark, wh.manifest),
            vectors=src.optional_vectors(spark, wh.vectors),
            vector_index=src.read_vector_index(spark, wh.vectors),
            settings=settings,
        )
        cat.register()
        return cat

    # -- views -----------------------------------------------------------
    def frames(self) -> dict[str, DataFrame]:
        named = {
            "tracks": self.tracks,
            "events": self.events,
            "features": self.features,
            "curated": self.curated,
            "curated_manifest": self.curated_manifest,
            "vectors": self.vectors,
        }
        return {k: v for k, v in named.items() if v is not None}

    def register(self, prefix: str = "") -> list[str]:
        """Register the present tables, and the marts whose tables are
        present, as temp views ``prefix + name``."""
        from tracklake.plans.marts import mart_views

        views = self.frames() | mart_views(self)
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + name for name in views]

    def sql(self, text: str) -> DataFrame:
        """Ad-hoc SQL over registered names. ``{tracks}``, ``{events}``, ...
        name the tables of this catalog whatever is registered; braces in
        string literals, and any other braces, stay as they are."""
        frames, views = self.frames(), {}

        def name(m: re.Match) -> str:
            table = m.group("table")
            if table not in frames:
                return m.group()
            if table not in views:
                views[table] = f"catalog_{uuid.uuid4().hex}_{table}"
                frames[table].createOrReplaceTempView(views[table])
            return views[table]

        # A quoted part is matched first and left alone.
        bound = re.sub(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|\{(?P<table>\w+)\}""", lambda m: name(m) if m.group("table") else m.group(), text)
        try:
            return self.spark.sql(bound)
        finally:
            for view in views.values():  # the plan is resolved by now
                self.spark.catalog.dropTempView(view)

    # -- requests --------------------------------------------------------
    def list_events(self, event_type: str | None = None, limit: int = 20) -> DataFrame:
        """Events by rounded severity, highest first (ties by id), top ``limit``."""
        ev = self.events
        if event_type:
            ev = ev.where(F.col("event_type") == F.lit(event_type))
        out = ev.select(
            "scenario_id",
            "object_id",
            "event_type",
            "timestep_start",
            "timestep_end",
            F.round("severity", 3).alias("severity"),
        )
        return out.orderBy(
            F.col("severity").desc(),
            F.col("scenario_id").asc(),
            F.col("object_id").asc(),
            F.col("event_type").asc(),
        ).limit(limit)

    def scenario_detail(self, scenario_id: str) -> DataFrame:
        """Per object of one scenario: first and last timestep, mean speed."""
        t = self.tracks.where(F.col("scenario_id") == F.lit(scenario_id))
        if BUCKET_COL in self.tracks.columns:
            # Partition pruning: only the scenario's bucket folder is read.
            bucket = bucket_value(scenario_id, self.settings.scenario_bucket_count)
            t = t.where(F.col(BUCKET_COL) == F.lit(bucket))
        return (
            t.groupBy("object_id", "object_type", "is_ego")
            .agg(
                F.min("timestep").alias("t_start"),
                F.max("timestep").alias("t_end"),
                F.round(F.avg(speed()), 2).alias("avg_speed"),
            )
            .orderBy(F.col("is_ego").desc(), F.col("object_id").asc())
        )

    def stats_summary(self) -> DataFrame:
        evs = self.events.select(
            F.struct(F.count(F.lit(1)).alias("n"), F.countDistinct("scenario_id").alias("s"))
        ).scalar()
        return self.tracks.agg(F.countDistinct("scenario_id").alias("total_scenarios")).select(
            "total_scenarios",
            evs.getField("n").alias("total_events"),
            evs.getField("s").alias("scenarios_with_events"),
        )

    def stats_breakdown(self) -> DataFrame:
        return (
            self.events.groupBy("event_type")
            .agg(
                F.count(F.lit(1)).alias("count"),
                F.round(F.avg("severity"), 3).alias("avg_severity"),
                F.round(F.max("severity"), 3).alias("max_severity"),
            )
            .orderBy(F.col("count").desc(), F.col("event_type").asc())
        )

    def similar(self, scenario_id: str, k: int = 5) -> DataFrame:
        """The k nearest scenarios, by the stored index if there is one."""
        if self.vectors is None:
            raise ValueError("no vector table in the catalog")
        if self.vector_index is not None:
            res = self.vector_index.search(scenario_id, k)
        else:
            res = search_similar(self.vectors, scenario_id, k)
        return res.select("scenario_id", "event_types", "mean_speed", "max_decel", "_distance")

    def request(self, kind: str, **kw) -> DataFrame | tuple[DataFrame, DataFrame]:
        """Dispatch one catalog request: stats, similar, scenario, sql, events."""
        if kind == "stats":
            return self.stats_summary(), self.stats_breakdown()
        if kind == "similar":
            return self.similar(kw["scenario_id"], kw.get("limit", 20))
        if kind == "scenario":
            return self.scenario_detail(kw["scenario_id"])
        if kind == "sql":
            return self.sql(kw["text"])
        if kind == "events":
            return self.list_events(kw.get("event_type"), kw.get("limit", 20))
        raise ValueError(f"unknown request {kind!r}")
