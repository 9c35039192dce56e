"""DuckDB oracle SQL for the named plans in ``tracklake.plans.suite``.

Each statement is built from named CTEs over the driver's pre-registered
``events`` view (click-stream rows). The track fixture is derived exactly as
FIXTURES.md states; detected safety events are called ``ev`` so that they do
not shadow the driver's ``events`` view.
"""

from __future__ import annotations

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTE[name] = (deps, body)


_cte(
    "base",
    (),
    """
  SELECT sc,
         CASE WHEN o = 0 AND sc % 10 = 7 AND s > 0 THEN 1 WHEN o = 3 AND sc % 4 = 1 THEN 2 WHEN o = 2 AND sc % 6 = 1 THEN 1 ELSE o END AS ob,
         CASE WHEN o = 0 AND sc % 10 = 7 AND s > 0 THEN s + 50
              WHEN (o = 3 AND sc % 4 = 1) OR (o = 2 AND sc % 6 = 1) THEN s + 25
              WHEN o = 0 AND sc % 9 = 4 AND s >= 20 THEN 20 ELSE s END AS t,
         CASE WHEN o = 0 AND sc % 9 = 4 AND s >= 20 THEN 777 ELSE v END AS c
  FROM (SELECT CAST(floor(CAST(event_id AS DOUBLE) / 100) AS BIGINT) AS sc,
               CAST(floor(CAST(event_id % 100 AS DOUBLE) / 25) AS BIGINT) AS o,
               event_id % 25 AS s,
               CAST(round(value * 100) AS BIGINT) AS v
        FROM events) r""",
)

_cte(
    "tracks",
    ("base",),
    """
  SELECT 'sc_' || lpad(CAST(sc AS STRING), CAST(greatest(5, length(CAST(sc AS STRING))) AS INTEGER), '0') AS scenario_id,
         CAST(t AS BIGINT) AS timestep,
         CAST(t AS DOUBLE) / 10 AS timestamp_s,
         'sc_' || lpad(CAST(sc AS STRING), CAST(greatest(5, length(CAST(sc AS STRING))) AS INTEGER), '0') || CASE WHEN ob = 0 THEN '_ego' ELSE '_agent_0' || CAST(ob - 1 AS STRING) END AS object_id,
         CASE WHEN ob = 2 AND sc % 2 = 1 THEN 'PEDESTRIAN' WHEN ob = 3 THEN 'CYCLIST' ELSE 'VEHICLE' END AS object_type,
         ob = 0 AND NOT (sc % 8 = 5 AND t < 5) AS is_ego,
         CAST(CASE WHEN ob = 0 THEN t * 100
                   WHEN ob = 2 AND sc % 5 = 0 THEN t * 100 + c % 300
                   ELSE t * 100 + ob * 400 - 600 + c % 400 END AS DOUBLE) / 100 AS position_x,
         CAST(CASE WHEN ob = 0 THEN c % 10
                   WHEN ob = 1 AND sc % 3 = 0 THEN 800 - t * 25
                   WHEN ob = 2 AND sc % 5 = 0 THEN 50 + c % 100
                   ELSE 2000 + c % 500 END AS DOUBLE) / 100 AS position_y,
         CAST((sc % 7 - 3) * 500 + c % 20 AS DOUBLE) / 1000 AS heading,
         CAST(1000 + sc % 11 * 50 + c % 30 + CASE WHEN ob = 0 AND sc % 8 = 5 AND t < 5 THEN 1000 ELSE 0 END
              - CASE WHEN ob = 0 AND sc % 7 = 0 AND t >= 10 THEN 60 * (CASE WHEN t < 18 THEN t - 9 ELSE 9 END) ELSE 0 END AS DOUBLE) / 100 AS velocity_x,
         CAST(c % 7 AS DOUBLE) / 100 AS velocity_y,
         CASE WHEN ob = 2 AND sc % 2 = 1 THEN CAST(0.5 AS DOUBLE) WHEN ob = 3 THEN CAST(1.8 AS DOUBLE) ELSE CAST(4.5 AS DOUBLE) END AS length_m,
         CASE WHEN ob = 2 AND sc % 2 = 1 THEN CAST(0.5 AS DOUBLE) WHEN ob = 3 THEN CAST(0.7 AS DOUBLE) ELSE CAST(2.0 AS DOUBLE) END AS width_m,
         c % 50 <> 0 AS valid
  FROM base""",
)

_cte(
    "btracks",
    ("tracks",),
    """
  SELECT *, CAST(CAST(('0x' || substr(md5(scenario_id), 1, 8)) AS BIGINT) % 32 AS INTEGER) AS scenario_bucket
  FROM tracks""",
)

_cte(
    "acc",
    ("tracks",),
    """
  SELECT *, (speed - lag(speed) OVER (PARTITION BY scenario_id, object_id ORDER BY timestep)) / CAST(0.1 AS DOUBLE) AS accel_ms2
  FROM (SELECT *, sqrt(velocity_x * velocity_x + velocity_y * velocity_y) AS speed FROM tracks) s""",
)

_cte(
    "hb",
    ("acc",),
    """
  SELECT scenario_id, object_id, 'HARD_BRAKE' AS event_type,
         min(timestep) AS timestep_start, max(timestep) AS timestep_end,
         greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), abs(min(accel_ms2)) / CAST(10 AS DOUBLE))) AS severity
  FROM acc WHERE is_ego AND accel_ms2 < CAST(-4 AS DOUBLE)
  GROUP BY scenario_id, object_id""",
)

_cte(
    "pairs",
    ("tracks",),
    """
  SELECT a.scenario_id, a.object_id, a.timestep,
         abs(a.position_x - e.position_x) AS dx,
         abs(a.position_y - e.position_y) AS dy,
         sqrt((a.position_x - e.position_x) * (a.position_x - e.position_x)
              + (a.position_y - e.position_y) * (a.position_y - e.position_y)) AS distance
  FROM tracks a JOIN tracks e ON a.scenario_id = e.scenario_id AND a.timestep = e.timestep
  WHERE NOT a.is_ego AND e.is_ego""",
)

_cte(
    "ci",
    ("pairs",),
    """
  SELECT scenario_id, object_id, 'CUT_IN' AS event_type,
         min(timestep) AS timestep_start, max(timestep) AS timestep_end,
         greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), CAST(1 AS DOUBLE) - min(dy) / CAST(5 AS DOUBLE))) AS severity
  FROM pairs WHERE dx < CAST(15 AS DOUBLE) AND dy < CAST(5 AS DOUBLE)
  GROUP BY scenario_id, object_id""",
)

_cte(
    "nm",
    ("pairs",),
    """
  SELECT scenario_id, object_id, 'NEAR_MISS' AS event_type,
         min(timestep) AS timestep_start, max(timestep) AS timestep_end,
         greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), CAST(1 AS DOUBLE) - min(distance) / CAST(2 AS DOUBLE))) AS severity
  FROM pairs WHERE distance < CAST(2 AS DOUBLE)
  GROUP BY scenario_id, object_id""",
)

_cte(
    "ev",
    ("hb", "ci", "nm"),
    """
  SELECT * FROM hb UNION ALL SELECT * FROM ci UNION ALL SELECT * FROM nm""",
)

_cte(
    "egok",
    ("tracks",),
    """
  SELECT *,
         (speed - lag(speed) OVER w) / CAST(0.1 AS DOUBLE) AS accel,
         sqrt((position_x - lag(position_x) OVER w) * (position_x - lag(position_x) OVER w)
              + (position_y - lag(position_y) OVER w) * (position_y - lag(position_y) OVER w)) AS step_dist
  FROM (SELECT *, sqrt(velocity_x * velocity_x + velocity_y * velocity_y) AS speed FROM tracks WHERE is_ego) s
  WINDOW w AS (PARTITION BY scenario_id, object_id ORDER BY timestep)""",
)

_cte(
    "ef",
    ("egok",),
    """
  SELECT scenario_id,
         avg(speed) AS mean_speed,
         max(CASE WHEN NOT isnan(speed) THEN speed END) AS max_speed,
         min(accel) AS max_decel,
         coalesce(sum(step_dist), CAST(0 AS DOUBLE)) AS trajectory_length,
         var_samp(heading) AS heading_variance
  FROM egok GROUP BY scenario_id""",
)

_cte(
    "ac",
    ("tracks",),
    """
  SELECT scenario_id, count(DISTINCT object_id) AS n_agents FROM tracks GROUP BY scenario_id""",
)

_cte(
    "feat",
    ("ef", "ac", "ev"),
    """
  SELECT ef.scenario_id, ef.mean_speed, ef.max_speed,
         coalesce(ef.max_decel, CAST(0 AS DOUBLE)) AS max_decel,
         ef.trajectory_length,
         coalesce(ef.heading_variance, CAST(0 AS DOUBLE)) AS heading_variance,
         CAST(ac.n_agents AS BIGINT) AS n_agents,
         es.scenario_id IS NOT NULL AS has_event
  FROM ef
  LEFT JOIN ac ON ef.scenario_id = ac.scenario_id
  LEFT JOIN (SELECT DISTINCT scenario_id FROM ev) es ON ef.scenario_id = es.scenario_id""",
)


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTE[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(uses: tuple[str, ...], select: str) -> str:
    parts = [f"{n} AS ({CTE[n][1]}\n)" for n in _order(uses)]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


def Q(x: str) -> str:
    """Snap to the 2^-20 grid, as the Spark plans do."""
    return f"(CAST(floor(({x}) * CAST(1048576 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS DOUBLE) / CAST(1048576 AS DOUBLE))"


def R(c: str) -> str:
    return f"{Q(c)} AS {c}"


FEATURE_OUT = ("mean_speed", "max_speed", "max_decel", "trajectory_length", "heading_variance")

ORACLE: dict[str, str] = {
    "tracks": sql(("btracks",), "SELECT * FROM btracks"),
    "speed_accel": sql(
        ("acc",), "SELECT scenario_id, object_id, timestep, speed, accel_ms2 FROM acc"
    ),
    "step_distance": sql(
        ("egok",), "SELECT scenario_id, object_id, timestep, step_dist FROM egok"
    ),
    "integrate_positions": sql(
        ("tracks",),
        f"""
SELECT scenario_id, object_id, timestep, {Q("x_integrated")} AS x_integrated, {Q("y_integrated")} AS y_integrated
FROM (SELECT scenario_id, object_id, timestep,
             sum(velocity_x * CAST(0.1 AS DOUBLE)) OVER w AS x_integrated,
             sum(velocity_y * CAST(0.1 AS DOUBLE)) OVER w AS y_integrated
      FROM tracks
      WINDOW w AS (PARTITION BY scenario_id, object_id ORDER BY timestep ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) s""",
    ),
    "fill_dimensions": sql(
        ("tracks",),
        """
SELECT scenario_id, object_id, timestep, object_type,
       coalesce(CASE WHEN valid THEN length_m END,
                CASE object_type WHEN 'VEHICLE' THEN CAST(4.5 AS DOUBLE) WHEN 'PEDESTRIAN' THEN CAST(0.5 AS DOUBLE) WHEN 'CYCLIST' THEN CAST(1.8 AS DOUBLE) END) AS length_m,
       coalesce(CASE WHEN valid THEN width_m END,
                CASE object_type WHEN 'VEHICLE' THEN CAST(2.0 AS DOUBLE) WHEN 'PEDESTRIAN' THEN CAST(0.5 AS DOUBLE) WHEN 'CYCLIST' THEN CAST(0.7 AS DOUBLE) END) AS width_m
FROM tracks""",
    ),
    "bucket_counts": sql(
        ("btracks",),
        "SELECT scenario_bucket, count(*) AS rows FROM btracks GROUP BY scenario_bucket ORDER BY scenario_bucket",
    ),
    "bucket_range": sql(
        ("btracks",),
        """
SELECT count(*) AS n_buckets, min(rows) AS min_rows, max(rows) AS max_rows
FROM (SELECT scenario_bucket, count(*) AS rows FROM btracks GROUP BY scenario_bucket) b""",
    ),
    "hard_brakes": sql(("hb",), "SELECT * FROM hb"),
    "cut_ins": sql(("ci",), "SELECT * FROM ci"),
    "near_misses": sql(("nm",), "SELECT * FROM nm"),
    "all_events": sql(("ev",), "SELECT * FROM ev"),
    "ego_features": sql(
        ("ef",), f"SELECT scenario_id, {', '.join(R(c) for c in FEATURE_OUT)} FROM ef"
    ),
    "agent_counts": sql(("ac",), "SELECT * FROM ac"),
    "features": sql(
        ("feat",),
        f"SELECT scenario_id, {', '.join(R(c) for c in FEATURE_OUT)}, n_agents, has_event FROM feat",
    ),
    "event_rate": sql(
        ("feat",),
        f"""
SELECT {Q("CAST(count_if(has_event) AS DOUBLE) / CAST(greatest(count(*), 1) AS DOUBLE)")} AS event_rate
FROM feat""",
    ),
    "event_scenarios": sql(("ev",), "SELECT DISTINCT scenario_id FROM ev"),
}

# -- space -------------------------------------------------------------------

FEATURES6 = ("mean_speed", "max_speed", "max_decel", "trajectory_length", "n_agents", "heading_variance")
EPS = "CAST(2.220446049250313e-16 AS DOUBLE)"


def _scale(c: str) -> str:
    return (
        f"CASE WHEN var_{c} <= n * {EPS} * var_{c} + (n * mean_{c} * {EPS}) * (n * mean_{c} * {EPS}) "
        f"THEN CAST(1 AS DOUBLE) ELSE sqrt(var_{c}) END"
    )


_cte(
    "stt",
    ("feat",),
    "\n  SELECT CAST(count(*) AS DOUBLE) AS n, "
    + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS mean_{c}, var_pop(CAST({c} AS DOUBLE)) AS var_{c}" for c in FEATURES6
    )
    + " FROM feat",
)

_cte(
    "scl",
    ("feat", "stt"),
    "\n  SELECT feat.*, "
    + ", ".join(f"(CAST({c} AS DOUBLE) - mean_{c}) / ({_scale(c)}) AS z_{c}" for c in FEATURES6)
    + " FROM feat CROSS JOIN stt",
)

_NORM = "sqrt(" + " + ".join(f"z_{c} * z_{c}" for c in FEATURES6) + ")"

_cte(
    "emb",
    ("scl",),
    "\n  SELECT *, "
    + ", ".join(f"z_{c} / nrm AS v{i}" for i, c in enumerate(FEATURES6))
    + f" FROM (SELECT *, CASE WHEN {_NORM} = 0 THEN CAST(1 AS DOUBLE) ELSE {_NORM} END AS nrm FROM scl) s",
)

_cte(
    "evl",
    ("ev",),
    """
  SELECT scenario_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
  FROM ev GROUP BY scenario_id""",
)

_cte(
    "vec",
    ("emb", "evl"),
    "\n  SELECT emb.scenario_id, "
    + ", ".join(f"CAST(CAST(v{i} AS FLOAT) AS DOUBLE) AS v{i}" for i in range(6))
    + ", mean_speed, max_speed, max_decel, trajectory_length, n_agents, heading_variance, has_event,"
    + " coalesce(evl.event_types, 'none') AS event_types"
    + " FROM emb LEFT JOIN evl ON emb.scenario_id = evl.scenario_id",
)

_V6 = ", ".join(f"{Q(f'v{i}')} AS v{i}" for i in range(6))
_DIST = " + ".join(f"(v.v{i} - q.v{i}) * (v.v{i} - q.v{i})" for i in range(6))

# -- curation ----------------------------------------------------------------

_cte(
    "cen",
    ("scl",),
    "\n  SELECT row_number() OVER (ORDER BY scenario_id) - 1 AS idx, "
    + ", ".join(f"z_{c} AS c_{c}" for c in FEATURES6)
    + " FROM scl ORDER BY scenario_id LIMIT 50",
)

_cte(
    "asg",
    ("scl", "cen"),
    "\n  SELECT scenario_id, idx AS cluster, dist AS cluster_distance FROM ("
    "\n    SELECT scenario_id, idx, dist, row_number() OVER (PARTITION BY scenario_id ORDER BY dist, idx) AS rn FROM ("
    "\n      SELECT s.scenario_id, c.idx, round(sqrt("
    + " + ".join(f"(s.z_{c} - c.c_{c}) * (s.z_{c} - c.c_{c})" for c in FEATURES6)
    + "), 9) AS dist FROM scl s CROSS JOIN cen c) d) r WHERE rn = 1",
)

_cte(
    "dd",
    ("asg", "feat", "cen"),
    """
  SELECT feat.*, k.cluster, k.cluster_distance FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY cluster_distance, scenario_id) AS rn FROM asg
  ) k JOIN feat ON feat.scenario_id = k.scenario_id
  WHERE k.rn <= (SELECT greatest(1, (SELECT count(*) FROM feat) // (SELECT count(*) FROM cen)))""",
)

_cte(
    "pe",
    ("ev",),
    """
  SELECT scenario_id, min(event_type) AS primary_event FROM ev GROUP BY scenario_id""",
)

_cte(
    "lab",
    ("dd", "pe"),
    """
  SELECT dd.*, coalesce(pe.primary_event, 'NO_EVENT') AS primary_event
  FROM dd LEFT JOIN pe ON dd.scenario_id = pe.scenario_id""",
)

_FC = "scenario_id, mean_speed, max_speed, max_decel, trajectory_length, heading_variance, n_agents, has_event"


def _sample(name: str, cap: int, all_capped: bool) -> None:
    capped = "TRUE" if all_capped else "primary_event = 'NO_EVENT'"
    _cte(
        name,
        ("lab",),
        f"""
  SELECT {_FC} FROM (
    SELECT *, row_number() OVER (PARTITION BY primary_event ORDER BY md5(scenario_id || ':42'), scenario_id) AS rn
    FROM lab WHERE {capped}) s WHERE rn <= {cap}
  UNION ALL
  SELECT {_FC} FROM lab WHERE NOT ({capped})""",
    )


_sample("smp20", 20, False)
_sample("smp20all", 20, True)
_sample("man", 80, False)

_cte(
    "cur",
    ("tracks", "man"),
    """
  SELECT * FROM tracks WHERE scenario_id IN (SELECT scenario_id FROM man)""",
)

_FR = ", ".join([R(c) for c in FEATURE_OUT])

# -- marts and panels ----------------------------------------------------------
# Written from the rules: bins are a table of bounds joined by range, agents are
# summed up one by one first, counts are CTEs of one row each.

_cte(
    "bins",
    (),
    """
  SELECT * FROM (VALUES (CAST('-inf' AS DOUBLE), 0.2, '0.0-0.2'), (0.2, 0.4, '0.2-0.4'), (0.4, 0.6, '0.4-0.6'),
                        (0.6, 0.8, '0.6-0.8'), (0.8, CAST('inf' AS DOUBLE), '0.8-1.0')) t(low, high, label)""",
)

_cte(
    "binned",
    ("ev", "bins"),
    """
  SELECT e.event_type, b.label, count(*) AS n
  FROM ev e JOIN bins b ON e.severity >= b.low AND e.severity < b.high GROUP BY ALL""",
)

_cte(
    "kinds",
    ("ev",),
    """
  SELECT event_type, sum(n)::BIGINT AS n, count(*) AS scenarios, sum(total) / sum(n) AS mean, max(high) AS high, min(low) AS low
  FROM (SELECT event_type, scenario_id, count(*) AS n, sum(severity) AS total, max(severity) AS high, min(severity) AS low
        FROM ev GROUP BY event_type, scenario_id) s
  GROUP BY event_type""",
)

_cte(
    "agents",
    ("tracks",),
    """
  SELECT object_type, object_id, scenario_id, count(*) AS n, sum(sqrt(velocity_x ** 2 + velocity_y ** 2)) AS speeds
  FROM tracks WHERE NOT is_ego GROUP BY ALL""",
)

_cte(
    "agent_kinds",
    ("agents",),
    """
  SELECT object_type, len(list(DISTINCT object_id)) AS agents, len(list(DISTINCT scenario_id)) AS scenarios,
         round(sum(speeds) / sum(n), 2) AS avg_speed
  FROM agents GROUP BY object_type""",
)

_cte("n_tracks", ("tracks",), "SELECT count(*) AS n FROM (SELECT DISTINCT scenario_id FROM tracks)")
_cte("n_events", ("ev",), "SELECT count(*) AS n, len(list(DISTINCT scenario_id)) AS scenarios FROM ev")
_cte("n_feat", ("feat",), "SELECT count(*) AS n FROM (SELECT DISTINCT scenario_id FROM feat)")
_cte("n_man", ("man",), "SELECT count(*) AS n FROM man")

# -- contracts -----------------------------------------------------------------

TRACK_COLS = (
    "scenario_id timestep timestamp_s object_id object_type is_ego position_x position_y "
    "heading velocity_x velocity_y length_m width_m valid"
).split()
EVENT_COLS = "scenario_id object_id event_type timestep_start timestep_end severity".split()
FEATURE_COLS_C = (
    "scenario_id mean_speed max_speed max_decel trajectory_length heading_variance n_agents has_event"
).split()


def _report(contract: str, table: str, cols: list[str], rules: list[tuple[str, str, str]]) -> str:
    parts = [
        f"SELECT '{contract}' AS contract, '{c}' AS column_name, 'not_null' AS check_name, CAST(count_if({c} IS NULL) AS BIGINT) AS violations FROM {table}"
        for c in cols
    ]
    parts += [
        f"SELECT '{contract}' AS contract, '{c}' AS column_name, '{name}' AS check_name, CAST(count_if({c} IS NOT NULL AND ({bad})) AS BIGINT) AS violations FROM {table}"
        for c, name, bad in rules
    ]
    return "\nUNION ALL\n".join(parts)


def _rng(c: str, op: str, v: str) -> tuple[str, str, str]:
    neg = {">=": "<", ">": "<=", "<=": ">"}[op]
    return (c, f"{op} {v}", f"isnan({c}) OR {c} {neg} {v}")


_cte(
    "badtracks",
    ("tracks",),
    """
  SELECT scenario_id, timestep, timestamp_s, object_id,
         CASE WHEN NOT valid THEN 'TRUCK' ELSE object_type END AS object_type,
         is_ego, position_x, position_y,
         CASE WHEN timestep = 24 THEN heading + 10 ELSE heading END AS heading,
         velocity_x, velocity_y,
         CASE WHEN is_ego AND timestep = 0 THEN CAST(0 AS DOUBLE) ELSE length_m END AS length_m,
         width_m, valid
  FROM tracks""",
)

_cte(
    "badev",
    ("ev",),
    """
  SELECT scenario_id, object_id, event_type, timestep_start, timestep_end,
         CASE WHEN event_type = 'CUT_IN' THEN severity + 1 ELSE severity END AS severity
  FROM ev""",
)

_cte(
    "badfeat",
    ("feat",),
    """
  SELECT scenario_id, mean_speed, max_speed, max_decel, trajectory_length, heading_variance,
         CASE WHEN has_event THEN CAST(0 AS BIGINT) ELSE n_agents END AS n_agents, has_event
  FROM feat""",
)

ORACLE.update(
    {
        "scaled_features": sql(
            ("scl",), "SELECT scenario_id, " + ", ".join(R(f"z_{c}") for c in FEATURES6) + " FROM scl"
        ),
        "embeddings": sql(("emb",), f"SELECT scenario_id, {_V6} FROM emb"),
        "event_lists": sql(("evl",), "SELECT * FROM evl"),
        "vector_table": sql(
            ("vec",),
            f"SELECT scenario_id, {_V6}, {_FR}, n_agents, has_event, event_types FROM vec",
        ),
        "knn": sql(
            ("vec",),
            f"""
SELECT scenario_id, event_types, {R("mean_speed")}, {R("max_decel")}, {R("_distance")}
FROM (SELECT v.*, {_DIST} AS _distance
      FROM vec v CROSS JOIN (SELECT * FROM vec WHERE scenario_id = 'sc_00003' LIMIT 1) q
      WHERE v.scenario_id <> 'sc_00003') s
ORDER BY _distance, scenario_id LIMIT 5""",
        ),
        "primary_events": sql(("pe",), "SELECT * FROM pe"),
        "nearest_per_cluster": sql(
            ("dd",), "SELECT scenario_id, cluster, cluster_distance FROM dd"
        ),
        "stratified_sample": sql(
            ("smp20",), f"SELECT scenario_id, {_FR}, n_agents, has_event FROM smp20"
        ),
        "stratified_sample_all_capped": sql(
            ("smp20all",), f"SELECT scenario_id, {_FR}, n_agents, has_event FROM smp20all"
        ),
        "curated_manifest": sql(("man",), f"SELECT scenario_id, {_FR}, n_agents, has_event FROM man"),
        "curated_tracks": sql(("cur",), "SELECT * FROM cur"),
        "curation_yield": sql(
            ("man", "feat"),
            f"""
SELECT c AS curated_count, f AS feature_count, {Q("CAST(c AS DOUBLE) / CAST(greatest(f, 1) AS DOUBLE)")} AS yield
FROM (SELECT count(*) AS c FROM man) a CROSS JOIN (SELECT count(*) AS f FROM feat) b""",
        ),
        "dedup_report": sql(
            ("dd", "feat"),
            """
SELECT f AS rows_in, d AS rows_out, f - d AS removed
FROM (SELECT count(*) AS f FROM feat) a CROSS JOIN (SELECT count(*) AS d FROM dd) b""",
        ),
        "list_events": sql(
            ("ev",),
            """
SELECT scenario_id, object_id, event_type, timestep_start, timestep_end, round(severity, 3) AS severity
FROM ev ORDER BY severity DESC, scenario_id, object_id, event_type LIMIT 20""",
        ),
        "list_events_by_type": sql(
            ("ev",),
            """
SELECT scenario_id, object_id, event_type, timestep_start, timestep_end, round(severity, 3) AS severity
FROM ev WHERE event_type = 'CUT_IN' ORDER BY severity DESC, scenario_id, object_id, event_type LIMIT 20""",
        ),
        "scenario_detail": sql(
            ("tracks",),
            """
SELECT object_id, object_type, is_ego, min(timestep) AS t_start, max(timestep) AS t_end,
       round(avg(sqrt(velocity_x * velocity_x + velocity_y * velocity_y)), 2) AS avg_speed
FROM tracks WHERE scenario_id = 'sc_00003'
GROUP BY object_id, object_type, is_ego ORDER BY is_ego DESC, object_id""",
        ),
        "stats_summary": sql(
            ("n_tracks", "n_events"),
            """
SELECT t.n AS total_scenarios, e.n AS total_events, e.scenarios AS scenarios_with_events FROM n_tracks t, n_events e""",
        ),
        "stats_breakdown": sql(
            ("kinds",),
            """
SELECT event_type, n AS count, round(mean, 3) AS avg_severity, round(high, 3) AS max_severity FROM kinds""",
        ),
        "adhoc_sql": sql(("ev",), "SELECT event_type, COUNT(*) AS n FROM ev GROUP BY event_type"),
        "stage_metrics": sql(
            ("tracks", "ev", "feat", "man", "vec"),
            f"""
SELECT 'tracks' AS stage, 'row_count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM tracks
UNION ALL SELECT 'tracks', 'scenario_count', CAST(count(DISTINCT scenario_id) AS DOUBLE) FROM tracks
UNION ALL SELECT 'events', 'event_count', CAST(count(*) AS DOUBLE) FROM ev
UNION ALL SELECT 'features', 'feature_count', CAST(count(*) AS DOUBLE) FROM feat
UNION ALL SELECT 'features', 'event_rate', {Q("CAST(count_if(has_event) AS DOUBLE) / CAST(greatest(count(*), 1) AS DOUBLE)")} FROM feat
UNION ALL SELECT 'curated', 'curated_scenarios', CAST(count(*) AS DOUBLE) FROM man
UNION ALL SELECT 'embeddings', 'indexed_scenarios', CAST(count(*) AS DOUBLE) FROM vec""",
        ),
        "mart_event_frequency": sql(
            ("kinds",),
            """
SELECT event_type, n AS event_count, scenarios AS scenarios_affected,
       round(mean, 3) AS avg_severity, round(high, 3) AS max_severity, round(low, 3) AS min_severity
FROM kinds""",
        ),
        "mart_severity_distribution": sql(
            ("binned",),
            """
SELECT event_type, label AS severity_bucket, n AS count FROM binned""",
        ),
        "mart_agent_types": sql(
            ("agent_kinds",),
            """
SELECT object_type, agents AS unique_agents, scenarios AS scenarios_present, avg_speed FROM agent_kinds""",
        ),
        "mart_data_engine_yield": sql(
            ("n_tracks", "n_feat", "n_man"),
            """
SELECT t.n AS total_scenarios, f.n AS featurized, m.n AS curated_count,
       round(CASE WHEN t.n > 0 THEN 100.0::DOUBLE * m.n / t.n END, 1) AS yield_pct
FROM n_tracks t, n_feat f, n_man m""",
        ),
        "mart_scenario_complexity": sql(
            ("ev",),
            """
SELECT scenario_id, sum(n)::BIGINT AS event_count, count(*) AS event_types, round(max(high), 3) AS worst_severity
FROM (SELECT scenario_id, event_type, count(*) AS n, max(severity) AS high FROM ev GROUP BY scenario_id, event_type) k
GROUP BY scenario_id QUALIFY row_number() OVER (ORDER BY event_count DESC, scenario_id) <= 50""",
        ),
        "panel_summary": sql(
            ("n_tracks", "n_events"),
            """
SELECT t.n AS scenarios, e.n AS events, e.scenarios AS with_events FROM n_tracks t, n_events e""",
        ),
        "panel_events_by_type": sql(
            ("kinds",),
            """
SELECT event_type, n AS count, round(mean, 3) AS avg_severity FROM kinds""",
        ),
        "panel_severity": sql(
            ("binned",),
            """
SELECT event_type, label AS bucket, n AS count FROM binned""",
        ),
        "panel_agents": sql(
            ("agent_kinds",),
            """
SELECT object_type, agents, avg_speed FROM agent_kinds""",
        ),
        "panel_yield": sql(
            ("n_tracks", "n_man"),
            f"""
SELECT t.n AS raw, m.n AS curated, {Q("100.0::DOUBLE * (m.n::DOUBLE / greatest(t.n, 1))")} AS yield_pct FROM n_tracks t, n_man m""",
        ),
        "kmeans_invariants": sql(
            ("feat",),
            """
SELECT count(*) AS rows_in, greatest(1, count(*) // least(50, count(*))) AS per_cluster, least(50, count(*)) AS k,
       TRUE AS clusters_ok, TRUE AS kept_ok, TRUE AS closest_ok, TRUE AS cost_ok
FROM feat""",
        ),
        "adhoc_sql_by_name": sql(
            ("ev",), "SELECT event_type, count(*) AS n, 'one {brace}' AS note FROM ev GROUP BY event_type"
        ),
        "sql_over_mart_view": sql(
            ("kinds",), "SELECT event_type, n AS event_count, n AS binned FROM kinds"
        ),
        "violations_tracks": sql(
            ("badtracks",),
            _report(
                "tracks",
                "badtracks",
                TRACK_COLS,
                [
                    ("timestep", ">= 0", "timestep < 0"),
                    _rng("timestamp_s", ">=", "0.0"),
                    ("object_type", "in (VEHICLE,PEDESTRIAN,CYCLIST)", "object_type NOT IN ('VEHICLE', 'PEDESTRIAN', 'CYCLIST')"),
                    _rng("heading", ">=", "-4.0"),
                    _rng("heading", "<=", "4.0"),
                    _rng("length_m", ">", "0.0"),
                    _rng("width_m", ">", "0.0"),
                ],
            ),
        ),
        "violations_events": sql(
            ("badev",),
            _report(
                "events",
                "badev",
                EVENT_COLS,
                [
                    ("event_type", "in (HARD_BRAKE,CUT_IN,NEAR_MISS)", "event_type NOT IN ('HARD_BRAKE', 'CUT_IN', 'NEAR_MISS')"),
                    ("timestep_start", ">= 0", "timestep_start < 0"),
                    ("timestep_end", ">= 0", "timestep_end < 0"),
                    _rng("severity", ">=", "0.0"),
                    _rng("severity", "<=", "1.0"),
                ],
            ),
        ),
        "violations_features": sql(
            ("badfeat",),
            _report(
                "features",
                "badfeat",
                FEATURE_COLS_C,
                [
                    _rng("mean_speed", ">=", "0.0"),
                    _rng("max_speed", ">=", "0.0"),
                    _rng("trajectory_length", ">=", "0.0"),
                    ("n_agents", ">= 1", "n_agents < 1"),
                    _rng("heading_variance", ">=", "0.0"),
                ],
            ),
        ),
    }
)

# -- k-means, by definition ------------------------------------------------------
# Points on a grid of 2^-16; ten starts, each from the 50 rows with the least
# hash, go through Lloyd rounds until they move by no more than 1e-4 (squared).

P6 = [f"p{i}" for i in range(6)]


def _nine(x: str) -> str:
    return f"CAST(printf('%.9g', {x}) AS DOUBLE)"


_cte(
    "pts",
    ("feat", "stt"),
    "\n  SELECT scenario_id, "
    + ", ".join(
        f"CAST(floor((CAST({c} AS DOUBLE) - {_nine(f'mean_{c}')}) / {_nine(_scale(c))} * 65536 + 0.5) AS BIGINT) AS p{i}"
        for i, c in enumerate(FEATURES6)
    )
    + " FROM feat CROSS JOIN stt",
)

_FAR = " + ".join(f"(p.{c} - k.{c}) * (p.{c} - k.{c})" for c in P6)
_MEAN = "CASE WHEN {0} % {1} < 0 THEN {0} // {1} - 1 ELSE {0} // {1} END"


def _nearest(centres: str) -> str:
    """Each point's nearest centre by start, the first of equals."""
    return f"""
    SELECT start, scenario_id, {', '.join(P6)}, near[1] AS far, near[2] AS idx FROM (
      SELECT k.start, p.scenario_id, {', '.join(f'any_value(p.{c}) AS {c}' for c in P6)}, min([{_FAR}, k.idx]) AS near
      FROM pts p CROSS JOIN {centres} k GROUP BY k.start, p.scenario_id)"""


_cte(
    "km",
    ("pts",),
    f"""
  SELECT start, 0 AS round, idx, {', '.join(P6)}, FALSE AS settled FROM (
    SELECT s.start, row_number() OVER (PARTITION BY s.start ORDER BY md5(scenario_id || ':' || (42 + s.start)), {', '.join(P6)}) - 1 AS idx, pts.*
    FROM pts, range(10) s(start)) x
  WHERE idx < 50
  UNION ALL
  SELECT start, round, idx, {', '.join(P6)}, sum(moved) OVER (PARTITION BY start) <= CAST(floor(1e-4::DOUBLE * 65536 * 65536) AS BIGINT) AS settled FROM (
    SELECT k.start, k.round + 1 AS round, k.idx, {', '.join(f'coalesce(m.{c}, k.{c}) AS {c}' for c in P6)},
           {' + '.join(f'(coalesce(m.{c}, k.{c}) - k.{c}) * (coalesce(m.{c}, k.{c}) - k.{c})' for c in P6)} AS moved
    FROM (SELECT * FROM km WHERE NOT settled AND round < 300) k LEFT JOIN (
      SELECT start, idx, {', '.join(_MEAN.format(f'(2 * sum({c}) + count(*))', '(2 * count(*))') + f' AS {c}' for c in P6)}
      FROM ({_nearest('(SELECT * FROM km WHERE NOT settled AND round < 300)')}) n GROUP BY start, idx) m
    ON m.start = k.start AND m.idx = k.idx) y""",
)

_cte(
    "kend",
    ("km",),
    """
  SELECT * FROM km QUALIFY round = max(round) OVER (PARTITION BY start)""",
)

_cte(
    "kbest",
    ("kend",),
    f"""
  SELECT k.idx, {', '.join(f'CAST(k.{c} AS DOUBLE) / 65536 AS {c}' for c in P6)} FROM kend k
  WHERE k.start = (SELECT start FROM (SELECT start, sum(far) AS cost FROM ({_nearest('kend')}) n GROUP BY start) c ORDER BY cost, start LIMIT 1)""",
)

_cte(
    "kasg",
    ("scl", "kbest"),
    "\n  SELECT scenario_id, near[2]::INTEGER AS cluster, near[1] AS cluster_distance FROM ("
    "\n    SELECT s.scenario_id, min([round(sqrt("
    + " + ".join(f"(s.z_{c} - k.p{i}) * (s.z_{c} - k.p{i})" for i, c in enumerate(FEATURES6))
    + "), 9), k.idx::DOUBLE]) AS near FROM scl s CROSS JOIN kbest k GROUP BY s.scenario_id) x",
)

ORACLE["kmeans_dedup"] = sql(
    ("kasg",),
    """
SELECT scenario_id, cluster, cluster_distance FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY cluster_distance, scenario_id) AS rn FROM kasg
) k WHERE rn <= (SELECT greatest(1, count(*) // least(50, count(*))) FROM kasg)""",
).replace("WITH ", "WITH RECURSIVE ", 1)

# What the batch jobs store equals the plans of the same name.
ORACLE.update(
    {
        "stored_tracks": ORACLE["tracks"],
        "stored_tracks_appended": ORACLE["tracks"],
        "stored_events": ORACLE["all_events"],
        "stored_features": ORACLE["features"],
        "stored_curated_tracks": sql(("btracks", "man"), "SELECT * FROM btracks WHERE scenario_id IN (SELECT scenario_id FROM man)"),
        "stored_vectors": ORACLE["vector_table"],
        "stored_scenario_detail": ORACLE["scenario_detail"],
        "stored_similar": ORACLE["knn"],
        "stored_metrics": ORACLE["stage_metrics"],
    }
)
