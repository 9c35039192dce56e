"""Data contracts for tracks, events and features.

A contract is a list of columns with a type, a non-null rule and value rules.
All rules of a table are evaluated in one aggregation pass (one ``count_if``
per rule, partial aggregation, one row out). Value rules skip NULLs (the
non-null rule reports those) and treat NaN as out of range. Extra columns are
allowed; a missing column or a wrong type fails before any data is read.

Fixed values of the contracts: object types VEHICLE, PEDESTRIAN, CYCLIST;
event types HARD_BRAKE, CUT_IN, NEAR_MISS; timestep >= 0; timestamp_s >= 0;
heading within -4.0 .. 4.0; length_m > 0; width_m > 0; timestep_start >= 0;
timestep_end >= 0; severity within 0 .. 1; mean_speed, max_speed,
trajectory_length, heading_variance >= 0; n_agents >= 1.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.schemas import EVENTS, FEATURES, TRACKS
from tracklake.settings import EVENT_TYPES, OBJECT_TYPES


class ContractError(ValueError):
    """Raised when a table breaks its contract; ``failures`` lists
    (contract, column, check, violations)."""

    def __init__(self, contract: str, failures: list[tuple[str, str, str, int]]):
        self.contract = contract
        self.failures = failures
        lines = ", ".join(f"{c}.{chk}={n}" for _, c, chk, n in failures)
        super().__init__(f"{contract} contract failed: {lines}")


@dataclass(frozen=True)
class Rule:
    column: str
    check: str
    bad: Callable[[], Column]  # True where the value breaks the rule


def _ge(c, v):
    return Rule(c, f">= {v}", lambda: F.col(c).isNotNull() & (F.isnan(c) | (F.col(c) < v)))


def _gt(c, v):
    return Rule(c, f"> {v}", lambda: F.col(c).isNotNull() & (F.isnan(c) | (F.col(c) <= v)))


def _le(c, v):
    return Rule(c, f"<= {v}", lambda: F.col(c).isNotNull() & (F.isnan(c) | (F.col(c) > v)))


def _isin(c, values):
    return Rule(
        c, "in (" + ",".join(values) + ")", lambda: F.col(c).isNotNull() & ~F.col(c).isin(*values)
    )


def _int_ge(c, v):
    return Rule(c, f">= {v}", lambda: F.col(c).isNotNull() & (F.col(c) < v))


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    rules: tuple[Rule, ...]

    def all_rules(self) -> list[Rule]:
        nn = [
            Rule(f.name, "not_null", lambda n=f.name: F.col(n).isNull()) for f in self.schema.fields
        ]
        return nn + list(self.rules)


TRACK_CONTRACT = Contract(
    "tracks",
    TRACKS,
    (
        _int_ge("timestep", 0),
        _ge("timestamp_s", 0.0),
        _isin("object_type", OBJECT_TYPES),
        _ge("heading", -4.0),
        _le("heading", 4.0),
        _gt("length_m", 0.0),
        _gt("width_m", 0.0),
    ),
)

EVENT_CONTRACT = Contract(
    "events",
    EVENTS,
    (
        _isin("event_type", EVENT_TYPES),
        _int_ge("timestep_start", 0),
        _int_ge("timestep_end", 0),
        _ge("severity", 0.0),
        _le("severity", 1.0),
    ),
)

FEATURE_CONTRACT = Contract(
    "features",
    FEATURES,
    (
        _ge("mean_speed", 0.0),
        _ge("max_speed", 0.0),
        _ge("trajectory_length", 0.0),
        _int_ge("n_agents", 1),
        _ge("heading_variance", 0.0),
    ),
)


def schema_problems(df: DataFrame, contract: Contract) -> list[tuple[str, str, str, int]]:
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in contract.schema.fields:
        if f.name not in have:
            out.append((contract.name, f.name, "present", 1))
        elif have[f.name] != f.dataType:
            out.append((contract.name, f.name, f"type {f.dataType.simpleString()}", 1))
    return out


def violation_report(df: DataFrame, contract: Contract) -> DataFrame:
    """(contract, column_name, check_name, violations) for every rule, in one pass."""
    problems = schema_problems(df, contract)
    if problems:
        raise ContractError(contract.name, problems)
    rules = contract.all_rules()
    counts = df.agg(*[F.count_if(r.bad()).alias(f"_r{i}") for i, r in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(contract.name).alias("contract"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.check).alias("check_name"),
                F.col(f"_r{i}").alias("violations"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def observed(df: DataFrame, contract: Contract):
    """``df`` with every rule counted as an observed metric while it is
    computed (for a single read that validates and writes). Returns the
    frame and a function that raises ``ContractError`` once the frame's
    action has finished and any count is above zero."""
    from pyspark.sql import Observation

    problems = schema_problems(df, contract)
    if problems:
        raise ContractError(contract.name, problems)
    rules = contract.all_rules()
    obs = Observation(f"{contract.name}_contract")
    out = df.observe(obs, *[F.count_if(r.bad()).alias(f"_r{i}") for i, r in enumerate(rules)])

    def check() -> None:
        got = obs.get
        failures = [
            (contract.name, r.column, r.check, int(got[f"_r{i}"]))
            for i, r in enumerate(rules)
            if got[f"_r{i}"]
        ]
        if failures:
            raise ContractError(contract.name, failures)

    return out, check


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Raise ``ContractError`` if any rule is broken; return ``df``."""
    failures = [
        (r["contract"], r["column_name"], r["check_name"], r["violations"])
        for r in violation_report(df, contract).where(F.col("violations") > 0).collect()
    ]
    if failures:
        raise ContractError(contract.name, failures)
    return df


def validate_tracks(df: DataFrame) -> DataFrame:
    return validate(df, TRACK_CONTRACT)


def validate_events(df: DataFrame) -> DataFrame:
    return validate(df, EVENT_CONTRACT)


def validate_features(df: DataFrame) -> DataFrame:
    return validate(df, FEATURE_CONTRACT)
