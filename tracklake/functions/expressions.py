"""Scalar column expressions used across the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklake.settings import OBJECT_DIMENSIONS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def speed(vx="velocity_x", vy="velocity_y") -> Column:
    """Planar speed ``sqrt(vx^2 + vy^2)``."""
    vx, vy = _c(vx), _c(vy)
    return F.sqrt(vx * vx + vy * vy)


def euclid(dx, dy) -> Column:
    dx, dy = _c(dx), _c(dy)
    return F.sqrt(dx * dx + dy * dy)


def clip01(x) -> Column:
    """Clip to [0, 1]; NULL and NaN pass through unchanged.

    ``greatest``/``least`` skip NULLs and order NaN above every number, so they
    are only applied to ordinary values.
    """
    x = _c(x)
    return F.when(x.isNull() | F.isnan(x), x).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    )


def bucket_of(scenario_id="scenario_id", n_buckets: int = 32) -> Column:
    """Stable hash bucket 0..n-1 of a scenario id (first 32 bits of its MD5)."""
    h = F.conv(F.substring(F.md5(_c(scenario_id)), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(n_buckets)).cast("int")


def bucket_value(scenario_id: str, n_buckets: int = 32) -> int:
    """Driver-side twin of ``bucket_of`` for one literal id (partition pruning)."""
    import hashlib

    return int(hashlib.md5(scenario_id.encode("utf-8")).hexdigest()[:8], 16) % n_buckets


def dimension_default(object_type="object_type", which: int = 0) -> Column:
    """Default length (which=0) or width (which=1) of an object type."""
    t = _c(object_type)
    expr = None
    for name, dims in OBJECT_DIMENSIONS.items():
        expr = (F.when if expr is None else expr.when)(t == name, F.lit(dims[which]))
    return expr


# Severity histogram bin labels, lowest to highest.
SEVERITY_BINS = ("0.0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8", "0.8-1.0")


def severity_bin(severity="severity") -> Column:
    """Five histogram bins of width 0.2; NULL, NaN and >= 0.8 land in the last."""
    s = _c(severity)
    expr = None
    for i, label in enumerate(SEVERITY_BINS[:-1]):
        bound = round(0.2 * (i + 1), 1)
        expr = (F.when if expr is None else expr.when)(s < bound, label)
    return expr.otherwise(SEVERITY_BINS[-1])
