"""Column expressions (all built-in ``pyspark.sql.functions``, no UDF)."""

from tracklake.functions.expressions import (
    bucket_of,
    bucket_value,
    clip01,
    dimension_default,
    euclid,
    severity_bin,
    speed,
)

__all__ = [
    "bucket_of",
    "bucket_value",
    "clip01",
    "dimension_default",
    "euclid",
    "severity_bin",
    "speed",
]
