"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.session import ensure_checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and reread it.

    Cuts the lineage: later jobs survive the loss of any executor. The files
    stay until the owner of the shared folder clears it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def find_package_on_workers(spark: SparkSession) -> None:
    """Let Python workers started by this machine import the library even if
    the driver was started in another folder. On a cluster the package is
    installed or shipped with ``--py-files``; an absent path does no harm."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = ":".join([*parts, _ROOT])


_caches: dict[str, Callable[[], None]] = {}
_last_owner = ""


def may_clear(owner: str, clear: Callable[[], None]) -> None:
    """Name a cache of this Python worker that tasks of others may clear."""
    _caches[owner] = clear


def clear_others(owner: str = "") -> None:
    """Free what operators other than ``owner`` remember in this worker. Spark
    keeps workers for later tasks, where that memory is wanted, so where the
    owner changes it goes back to the system at once: a vocabulary and its memo
    refer to each other, and freed blocks stay with the allocators otherwise."""
    global _last_owner
    for name, clear in _caches.items():
        if name != owner:
            clear()
    if owner != _last_owner:
        _last_owner = owner
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)


def with_fields(df: DataFrame, *new: tuple[str, T.DataType]) -> T.StructType:
    """Schema of ``df`` with the new fields last; a column of the same name
    (in any case, as Spark resolves names) is replaced."""
    names = {n.lower() for n, _ in new}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    return T.StructType(kept + [T.StructField(n, t) for n, t in new])


def map_rows(
    df: DataFrame,
    inputs: list[str],
    outputs: list[tuple[str, T.DataType, pa.DataType]],
    make: Callable[[], Callable[..., tuple[list, ...]]],
    rows: int = 256,
    owner: str = "",
) -> DataFrame:
    """Add columns computed in Python from ``inputs``, ``rows`` rows at a time.

    ``make()`` runs once in each task and returns a function from the input
    lists to the output lists. Other columns pass through as Arrow data.
    ``owner`` names the cache that the task uses."""
    find_package_on_workers(df.sparkSession)
    schema = with_fields(df, *((n, t) for n, t, _ in outputs))
    kept = [f.name for f in schema.fields[: len(schema.fields) - len(outputs)]]
    at = {c.lower(): i for i, c in enumerate(df.columns)}
    take, pass_on = [at[c.lower()] for c in inputs], [at[c.lower()] for c in kept]
    arrow = [t for _, _, t in outputs]
    names = [*kept, *(n for n, _, _ in outputs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others(owner)
        apply = make()
        for whole in batches:
            for lo in range(0, whole.num_rows, rows):
                batch = whole.slice(lo, rows)
                made = apply(*(batch.column(i).to_pylist() for i in take))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in pass_on]
                    + [pa.array(x, t) for x, t in zip(made, arrow, strict=True)],
                    names=names,
                )

    return df.mapInArrow(run, schema)


def clean_text(col: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
