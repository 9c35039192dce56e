"""Versions of a stored table.

A table is a folder with data folders that are never changed once listed, and a
log, ``_versions``, of small JSON files, one a version, each listing the data
folders it is made of. A writer fills a new data folder and then adds the next
log file, whose name nobody else can take (an exclusive create). Readers take
the last whole log file: a reader opened before finishes on the old version, and
a write that fails leaves the table as it was. ``vacuum`` removes folders that
the last versions no longer list; nothing else deletes data.

All file access goes through Hadoop's file systems, as Spark's own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

LOG = "_versions"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _log_files(spark: SparkSession, table: str) -> list[str]:
    fs, pattern = _fs(spark, f"{table}/{LOG}/*.json")
    return sorted((s.getPath().getName() for s in fs.globStatus(pattern) or []), reverse=True)


def _entry(spark: SparkSession, table: str, name: str) -> dict | None:
    """A log file's content; None while its writer is still at it, or died."""
    fs, path = _fs(spark, f"{table}/{LOG}/{name}")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:
        return None
    finally:
        stream.close()


def current(spark: SparkSession, table: str) -> dict | None:
    """The last version: ``{"folders": [...], ...}``; None without a log."""
    return next((e for n in _log_files(spark, table) if (e := _entry(spark, table, n)) is not None), None)


def folders(spark: SparkSession, table: str) -> list[str]:
    """The data folders of the last version; the folder itself without a log."""
    entry = current(spark, table)
    return [table] if entry is None else [f"{table}/{f}" for f in entry["folders"]]


def commit(spark: SparkSession, table: str, entry: dict) -> str:
    """Add the next version; ``FileAlreadyExistsException`` if another writer
    took its number first (that writer's version stands)."""
    names = _log_files(spark, table)
    number = int(names[0].split(".")[0]) + 1 if names else 1
    fs, path = _fs(spark, f"{table}/{LOG}/{number:08d}.json")
    out = fs.create(path, False)
    out.write(bytearray(json.dumps(entry), "utf-8"))
    out.close()
    return path.getName()


def replace(spark: SparkSession, table: str, write: Callable[[str], None], **more) -> None:
    """Fill a new data folder by ``write(path)`` and make it the table."""
    folder = f"v-{uuid.uuid4().hex}"
    write(f"{table}/{folder}")
    commit(spark, table, {"folders": [folder], **more})


def vacuum(spark: SparkSession, table: str, keep: int = 2, data: str = "") -> list[str]:
    """Delete the data folders (in ``table/data``) that none of the last
    ``keep`` versions lists; returns them. Readers of older versions must have
    finished, and no writer may be at work."""
    entries = [e for n in _log_files(spark, table) if (e := _entry(spark, table, n)) is not None]
    live = {f for e in entries[: max(keep, 1)] for f in e["folders"]}
    root = f"{table}/{data}".rstrip("/")
    fs, path = _fs(spark, root)
    gone = []
    for s in fs.listStatus(path) if entries and fs.exists(path) else []:
        name = s.getPath().getName()
        if s.isDirectory() and not name.startswith(("_", ".")) and f"{data}/{name}".lstrip("/") not in live:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return gone
