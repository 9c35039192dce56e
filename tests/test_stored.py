"""Versions of tables, loads of tracks, co-located reads."""

import os
import shutil

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tracklake import sinks, versions
from tracklake.operators.curate import curated_tracks
from tracklake.operators.features import agent_counts
from tracklake.operators.stored import agent_counts_stored, curated_tracks_stored
from tracklake.plans import jobs
from tracklake.plans.jobs import Warehouse
from tracklake.settings import DEFAULT
from tracklake.sources import warehouse as src
from tracklake.sources.fixture import fixture_tracks

FEW = DEFAULT.with_(track_buckets=3)


def shards(spark, folder, parts):
    """One shard file for each frame, named as given."""
    os.makedirs(folder, exist_ok=True)
    for name, df in parts.items():
        sinks.write_raw(df.coalesce(1), f"{folder}-{name}")
        (file,) = (f for f in os.listdir(f"{folder}-{name}") if f.endswith(".parquet"))
        shutil.copy(f"{folder}-{name}/{file}", f"{folder}/{name}.parquet")
    return folder


def halves(spark):
    t = fixture_tracks(spark, SF001)
    return t.where("scenario_id < 'sc_00004'"), t.where("scenario_id >= 'sc_00004'")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_versions_of_a_table(spark, tmpdir_path):
    table = f"{tmpdir_path}/t"
    assert versions.current(spark, table) is None and versions.folders(spark, table) == [table]
    for n in (3, 5):
        versions.replace(spark, table, lambda p, n=n: spark.range(n).write.parquet(p))
        if n == 3:
            before = src.read_table(spark, table)
    assert src.read_table(spark, table).count() == 5
    assert before.count() == 3  # a reader opened before the swap

    def half_written(path):
        spark.range(9).write.parquet(path)
        raise OSError("lost")

    with pytest.raises(OSError):
        versions.replace(spark, table, half_written)
    assert src.read_table(spark, table).count() == 5
    # a log file whose writer died is passed over, and its number is not used again
    with open(f"{table}/_versions/00000003.json", "w") as f:
        f.write('{"folders": [')
    assert src.read_table(spark, table).count() == 5
    assert versions.commit(spark, table, versions.current(spark, table)) == "00000004.json"
    assert len(versions.vacuum(spark, table, keep=2)) == 2  # the first version's and the failed one's
    assert src.read_table(spark, table).count() == 5 and versions.vacuum(spark, table) == []


def test_two_writers_of_one_version(spark, tmpdir_path, monkeypatch):
    table = f"{tmpdir_path}/t"
    versions.commit(spark, table, {"folders": ["a"]})
    monkeypatch.setattr(versions, "_log_files", lambda *a: [])
    with pytest.raises(Exception, match="exists"):
        versions.commit(spark, table, {"folders": ["b"]})


def test_appending_shards(spark, tmpdir_path):
    first, second = halves(spark)
    raw, wh = shards(spark, f"{tmpdir_path}/raw", {"a": first}), Warehouse(f"{tmpdir_path}/wh")
    assert jobs.append(spark, raw, wh, FEW)["row_count"] == first.count()
    old, before = src.read_tracks(spark, wh.tracks), files(wh.tracks)
    assert jobs.append(spark, raw, wh, FEW)["shards_taken"] == 0  # the same shard again
    shards(spark, raw, {"b": second})
    shutil.copy(f"{raw}/a.parquet", f"{raw}/copy-of-a.parquet")  # the same rows under another name
    m = jobs.append(spark, raw, wh, FEW)
    assert m["shards_taken"] == 1 and m["row_count"] == 1000
    both = fixture_tracks(spark, SF001)
    assert rows(src.read_tracks(spark, wh.tracks).drop("scenario_bucket")) == rows(both)
    after = files(wh.tracks)
    assert before.items() <= after.items() and len(after) > len(before)  # no file of the first load touched
    assert old.count() == first.count()
    stored = src.read_stored_tracks(spark, wh.tracks)
    assert rows(stored.colocated) == rows(stored.every) and stored.spread is None
    assert {r["name"] for r in src.read_shards(spark, wh.tracks).collect()} == {"a.parquet", "b.parquet"}
    # a shard that changed under its name is an error, and nothing is taken
    shards(spark, raw, {"a": second.limit(5)})
    with pytest.raises(ValueError, match="a.parquet"):
        jobs.append(spark, raw, wh, FEW)
    # a whole ingest starts anew
    assert jobs.ingest(spark, shards(spark, f"{tmpdir_path}/raw2", {"c": second}), wh, FEW)["row_count"] == second.count()
    assert {r["name"] for r in src.read_shards(spark, wh.tracks).collect()} == {"c.parquet"}
    gone = versions.vacuum(spark, wh.tracks, keep=1, data=src.LOADS)
    assert len(gone) == 2 and src.read_tracks(spark, wh.tracks).count() == second.count()


@pytest.mark.parametrize("while_writing", [False, True])
def test_a_bad_shard_is_not_taken(spark, tmpdir_path, while_writing):
    from tracklake.operators.contracts import ContractError

    settings = FEW.with_(validate_while_writing=while_writing)
    first, second = halves(spark)
    raw, wh = shards(spark, f"{tmpdir_path}/raw", {"a": first}), Warehouse(f"{tmpdir_path}/wh")
    jobs.ingest(spark, raw, wh, settings)
    shards(spark, raw, {"b": second.withColumn("length_m", F.lit(-1.0))})
    with pytest.raises(ContractError):
        jobs.append(spark, raw, wh, settings)
    assert src.read_tracks(spark, wh.tracks).count() == first.count()
    assert {r["name"] for r in src.read_shards(spark, wh.tracks).collect()} == {"a.parquet"}


def exchanges_of_tracks(df):
    """Exchanges below which the plan scans tracks."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found = []
    for i, line in enumerate(plan):
        if "Exchange " in line:
            below = []
            for other in plan[i + 1 :]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            if any("FileScan parquet" in b and "object_id" in b for b in below):
                found.append(line.strip())
    return found


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_exchange_of_colocated_tracks(spark, tmpdir_path, no_broadcast):
    """Agent counts and curated tracks over a table of two loads."""
    first, second = halves(spark)
    raw, wh = shards(spark, f"{tmpdir_path}/raw", {"a": first}), Warehouse(f"{tmpdir_path}/wh")
    jobs.ingest(spark, raw, wh, FEW)
    shards(spark, raw, {"b": second.unionByName(first.where("timestep > 2"))})  # scenarios that go on in the second load
    jobs.append(spark, raw, wh, FEW)
    stored = src.read_stored_tracks(spark, wh.tracks)
    ids = fixture_tracks(spark, SF001).where("scenario_id in ('sc_00001', 'sc_00007')").select("scenario_id").distinct()
    counts, kept = agent_counts_stored(stored), curated_tracks_stored(stored, ids)
    for df in (counts, kept):
        assert "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()
        assert exchanges_of_tracks(df) == []
    assert exchanges_of_tracks(agent_counts(stored.every)) and exchanges_of_tracks(curated_tracks(stored.every, ids))
    assert rows(counts) == rows(agent_counts(stored.every))
    assert rows(kept) == rows(curated_tracks(stored.every, ids))


def test_hot_scenarios_are_kept_apart(spark, tmpdir_path, no_broadcast):
    """A scenario beyond the limit is cut into ranges, also one that was not
    hot in an earlier load; the other scenarios stay co-located."""
    first, second = halves(spark)
    hot = first.where("scenario_id = 'sc_00001'")
    more = [hot.withColumn("timestep", F.col("timestep") + 1000 * k) for k in range(1, 9)]
    for m in more[1:]:
        more[0] = more[0].unionByName(m)
    raw, wh = shards(spark, f"{tmpdir_path}/raw", {"a": first}), Warehouse(f"{tmpdir_path}/wh")
    settings = FEW.with_(hot_scenario_rows=150)
    jobs.ingest(spark, raw, wh, settings)
    assert src.read_stored_tracks(spark, wh.tracks).spread is None
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        jobs.append(spark, shards(spark, f"{tmpdir_path}/raw2", {"b": second.unionByName(more[0])}), wh, settings)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    stored = src.read_stored_tracks(spark, wh.tracks)
    assert stored.spread.select("scenario_id").distinct().collect() == [("sc_00001",)]
    assert stored.spread.select(F.input_file_name()).distinct().count() > 3  # the hot scenario is split
    assert rows(stored.colocated.unionByName(stored.spread)) == rows(stored.every)
    ids = fixture_tracks(spark, SF001).where("scenario_id in ('sc_00001', 'sc_00007')").select("scenario_id").distinct()
    counts, kept = agent_counts_stored(stored), curated_tracks_stored(stored, ids)
    assert rows(counts) == rows(agent_counts(stored.every))
    assert rows(kept) == rows(curated_tracks(stored.every, ids))
    assert exchanges_of_tracks(kept) == []
    # only rows of hot scenarios are exchanged for the counts
    assert all("load=" not in x for x in exchanges_of_tracks(counts))


def test_every_scenario_hot(spark, tmpdir_path):
    raw, wh = shards(spark, f"{tmpdir_path}/raw", {"a": fixture_tracks(spark, SF001)}), Warehouse(f"{tmpdir_path}/wh")
    jobs.ingest(spark, raw, wh, FEW.with_(hot_scenario_rows=1))
    stored = src.read_stored_tracks(spark, wh.tracks)
    assert stored.colocated.count() == 0 and stored.spread.count() == stored.every.count() == 1000
    assert rows(agent_counts_stored(stored)) == rows(agent_counts(stored.every))
