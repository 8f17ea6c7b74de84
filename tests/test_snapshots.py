"""Versioned tables: swaps, killed writes, and upserts that leave other buckets."""

import json
import random

import pytest
from pyspark.sql import functions as F

from martkit.functions.keys import row_hash
from martkit.operators.delta import upsert_snapshot
from martkit.operators.pruning import Pruning
from martkit.sources import snapshots
from martkit.sources.smallfiles import Folder
from martkit.sources.snapshots import Manifest, VersionConflict, manifest, read_snapshot, upsert_into, vacuum, versions, write_snapshot

SCHEMA = "id bigint, v string"


def frame(spark, rows):
    return row_hash(spark.createDataFrame(rows, SCHEMA))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {str(f.relative_to(path)) for f in path.rglob("part-*.parquet")}


def test_versions_and_layouts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert manifest(spark, path) is None and versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    one, two = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(None, "c")])
    write_snapshot(one, path)
    write_snapshot(two, path, partition_by=["v"])
    write_snapshot(one.where("id < 0"), path, keys="id", buckets=4)  # no row, so no part
    assert versions(spark, path) == [1, 2, 3]
    assert [rows(read_snapshot(spark, path, v)) for v in (1, 2, 3)] == [rows(one), rows(two), []]
    assert read_snapshot(spark, path, 2).columns == two.columns and read_snapshot(spark, path).schema == one.schema
    with pytest.raises(ValueError):
        write_snapshot(one, path, keys="id")


def test_a_killed_write_leaves_readers_on_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    old = frame(spark, [(i, "a") for i in range(50)])
    write_snapshot(old, path, keys="id", buckets=4)
    broken = old.withColumn("v", F.when(F.col("id") == 33, F.raise_error(F.lit("killed"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="killed"):
        write_snapshot(broken, path, keys="id", buckets=4)
    assert versions(spark, path) == [1] and rows(read_snapshot(spark, path)) == rows(old)
    # killed after the data, and while the manifest was written
    snapshots._write_data(old.withColumn("v", F.lit("new")), path, ["id"], 4, ())
    (tmp_path / "t/versions/0000000002.json").write_text(manifest(spark, path).text()[:60])
    assert versions(spark, path) == [1] and rows(read_snapshot(spark, path)) == rows(old)
    assert write_snapshot(old.withColumn("v", F.lit("next")), path).version == 3
    assert {r.v for r in read_snapshot(spark, path).collect()} == {"next"}


def test_only_one_of_two_writers_commits(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = frame(spark, [(1, "a")])
    write_snapshot(df, path)
    real = snapshots._write_data

    def other_first(*args):
        monkeypatch.setattr(snapshots, "_write_data", real)
        write_snapshot(df.withColumn("v", F.lit("other")), path)
        return real(*args)

    monkeypatch.setattr(snapshots, "_write_data", other_first)
    with pytest.raises(VersionConflict):
        write_snapshot(df.withColumn("v", F.lit("late")), path)
    assert {r.v for r in read_snapshot(spark, path).collect()} == {"other"} and versions(spark, path) == [1, 2]


def test_buckets_without_a_change_keep_their_files(spark, tmp_path):
    path = tmp_path / "t"
    stored = frame(spark, [(i, f"v{i}") for i in range(400)] + [(None, "n")])
    write_snapshot(stored, str(path), keys="id", buckets=16)
    before, parts = files(path), manifest(spark, str(path)).parts
    delivery = frame(spark, [(7, "new"), (8, "v8"), (9, "v9"), (1000, "added")])
    done = upsert_into(delivery, str(path))
    assert (done.version, done.inserted, done.updated) == (2, 1, 1)
    assert {(r.id, r.action) for r in done.changes.collect()} == {(7, "update"), (1000, "insert")}
    after = manifest(spark, str(path)).parts
    assert {b for b in after if after[b] != parts.get(b)} == set(done.buckets) and len(done.buckets) <= 2
    named = {f for f in files(path) if any(f.startswith(p) for p in after.values())}
    unchanged = {f for f in before if f"__bucket={f.split('__bucket=')[1].split('/')[0]}" and f.split("__bucket=")[1].split("/")[0] not in done.buckets}
    assert unchanged and unchanged <= named
    assert rows(read_snapshot(spark, str(path))) == rows(upsert_snapshot(delivery, stored, "id"))
    # replay: no version, no file
    held = files(path)
    again = upsert_into(delivery, str(path))
    assert (again.version, again.inserted, again.updated, again.buckets) == (2, 0, 0, ()) and again.changes.count() == 0
    assert files(path) == held and versions(spark, str(path)) == [1, 2]
    # the old version still reads as it was
    assert rows(read_snapshot(spark, str(path), 1)) == rows(stored)


@pytest.mark.parametrize("prune", [None, Pruning(min_target_bytes=0), Pruning(min_target_bytes=0, max_rows=0)])
def test_upserts_equal_the_operator(spark, tmp_path, prune):
    r = random.Random(6)
    make = lambda n: [(r.choice([None, *range(30)]), r.choice(["x", "y", None])) for _ in range(n)]
    path = str(tmp_path / "t")
    want = frame(spark, make(80))
    write_snapshot(want, path, keys="id", buckets=5)
    for _ in range(2):
        delivery = frame(spark, make(25))
        want = upsert_snapshot(delivery, spark.createDataFrame(want.collect(), want.schema), "id", prune=None)
        upsert_into(delivery, path, prune=prune)
        assert rows(read_snapshot(spark, path)) == rows(want)


def test_vacuum_keeps_what_versions_name(spark, tmp_path):
    path = tmp_path / "t"
    df = frame(spark, [(i, "a") for i in range(40)])
    write_snapshot(df, str(path), keys="id", buckets=4)
    upsert_into(frame(spark, [(1, "b")]), str(path))
    write_snapshot(df, str(path))  # version 3 names neither
    snapshots._write_data(df, str(path), ["id"], 4, ())  # a killed write
    assert vacuum(spark, str(path), keep=3) == []  # young folders stay
    assert len(vacuum(spark, str(path), keep=3, older_than_s=-10)) == 1
    assert rows(read_snapshot(spark, str(path), 2)) == rows(upsert_snapshot(frame(spark, [(1, "b")]), df, "id"))
    assert len(vacuum(spark, str(path), keep=1, older_than_s=-10)) == 2
    assert versions(spark, str(path)) == [3] and rows(read_snapshot(spark, str(path))) == rows(df)


def test_small_files(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == [] and folder.read("a") is None
    assert folder.create("a", "é") and not folder.create("a", "b")
    assert folder.read("a") == "é" and folder.names() == ["a"]
    folder.delete("a")
    assert not folder.exists("a")
    with pytest.raises((TypeError, KeyError)):
        Manifest(**json.loads("{}"))
