"""Copies that keep folders and leave unchanged ones alone."""

import pytest

from martkit.sources.files import copy_datasets, partition_columns


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("part-*.parquet")}


def rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(str(path)).select("v", "day", "kind").collect()), key=str)


def test_folders_stay_and_only_changed_ones_are_copied_again(spark, tmp_path):
    schema = "v int, day string, kind string"
    src, dst = tmp_path / "in", tmp_path / "out"
    data = [(i, f"0{i % 3}", k) for i in range(30) for k in ("a b", "x:y", None)]
    spark.createDataFrame(data, schema).coalesce(1).write.partitionBy("day", "kind").parquet(str(src / "t"))

    def copy():
        assert copy_datasets(spark, ["t"], str(src), str(dst)) == [f"{dst}/t"]
        return files(dst / "t")

    first = copy()
    folders = {f.rsplit("/", 1)[0] for f in first}
    assert folders == {f.rsplit("/", 1)[0] for f in files(src / "t")} and "day=01/kind=__HIVE_DEFAULT_PARTITION__" in folders
    assert rows(spark, dst / "t") == rows(spark, src / "t")
    assert copy() == first  # nothing changed: no file is touched
    # one folder changes, one goes
    spark.createDataFrame([(99, "01", "a b")], schema).write.mode("append").partitionBy("day", "kind").parquet(str(src / "t"))
    for f in (src / "t" / "day=02" / "kind=x%3Ay").iterdir():
        f.unlink()
    second = copy()
    assert rows(spark, dst / "t") == rows(spark, src / "t")
    same = {f for f in first if second.get(f) == first[f]}
    assert {f.rsplit("/", 1)[0] for f in first if f not in same} == {"day=01/kind=a b", "day=02/kind=x%3Ay"}


def test_a_stopped_copy_is_taken_up(spark, tmp_path):
    src, dst = tmp_path / "in", tmp_path / "out"
    spark.range(5).write.parquet(str(src / "t"))
    copy_datasets(spark, ["t"], str(src), str(dst))
    (dst / "t" / "_copied.json").write_text("{}")
    spark.range(7).write.mode("overwrite").parquet(str(src / "t"))
    copy_datasets(spark, ["t"], str(src), str(dst))
    assert spark.read.parquet(str(dst / "t")).count() == 7


def test_layouts():
    assert partition_columns([""]) == [] and partition_columns(["a=1/b=2", "a=2/b=1"]) == ["a", "b"]
    for mixed in (["a=1", "a=1/b=2"], ["a=1", "x"], ["", "a=1"]):
        with pytest.raises(ValueError):
            partition_columns(mixed)
