"""Bad CSV records: reported, kept as text, never loaded as NULL."""

import pytest

from martkit.plans import jobs
from martkit.sources.records import FILE, RECORD, Intake, ingest_csv, split_csv
from martkit.streaming.incremental import extract_incremental, load_incremental

DDL = "id int, v int, d string"


def land(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("id,v,d\n" + "\n".join(lines) + "\n")


BAD = ["x,1,a", "5,6", "7,8,q,more", "9,99999999999999,w", ",1.5,"]
GOOD = ["1,2,a", "2,,b", "3,4,", ",,"]


def test_split_and_report(spark, tmp_path):
    land(tmp_path / "in", "a.csv", GOOD + BAD)
    good, bad = split_csv(spark, str(tmp_path / "in"), DDL)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, 2, "a"), (2, None, "b"), (3, 4, None), (None, None, None)], key=str)
    assert sorted(r[RECORD] for r in bad.collect()) == sorted(BAD)
    assert all(r[FILE].endswith("a.csv") for r in bad.collect())
    # the same records are good whichever columns a query needs
    assert sorted(r.d or "" for r in good.select("d").collect()) == ["", "", "a", "b"]
    for _ in range(2):  # overwritten rows, appended records
        assert ingest_csv(spark, str(tmp_path / "in"), DDL, str(tmp_path / "t"), str(tmp_path / "q")) == Intake(4, 5)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    assert spark.read.parquet(str(tmp_path / "q")).columns == ["id", "v", "d", RECORD, FILE]
    assert spark.read.parquet(str(tmp_path / "q")).count() == 10


def test_one_bad_value_among_two_thousand(spark, tmp_path):
    land(tmp_path / "in", "a.csv", [f"{i},{'oops' if i == 777 else i},z" for i in range(2000)])
    assert ingest_csv(spark, str(tmp_path / "in"), DDL, str(tmp_path / "t"), str(tmp_path / "q"), partition_by=["d"]) == Intake(1999, 1)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.where("v IS NULL").count() == 0 and stored.where("id = 777").count() == 0
    assert (tmp_path / "t" / "d=z").is_dir()


def test_no_bad_records_no_quarantine(spark, tmp_path):
    land(tmp_path / "in", "a.csv", GOOD)
    assert ingest_csv(spark, str(tmp_path / "in"), DDL, str(tmp_path / "t"), str(tmp_path / "q")) == Intake(4, 0)
    assert not (tmp_path / "q").exists()
    with pytest.raises(ValueError):
        split_csv(spark, str(tmp_path / "in"), "id int, _record string")


def test_extract_stream(spark, tmp_path):
    where = [str(tmp_path / n) for n in ("in", "t", "c", "q")]
    schema = spark.createDataFrame([], DDL).schema

    def run(**quarantine):
        return extract_incremental(spark, where[0], schema, where[1], where[2], **quarantine)

    land(tmp_path / "in", "a.csv", GOOD + BAD)
    assert run(quarantine=where[3]) == 5
    land(tmp_path / "in", "b.csv", ["10,1,a", "y,1,a"])
    assert run(quarantine=where[3]) == 1 and run(quarantine=where[3]) == 0
    assert spark.read.parquet(where[1]).count() == 5 and spark.read.parquet(where[3]).count() == 6


def test_streams_without_a_quarantine_fail_on_a_bad_record(spark, tmp_path):
    land(tmp_path / "in", "a.csv", ["1,2,a", "x,2,a"])
    schema = spark.createDataFrame([], DDL).schema
    for i, run in enumerate((extract_incremental, lambda *a: load_incremental(*a, "id"))):
        with pytest.raises(Exception):
            run(spark, str(tmp_path / "in"), schema, str(tmp_path / f"t{i}"), str(tmp_path / f"c{i}"))


def test_load_stream(spark, tmp_path):
    where = [str(tmp_path / n) for n in ("in", "t", "c")]
    schema = spark.createDataFrame([], DDL).schema
    land(tmp_path / "in", "a.csv", ["1,2,a", "x,2,a"])
    assert load_incremental(spark, where[0], schema, *where[1:], "id", quarantine=str(tmp_path / "q")) == 1
    land(tmp_path / "in", "b.csv", ["1,2,a", "4,5,b"])
    assert load_incremental(spark, where[0], schema, *where[1:], "id", quarantine=str(tmp_path / "q")) == 0
    assert sorted(r.id for r in spark.read.parquet(where[1]).collect()) == [1, 4]
    assert [r[RECORD] for r in spark.read.parquet(str(tmp_path / "q")).collect()] == ["x,2,a"]


def test_extract_job(spark, tmp_path):
    land(tmp_path / "in", "a.csv", ["1,2,a", "x,2,a"])
    source, target, report = {"df_airline": str(tmp_path / "in")}, {"df_airline": str(tmp_path / "t")}, {}
    jobs.extract(spark, source, target, {"df_airline": DDL}, quarantine=str(tmp_path / "q"), report=report)
    assert report == {"df_airline": Intake(1, 1)} and (tmp_path / "q" / "df_airline").is_dir()
    with pytest.raises(Exception):
        jobs.extract(spark, source, target, {"df_airline": DDL})
