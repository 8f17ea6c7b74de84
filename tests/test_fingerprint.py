"""Fingerprints, table comparison and the load ledger."""

import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.fingerprint import compare_tables, fingerprint, prints, table_digest
from martkit.operators.quality import readback_check
from martkit.plans import cli, jobs
from martkit.plans.ledger import Ledger
from tests.test_jobs import _sources
from tests.test_plans import plan

SCHEMA = "k int, `a.b` string, s struct<x:int,y:int>, l array<int>"


def table(spark, r, n=300):
    pick = lambda *v: r.choice([None, *v])
    rows = [(pick(*range(20)), pick("x", "", "y"), pick((None, 1), (1, None)), pick([None, 1], [1], [])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_any_order_and_layout_gives_the_same_fingerprint(spark):
    r = random.Random(1)
    rows, df = table(spark, r)
    r.shuffle(rows)
    other = spark.createDataFrame(rows, SCHEMA).repartition(7).select("l", "s", "`a.b`", "k")
    assert table_digest(df) == table_digest(other, ["k", "a.b", "s", "l"])
    assert table_digest(df)[1] == 300 and table_digest(df.where("k < 0"))[1] == 0
    found = compare_tables(df, other).first()
    assert found.matches and (found.expected_rows, found.actual_rows, found.differing_buckets) == (300, 300, 0)


@pytest.mark.parametrize(
    ("was", "now"),
    [
        ((1, "x", None, None), (None, "x", None, None)),
        ((None, "x", (None, 1), None), (None, "x", (1, None), None)),
        ((None, "", None, [None, 1]), (None, "", None, [1, None])),
        ((None, "", None, None), (None, None, None, None)),
    ],
)
def test_one_changed_value_is_found(spark, was, now):
    rows, _ = table(spark, random.Random(2))
    a, b = (spark.createDataFrame([*rows, x], SCHEMA) for x in (was, now))
    for by in (None, ["k"]):
        found = compare_tables(a, b, by=by).first()
        assert (found.missing_rows, found.extra_rows, found.matches) == (1, 1, False) and 1 <= found.differing_buckets <= 2


def test_repeated_rows_count(spark):
    one = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    two = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert tuple(compare_tables(one, two).first())[:4] == (3, 3, 1, 1)
    assert tuple(compare_tables(one, two.where("k = 9")).first())[:4] == (3, 0, 3, 0)
    assert compare_tables(one.where("k = 9"), two.where("k = 9")).first().matches


def test_names_and_types_come_first(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = a.withColumn("k", F.col("k").cast("bigint")).withColumn("more", F.lit(1)).drop("v")
    found = compare_tables(a, b).first()
    assert (found.missing_columns, found.extra_columns, found.changed_types) == ("v", "more", "k: int -> bigint")
    assert not found.matches and found.missing_rows == 0
    assert readback_check(a, b, ["k"]).first().matches  # what the older check makes of it


def test_random_tables_against_the_row_check(spark):
    r = random.Random(5)
    _, a = table(spark, r, 80)
    _, b = table(spark, r, 90)
    want = readback_check(a, b).first()
    for buckets in (1, 8, 4096):
        got = compare_tables(a, b, buckets=buckets).first()
        assert (got.expected_rows, got.actual_rows, got.missing_rows, got.extra_rows) == tuple(want)[:4]


def test_equal_tables_need_no_row_level_join(spark):
    a = spark.range(1000).withColumn("v", F.col("id") * 2)
    text = plan(compare_tables(a, a.repartition(3)), "simple")
    assert "Join" not in text and "Range" not in text
    agg = plan(fingerprint(a), "simple")
    assert agg.count("Exchange") == 1 and "partial_sum" in agg


def test_prints_at_hand_give_the_same_reports(spark):
    r = random.Random(6)
    _, a = table(spark, r, 80)
    _, b = table(spark, r, 90)
    held = prints(a)[0]
    assert table_digest(a) == table_digest(a, taken=held)
    others = [a.repartition(3), b, a.withColumn("more", F.lit(1)), a.drop(a.columns[0]), a.withColumn("k", F.col("k").cast("string"))]
    for other in others:
        assert compare_tables(a, other, taken=held).first() == compare_tables(a, other).first()


def test_a_load_takes_each_marts_fingerprint_once(spark, tmp_path, monkeypatch):
    import sys

    from martkit.plans import jobs

    module = sys.modules[fingerprint.__module__]

    staged = {}
    for name in ("one", "two"):
        staged[name] = str(tmp_path / "staged" / name)
        spark.range(50).selectExpr("id", f"'{name}' AS v").write.parquet(staged[name])
    taken, plain = [], module.fingerprint
    monkeypatch.setattr(module, "fingerprint", lambda df, *a, **k: (taken.append(sorted(df.inputFiles())[0]), plain(df, *a, **k))[1])
    ledger = str(tmp_path / "ledger")
    for _ in range(2):  # the second finds both loaded, and verifies them
        jobs.load(spark, staged, jobs.parquet_sink(str(tmp_path / "wh")), parallel=False, verify=True, ledger=ledger)
    own = [f for f in taken if "/staged/" in f]
    assert len(own) == 4 and len(taken) == 8


def flaky(store, at, seen):
    def write(df, name):
        seen.append(name)
        if name == at:
            raise RuntimeError("sink failed")
        store(df, name)

    return jobs.Store(write, store.read)


def test_a_restarted_load_goes_on_at_the_unfinished_mart(spark, tmp_path):
    root = str(tmp_path)
    names = ["a", "b", "c", "d"]
    staged = {}
    for i, n in enumerate(names):
        staged[n] = f"{root}/staged/{n}"
        spark.range(5 + i).write.parquet(staged[n])
    store, seen = jobs.snapshot_sink(f"{root}/wh"), []
    with pytest.raises(RuntimeError, match="sink failed"):
        jobs.load(spark, staged, flaky(store, "c", seen), parallel=False, verify=True, ledger=f"{root}/ledger")
    assert seen == ["a", "b", "c"]
    del seen[:]
    assert jobs.load(spark, staged, flaky(store, "", seen), parallel=False, verify=True, ledger=f"{root}/ledger") == ["c", "d"]
    assert seen == ["c", "d"]
    assert jobs.load(spark, staged, store, verify=True, ledger=f"{root}/ledger") == []
    # another mart is loaded anew, and a table that was changed behind the ledger's back
    spark.range(50).write.mode("overwrite").parquet(staged["a"])
    store(spark.range(1), "b")
    assert jobs.load(spark, staged, store, verify=True, ledger=f"{root}/ledger") == ["a", "b"]
    assert store.read(spark, "b").count() == 6


def test_a_sink_that_loses_rows_is_found_out(spark, tmp_path):
    spark.range(9).write.parquet(str(tmp_path / "m"))
    store = jobs.parquet_sink(str(tmp_path / "wh"))
    lossy = jobs.Store(lambda df, name: store(df.limit(8), name), store.read)
    with pytest.raises(jobs.LoadMismatch):
        jobs.load(spark, {"m": str(tmp_path / "m")}, lossy, verify=True, ledger=str(tmp_path / "l"))
    assert Ledger(spark, str(tmp_path / "l")).last("load/m") is None


def test_torn_entries_do_not_count(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "l"))
    assert book.once("s", lambda: None) and not book.once("s", lambda: None)
    (tmp_path / "l/s/0000000002.json").write_text('{"step": "s", "dig')
    assert book.last("s")["complete"]
    book.record("s", digest="d")
    assert book.last("s")["digest"] == "d"


def test_run_restarts_and_sizes_shuffles(spark, tmp_path):
    root = str(tmp_path)
    src = _sources(spark, root)
    args = ["run", "--staging", f"{root}/stage", "--sink", f"snapshot:{root}/wh", "--verify", "--ledger", f"{root}/ledger"]
    for name, path in src.items():
        args += ["--source", f"{name}={path}"]
    prior = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        first = cli.main(args, spark=spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # small input: the least
        assert cli.size_shuffles(spark, list(src.values()), 33) == 33
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prior)
    book = Ledger(spark, f"{root}/ledger")
    assert book.last("transform") and all(book.last(f"extract/{n}") and book.last(f"load/{m}") for n in src for m in first)
    store = jobs.snapshot_sink(f"{root}/wh")
    # nothing is left to do: the sources are not even read
    again = jobs.run(spark, {n: f"{root}/gone" for n in src}, f"{root}/stage", store, verify=True, ledger=f"{root}/ledger")
    assert again == first and store.read(spark, "avg_flight").count() == 3
