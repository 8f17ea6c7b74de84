"""Insert / update / unchanged detection and applying it (FIXTURES §3)."""

import pytest

from martkit.functions.keys import row_hash
from martkit.operators.delta import (
    apply_inserts,
    classify_delta,
    delta_inserts,
    delta_matched,
    delta_updates,
    upsert_snapshot,
)

SCHEMA = "IATA_CODE string, AIRLINE string"


@pytest.fixture()
def pair(spark):
    src = row_hash(spark.createDataFrame([("NEW", "n"), ("SAME", "s"), ("CHG", "new name")], SCHEMA))
    tgt = row_hash(spark.createDataFrame([("SAME", "s"), ("CHG", "old name"), ("OLD", "o")], SCHEMA))
    return src, tgt


def test_sets(pair):
    src, tgt = pair
    assert [r.IATA_CODE for r in delta_inserts(src, tgt, "IATA_CODE").collect()] == ["NEW"]
    assert sorted(r.IATA_CODE for r in delta_matched(src, tgt, "IATA_CODE").collect()) == ["CHG", "SAME"]
    assert [r.IATA_CODE for r in delta_updates(src, tgt, "IATA_CODE").collect()] == ["CHG"]


def test_classify(pair):
    src, tgt = pair
    got = {r.IATA_CODE: r.action for r in classify_delta(src, tgt, "IATA_CODE").collect()}
    assert got == {"NEW": "insert", "SAME": "unchanged", "CHG": "update"}


def test_classify_does_not_multiply_rows_for_repeated_target_keys(spark):
    src = row_hash(spark.createDataFrame([("K", "v2")], SCHEMA))
    tgt = row_hash(spark.createDataFrame([("K", "v1"), ("K", "v2"), ("K", "v3")], SCHEMA))
    assert [(r.IATA_CODE, r.action) for r in classify_delta(src, tgt, "IATA_CODE").collect()] == [("K", "unchanged")]
    # the matched set does not pair the row with every stored version either
    assert delta_matched(src, tgt, "IATA_CODE").count() == 1
    assert delta_updates(src, tgt, "IATA_CODE").count() == 0


def test_upsert_snapshot(pair):
    src, tgt = pair
    got = {r.IATA_CODE: r.AIRLINE for r in upsert_snapshot(src, tgt, "IATA_CODE").collect()}
    assert got == {"NEW": "n", "SAME": "s", "CHG": "new name", "OLD": "o"}
    assert upsert_snapshot(src, tgt, "IATA_CODE").columns == tgt.columns


def test_composite_key(spark):
    s = row_hash(spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "k1 int, k2 string, v string"))
    t = row_hash(spark.createDataFrame([(1, "a", "x")], "k1 int, k2 string, v string"))
    got = {(r.k1, r.k2): r.action for r in classify_delta(s, t, ["k1", "k2"]).collect()}
    assert got == {(1, "a"): "unchanged", (1, "b"): "insert"}


def test_apply_inserts_is_not_changed_by_its_own_append(spark, tmp_path):
    """The lazy-target trap: append 40 rows to a 60-row target read lazily."""
    target = str(tmp_path / "airlines")
    spark.range(60).selectExpr("CAST(id AS STRING) AS IATA_CODE", "'x' AS AIRLINE").write.parquet(target)
    src = spark.range(100).selectExpr("CAST(id AS STRING) AS IATA_CODE", "'x' AS AIRLINE")
    tgt = spark.read.parquet(target)

    def append(df):
        df.write.mode("append").parquet(target)

    inserted = apply_inserts(src, tgt, "IATA_CODE", append)
    assert inserted.count() == 40  # still 40 after the append
    assert spark.read.parquet(target).count() == 100


def test_replayed_insert_batch_inserts_nothing_twice(spark, tmp_path):
    """A batch applied again after a failure (the stream replays it) finds its
    keys already in the target and appends nothing."""
    target = str(tmp_path / "airlines")
    row_hash(spark.createDataFrame([("AA", "American")], SCHEMA)).write.parquet(target)
    batch = row_hash(spark.createDataFrame([("AA", "American"), ("UA", "United")], SCHEMA))

    def append(df):
        df.write.mode("append").parquet(target)

    first = apply_inserts(batch, spark.read.parquet(target), "IATA_CODE", append)
    replay = apply_inserts(batch, spark.read.parquet(target), "IATA_CODE", append)
    assert [r.IATA_CODE for r in first.collect()] == ["UA"]
    assert replay.count() == 0
    assert sorted(r.IATA_CODE for r in spark.read.parquet(target).collect()) == ["AA", "UA"]
