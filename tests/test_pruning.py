"""Pruned targets: same sets as without pruning, and no shuffle of other rows."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martkit.functions.keys import row_hash
from martkit.operators.delta import apply_inserts, classify_delta, delta_inserts, delta_updates, upsert_snapshot
from martkit.operators.pruning import NO_PRUNE, Pruning, key_stats, narrow
from tests.test_plans import plan

EXACT = Pruning(min_target_bytes=0)
BITS = Pruning(min_target_bytes=0, max_rows=0, filter_bits=1 << 12)
RANGE = Pruning(min_target_bytes=0, max_rows=0, filter_bits=2)
POLICIES = {"exact": EXACT, "bits": BITS, "range": RANGE}


def messy(spark, seed):
    r = random.Random(seed)
    key = lambda: r.choice([None, *range(40), 10**12])
    make = lambda n: [(key(), r.choice(["x", "y", None]), r.choice([1, 2])) for _ in range(n)]
    schema = "id bigint, b string, v int"
    return row_hash(spark.createDataFrame(make(60), schema)), row_hash(spark.createDataFrame(make(400), schema))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("policy", POLICIES.values(), ids=POLICIES)
def test_every_set_is_as_without_pruning(spark, policy):
    for seed in (0,):
        src, tgt = messy(spark, seed)
        for find in (delta_inserts, delta_updates, classify_delta, upsert_snapshot):
            assert rows(find(src, tgt, "id", prune=policy)) == rows(find(src, tgt, "id", prune=NO_PRUNE)), find.__name__
        for find in (delta_inserts, upsert_snapshot):
            assert rows(find(src, tgt, ["id", "v"], prune=policy)) == rows(find(src, tgt, ["id", "v"], prune=NO_PRUNE))
        got, want = [], []
        apply_inserts(src, tgt, "id", got.append, prune=policy)
        apply_inserts(src, tgt, "id", want.append, prune=NO_PRUNE)
        assert rows(got[0]) == rows(want[0])


@pytest.mark.parametrize("policy", POLICIES.values(), ids=POLICIES)
@pytest.mark.parametrize(
    ("kind", "make"),
    [
        ("string", lambda i: f"k{i:04d}"),
        ("date", lambda i: datetime.date(2020, 1, 1) + datetime.timedelta(days=i)),
        ("decimal(20,3)", lambda i: Decimal(i) / 8),
        ("double", float),
        ("binary", lambda i: bytes([i % 256, i // 256])),
        ("timestamp", lambda i: datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=i)),
    ],
)
def test_matching_rows_stay_for_each_key_type(spark, policy, kind, make):
    tgt = spark.createDataFrame([(make(i), i) for i in range(300)] + [(None, -1)], f"k {kind}, v int")
    src = spark.createDataFrame([(make(i),) for i in range(50, 60)] + [(None,)], f"k {kind}")
    plain = {r.v for r in narrow(tgt, src, ["k"], policy).collect()}
    assert plain >= set(range(50, 60)) and len(plain) < 250 or policy is RANGE
    assert {r.v for r in narrow(tgt, src, ["k"], policy, nulls=True).collect()} >= {-1, *range(50, 60)}


def test_empty_source_all_null_source_and_other_types(spark):
    tgt = spark.createDataFrame([(i,) for i in range(9)] + [(None,)], "k bigint")
    empty, nulls = tgt.where("k < 0"), tgt.where("k IS NULL")
    assert narrow(tgt, empty, ["k"], EXACT, nulls=True).count() == 0
    assert narrow(tgt, nulls, ["k"], EXACT).count() == 0
    assert narrow(tgt, nulls, ["k"], EXACT, nulls=True).count() == 1
    ints = spark.createDataFrame([(3,), (4,)], "k int")  # joins compare int and bigint
    for policy in POLICIES.values():
        assert {3, 4} <= {r.k for r in narrow(tgt, ints, ["k"], policy).collect()}


def test_only_large_targets_are_measured(spark):
    tgt = spark.range(5).toDF("k")
    assert narrow(tgt, tgt, ["k"], Pruning()) is tgt and narrow(tgt, tgt, ["k"], NO_PRUNE) is tgt


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A large stored target (2 million rows) and 1,000 delivered ones."""
    path = str(tmp_path_factory.mktemp("target") / "t")
    big = spark.range(2_000_000).select(F.col("id").alias("k"), (F.col("id") % 97).cast("string").alias("v"))
    row_hash(big).write.parquet(path)
    tgt = spark.read.parquet(path)
    src = row_hash(spark.range(1_999_500, 2_000_500).select(F.col("id").alias("k"), (F.col("id") % 89).cast("string").alias("v")))
    return src, tgt


def test_no_exchange_of_unfiltered_target_rows(spark, stored):
    src, tgt = stored
    prior = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for policy in (EXACT, Pruning(min_target_bytes=0, max_rows=0)):
            for find in (delta_inserts, classify_delta, delta_updates, *([upsert_snapshot] if policy is EXACT else [])):
                text = plan(find(src, tgt, "k", prune=policy), "simple")
                # from every scan of the target upwards: a semi-join comes before any exchange
                lines = text.splitlines()
                scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
                assert scans
                for i in scans:
                    depth = lines[i].index("FileScan")
                    for line in reversed(lines[:i]):
                        at = len(line) - len(line.lstrip(" :+-"))
                        if at >= depth:
                            continue
                        depth = at
                        if "BroadcastHashJoin" in line and ("LeftSemi" in line or "LeftAnti" in line):
                            break
                        assert not line.lstrip(" :+-").startswith("Exchange"), text
        keys = plan(narrow(tgt, src, ["k"], EXACT), "formatted")
        assert "GreaterThanOrEqual(k,1999500)" in keys and "LessThanOrEqual(k,2000499)" in keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prior)
    got = {r.action: r["n"] for r in classify_delta(src, tgt, "k", prune=EXACT).groupBy("action").agg(F.count("*").alias("n")).collect()}
    assert got["insert"] == 500 and sum(got.values()) == 1000


def test_bit_table_is_bounded_and_drops_most_rows(spark, stored):
    src, tgt = stored
    policy = Pruning(min_target_bytes=0, max_rows=0, filter_bits=1 << 16)
    spread = spark.range(0, 2_000_000, 2000).select(F.col("id").alias("k"))  # the range can't help
    left = narrow(tgt, spread, ["k"], policy)
    assert left.where("k % 2000 = 0").count() == 1000
    assert left.count() < 2_000_000 * 0.03  # 1,000 keys on 65,536 bits
    assert key_stats(spread, ["k"]).rows == 1000
