"""Global positions and sums that do not overflow."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from martkit.operators.marts import dim_average
from martkit.operators.positions import with_positions
from martkit.operators.rollup import Rollup, rollup
from tests.test_plans import plan


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_positions_against_a_sort(spark, ranges):
    r = random.Random(3)
    rows = [(r.choice([None, *range(50)]), f"n{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "`a.b` int, n string").repartition(5)
    got = with_positions(df, [F.col("`a.b`").desc(), "n"], ranges=ranges, start=0)
    want = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert sorted((tuple(x) for x in got.collect()), key=lambda x: x[2]) == [(*x, i) for i, x in enumerate(want)]


def test_positions_of_ties_and_of_nothing(spark):
    df = spark.createDataFrame([(1,)] * 30 + [(0,)] * 5, "k int")
    got = sorted((x.k, x.position) for x in with_positions(df, ["k"]).collect())
    assert [p for _, p in got] == list(range(1, 36)) and got[4] == (0, 5)
    assert with_positions(df.where("k > 9"), ["k"]).count() == 0
    with pytest.raises(ValueError):
        with_positions(df, [])


def test_no_window_over_all_rows(spark):
    text = plan(with_positions(spark.range(1000), ["id"], ranges=8), "simple")
    assert "Window" not in text and "SinglePartition" not in text and "BroadcastHashJoin" in text


LARGEST = (1 << 63) - 1


@pytest.mark.parametrize("kind", ["bigint", "int", "smallint"])
def test_means_of_extreme_numbers(spark, kind):
    bits = {"bigint": 63, "int": 31, "smallint": 15}[kind]
    r = random.Random(bits)
    top = (1 << bits) - 1
    rows = [(r.randrange(4), r.choice([None, top, -top - 1, r.randrange(-top, top), 0, -1])) for _ in range(300)]
    rows += [(9, top), (9, top), (8, -top - 1), (8, -top - 1), (7, None)]
    fact = spark.createDataFrame(rows, f"k int, m {kind}")
    dim = spark.createDataFrame([(i, f"l{i}") for i in range(10)], "c int, name string")
    want = {}
    for k in {k for k, _ in rows}:
        held = [m for j, m in rows if j == k and m is not None]
        want[f"l{k}"] = float(sum(held)) / len(held) if held else None
        if held:
            assert want[f"l{k}"] == pytest.approx(float(Fraction(sum(held), len(held))))
    shared = rollup(fact, ["k", "m"], ["m"])
    for source in (fact, Rollup(shared.df, shared.keys, shared.measures)):
        got = {x.name: x.mean for x in dim_average(source, dim, "k", "c", "name", "m", value_name="mean").collect()}
        assert got == want
    assert want["l9"] == float(top)


def test_bigint_pieces_stay_in_map_side_sums(spark):
    fact = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("m"))
    text = plan(rollup(fact, ["k"], ["m"]).df, "simple")
    assert text.count("partial_sum") >= 3 and "decimal" not in text[text.index("Exchange") :]


def test_distributed_rollup_splits_a_hot_key(spark):
    """A third of the rolled-up rows share one key: no partition holds twice the median."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    fact = spark.range(600_000).select(key.alias("dest"), F.col("id").alias("carrier"))
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    prior = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "200k")  # far less than there is, as on large data
        spark.conf.set(names[1], "16")
        dealt = rollup(fact, ["dest", "carrier"], distribute_by=["dest"]).df
        sizes = sorted(r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("carrier"), F.max("__rows")).collect())
        assert sum(sizes) == 600_000 and len(sizes) > 4
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        text = plan(dealt, "simple")
        assert "REBALANCE_PARTITIONS_BY_COL" in text
        assert text.index("REBALANCE") < text.index("partial_count")  # after the map-side combine
    finally:
        for n, v in prior.items():
            spark.conf.set(n, v)
