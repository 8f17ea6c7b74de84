"""Edge rows for the mart operators (FIXTURES §3)."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.marts import dim_average, flagged_counts, orphan_counts, visit_counts
from martkit.operators.ranking import rank_within
from martkit.operators.rollup import rollup


@pytest.fixture(scope="module")
def airlines(spark):
    return spark.createDataFrame(
        [("AA", "American"), ("A2", "American"), ("NN", "Nulls")], "IATA_CODE string, AIRLINE string"
    )


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_dim_average(spark, airlines, broadcast):
    flights = spark.createDataFrame(
        [("AA", 100), ("AA", 200), ("A2", 300), ("NN", None), ("ZZ", 50)], "AIRLINE string, DISTANCE int"
    )
    out = dim_average(
        flights, airlines, "AIRLINE", "IATA_CODE", "AIRLINE", "DISTANCE",
        label_name="AIRLINE_Name", value_name="avg_DISTANCE", broadcast=broadcast,
    )
    assert out.columns == ["AIRLINE_Name", "avg_DISTANCE"]
    assert [tuple(r) for r in out.collect()] == [("American", 300.0), ("American", 150.0), ("Nulls", None)]
    assert dict(out.dtypes)["avg_DISTANCE"] == "double"


def test_dim_average_rounded_half_up(spark):
    flights = spark.createDataFrame([("AA", 1.0), ("AA", 1.01)], "AIRLINE string, DISTANCE double")
    dim = spark.createDataFrame([("AA", "American")], "IATA_CODE string, AIRLINE string")
    out = dim_average(flights, dim, "AIRLINE", "IATA_CODE", "AIRLINE", "DISTANCE", scale=2)
    assert out.collect()[0][1] == 1.01  # 1.005 rounds half up


def test_visit_counts(spark, airlines):
    places = spark.createDataFrame([("JFK",), ("LAX",), ("LAX",)], "IATA_CODE string")
    flights = spark.createDataFrame(
        [
            ("AA", "JFK", "SFO"),
            ("A2", "JFK", "SFO"),  # same name as AA: merged
            ("AA", "ORD", "SFO"),  # unlisted origin: dropped
            ("AA", "JFK", "BOS"),  # unlisted destination: kept
            ("AA", "JFK", None),  # NULL destination: own group
            ("AA", "LAX", "SFO"),  # origin listed twice: counted twice
        ],
        "AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string",
    )
    out = visit_counts(
        flights, places, airlines, origin="ORIGIN_AIRPORT", dest="DESTINATION_AIRPORT", carrier="AIRLINE",
        place_key="IATA_CODE", carrier_key="IATA_CODE", carrier_label="AIRLINE",
    )
    assert out.columns == ["DESTINATION_AIRPORT", "AIRLINE", "Count_visit_per_airline"]
    assert [tuple(r) for r in out.collect()] == [(None, "American", 1), ("BOS", "American", 1), ("SFO", "American", 4)]


@pytest.mark.parametrize("method", ["window", "histogram", "distributed"])
def test_rank_ties(spark, method):
    df = spark.createDataFrame([("X", "a", 5), ("X", "b", 5), ("X", "c", 3), ("Y", "d", 1)], "p string, k string, n long")
    out = rank_within(df, "p", "n", method=method)
    got = {r.k: r.ranking for r in out.collect()}
    assert got == {"a": 1, "b": 1, "c": 3, "d": 1}
    assert dict(out.dtypes)["ranking"] == "bigint"


@pytest.mark.parametrize("descending", [True, False])
def test_rank_methods_agree_on_hot_group(spark, descending):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):  # one hot group with a third of the rows, many distinct values
        rows.append(("hot" if i % 3 == 0 else f"g{rnd.randint(0, 30)}", rnd.choice([None] + list(range(400))), i))
    rows += [(None, 5, -1), (None, None, -2)]
    df = spark.createDataFrame(rows, "p string, v int, id int")
    expected = sorted((tuple(r) for r in rank_within(df, "p", "v", method="window", descending=descending).collect()), key=repr)
    for method, kw in (("histogram", {}), ("distributed", {"ranges": 5}), ("distributed", {"ranges": 1})):
        got = sorted((tuple(r) for r in rank_within(df, "p", "v", method=method, descending=descending, **kw).collect()), key=repr)
        assert got == expected, method


@pytest.mark.parametrize(
    "ddl,values",
    [("int", [1, 0, 1]), ("double", [1.0, 0.0, 1.0]), ("boolean", [True, False, True])],
)
def test_flagged_counts_flag_types(spark, ddl, values):
    rows = [("AA", v, "SFO") for v in values] + [(None, values[0], "SFO")]
    df = spark.createDataFrame(rows, f"AIRLINE string, CANCELLED {ddl}, DESTINATION_AIRPORT string")
    out = flagged_counts(df, "CANCELLED", "1", ["AIRLINE", "DESTINATION_AIRPORT"])
    assert sorted((r[0] or "", r[2]) for r in out.collect()) == [("", 0), ("AA", 2)]


def test_flagged_counts_text_flag_does_not_match_other_spelling(spark):
    df = spark.createDataFrame([("AA", "1.0", "SFO"), ("AA", "1", "SFO")], "AIRLINE string, CANCELLED string, DESTINATION_AIRPORT string")
    out = flagged_counts(df, "CANCELLED", "1", ["AIRLINE", "DESTINATION_AIRPORT"])
    assert [tuple(r) for r in out.collect()] == [("AA", "SFO", 1)]


def test_flagged_top_is_deterministic(spark):
    rows = [(f"C{i:03d}", 1, "ZZZ") for i in range(150)] + [(f"C{i:03d}", 1, "AAA") for i in range(50)]
    df = spark.createDataFrame(rows, "AIRLINE string, CANCELLED int, DESTINATION_AIRPORT string").repartition(7)
    runs = [
        [tuple(r) for r in flagged_counts(df, "CANCELLED", "1", ["AIRLINE", "DESTINATION_AIRPORT"], limit=100).collect()]
        for _ in range(3)
    ]
    assert runs[0] == runs[1] == runs[2]
    assert runs[0] == [(f"C{i:03d}", "ZZZ", 1) for i in range(100)]


def test_orphan_counts(spark):
    places = spark.createDataFrame([("JFK",)], "IATA_CODE string")
    flights = spark.createDataFrame([(None,), ("XXX",), ("XXX",), ("JFK",)], "DESTINATION_AIRPORT string")
    out = orphan_counts(flights, places, "DESTINATION_AIRPORT", "IATA_CODE")
    assert sorted((r[0] or "", r[1]) for r in out.collect()) == [("", 1), ("XXX", 2)]


def test_shared_rollup_gives_same_marts(spark, airlines):
    places = spark.createDataFrame([("JFK",), ("LAX",)], "IATA_CODE string")
    rnd = random.Random(3)
    rows = [
        (rnd.choice(["AA", "A2", "NN", "ZZ", None]), rnd.choice(["JFK", "LAX", "ORD"]),
         rnd.choice(["SFO", "BOS", "JFK", None]), rnd.choice([None, 10, 20, 35]), rnd.choice([0, 1]))
        for _ in range(500)
    ]
    f = spark.createDataFrame(rows, "AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DISTANCE int, CANCELLED int")
    r = rollup(f, ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "CANCELLED"], ["DISTANCE"])

    def same(a, b):
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)

    same(dim_average(f, airlines, "AIRLINE", "IATA_CODE", "AIRLINE", "DISTANCE"),
         dim_average(r, airlines, "AIRLINE", "IATA_CODE", "AIRLINE", "DISTANCE"))
    kw = dict(origin="ORIGIN_AIRPORT", dest="DESTINATION_AIRPORT", carrier="AIRLINE", place_key="IATA_CODE",
              carrier_key="IATA_CODE", carrier_label="AIRLINE")
    same(visit_counts(f, places, airlines, **kw), visit_counts(r, places, airlines, **kw))
    keys = ["AIRLINE", "DESTINATION_AIRPORT"]
    same(flagged_counts(f, "CANCELLED", "1", keys), flagged_counts(r, "CANCELLED", "1", keys))
    same(orphan_counts(f, places, "DESTINATION_AIRPORT", "IATA_CODE"), orphan_counts(r, places, "DESTINATION_AIRPORT", "IATA_CODE"))


def test_distribute_by_does_not_change_results(spark, airlines):
    places = spark.createDataFrame([("JFK",)], "IATA_CODE string")
    f = spark.createDataFrame([("AA", "JFK", "SFO"), ("A2", "JFK", "BOS")], "AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    kw = dict(origin="ORIGIN_AIRPORT", dest="DESTINATION_AIRPORT", carrier="AIRLINE", place_key="IATA_CODE",
              carrier_key="IATA_CODE", carrier_label="AIRLINE")
    a = visit_counts(f, places, airlines, **kw).collect()
    b = visit_counts(f, places, airlines, distribute_by=["DESTINATION_AIRPORT"], **kw).collect()
    assert a == b


def test_marts_plan_pushes_filter_and_prunes(spark):
    """The flag filter reaches the Parquet scan and only needed columns are read."""
    from martkit.plans import checks

    df = checks.q_flagged_counts(spark, "/root/testdata/sf0.001")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_returnflag:string>" in plan


def test_flagged_counts_non_numeric_literal_on_int_flag(spark):
    df = spark.createDataFrame([("AA", 1, "SFO")], "AIRLINE string, CANCELLED int, DESTINATION_AIRPORT string")
    prior = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        assert flagged_counts(df, "CANCELLED", "X", ["AIRLINE", "DESTINATION_AIRPORT"]).count() == 0
        spark.conf.set("spark.sql.ansi.enabled", "true")
        with pytest.raises(Exception):
            flagged_counts(df, "CANCELLED", "X", ["AIRLINE", "DESTINATION_AIRPORT"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prior)


def test_distributed_rank_without_exchange_reuse(spark):
    """The range numbering must not depend on Spark reusing the range exchange."""
    rnd = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"g{rnd.randint(0, 30)}", rnd.randint(0, 5000), i) for i in range(20000)]
    df = spark.createDataFrame(rows, "p string, v int, id int").repartition(13)
    expected = sorted(tuple(r) for r in rank_within(df, "p", "v", method="window").collect())
    saved = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = sorted(tuple(r) for r in rank_within(df, "p", "v", method="distributed", ranges=16).collect())
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert got == expected


def test_flagged_counts_of_a_non_key_column(spark):
    df = spark.createDataFrame(
        [("AA", "SFO", 1, "x"), ("AA", "SFO", 1, None), ("AA", "SFO", 0, "y"), ("BB", "SFO", 1, "z")],
        "AIRLINE string, DEST string, CANCELLED int, NOTE string",
    )
    got = sorted(map(tuple, flagged_counts(df, "CANCELLED", "1", ["AIRLINE", "DEST"], count_of="NOTE", name="n").collect()))
    want = sorted(map(tuple, df.filter("CANCELLED = 1").groupBy("AIRLINE", "DEST").agg(F.count("NOTE").alias("n")).collect()))
    assert got == want == [("AA", "SFO", 1), ("BB", "SFO", 1)]
