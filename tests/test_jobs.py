"""Extract -> transform -> load on flight-shaped CSV, and the streaming extract."""

from pyspark.sql import functions as F

from martkit.plans import jobs
from martkit.sources.contracts import MART_SCHEMAS
from martkit.sources.files import read_parquet, write_csv
from martkit.streaming.incremental import extract_incremental

FLIGHTS = [
    # AIRLINE, ORIGIN, DEST, DISTANCE, CANCELLED
    ("AA", "JFK", "LAX", 2475, 0),
    ("AA", "JFK", "LAX", 2475, 1),
    ("UA", "LAX", "JFK", 2475, 0),
    ("UA", "ORD", "JFK", 740, 1),
    ("DL", "JFK", "XXX", 100, 1),
    ("DL", "JFK", "LAX", None, 0),
]


def _sources(spark, root):
    data = {
        "df_flights": spark.createDataFrame(
            FLIGHTS, "AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DISTANCE int, CANCELLED int"
        ),
        "df_airline": spark.createDataFrame(
            [("AA", "American"), ("UA", "United"), ("DL", "Delta")], "IATA_CODE string, AIRLINE string"
        ),
        "df_airports": spark.createDataFrame([("JFK",), ("LAX",), ("ORD",)], "IATA_CODE string"),
    }
    out = {}
    for name, df in data.items():
        out[name] = f"{root}/landing/{name}"
        write_csv(df, out[name])
    return out


def test_full_run(spark, tmp_path):
    root = str(tmp_path)
    staged = jobs.run(spark, _sources(spark, root), f"{root}/staging", jobs.parquet_sink(f"{root}/wh"))
    assert sorted(staged) == ["airline_in_airport", "airport_notin_thelist", "avg_flight", "flights_cancellation"]
    assert staged["flights_cancellation"].endswith("/flights_per_cancell")
    wh = {n: read_parquet(spark, f"{root}/wh/{n}") for n in staged}
    assert [tuple(r) for r in wh["avg_flight"].collect()] == [("American", 2475.0), ("United", 1607.5), ("Delta", 100.0)]
    assert sorted(map(tuple, wh["airline_in_airport"].collect())) == [
        ("JFK", "United", 2, 1), ("LAX", "American", 2, 1), ("LAX", "Delta", 1, 2), ("XXX", "Delta", 1, 1),
    ]
    assert sorted(map(tuple, wh["flights_cancellation"].collect())) == [("AA", "LAX", 1), ("DL", "XXX", 1), ("UA", "JFK", 1)]
    assert [tuple(r) for r in wh["airport_notin_thelist"].collect()] == [("XXX", 1)]
    for name, schema in MART_SCHEMAS.items():
        assert wh[name].schema == schema


def test_variant_rounded_and_limited(spark, tmp_path):
    root = str(tmp_path)
    src = _sources(spark, root)
    inputs = jobs.extract(spark, src, {n: f"{root}/raw/{n}" for n in src})
    fact, car, pl = (spark.read.parquet(inputs[n]) for n in jobs.INPUTS)
    marts = jobs.build_marts(fact, car, pl, avg_scale=2, cancel_limit=2, shared=False)
    assert marts["flights_cancellation"].count() == 2
    assert [r.DESTINATION_AIRPORT for r in marts["flights_cancellation"].collect()] == ["XXX", "LAX"]


def test_run_errors_propagate(spark, tmp_path):
    import pytest

    with pytest.raises(Exception):
        jobs.run(spark, {"df_flights": str(tmp_path / "missing")}, str(tmp_path / "s"), jobs.parquet_sink(str(tmp_path / "w")))


def test_incremental_extract_exactly_once(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = "k int, v string"
    landing, target, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    st = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
    write_csv(spark.createDataFrame([(1, "a"), (2, "b")], schema), f"{landing}/b0", mode="append")
    extract_incremental(spark, landing, st, target, ckpt)
    extract_incremental(spark, landing, st, target, ckpt)  # nothing new: no duplicates
    write_csv(spark.createDataFrame([(3, "c")], schema), f"{landing}/b1", mode="append")
    extract_incremental(spark, landing, st, target, ckpt)
    got = sorted(tuple(r) for r in read_parquet(spark, target).select("k", "v").collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_invariants_at_sf001(spark):
    """insert + update + unchanged = source rows; matched + orphan facts = all facts."""
    from martkit.plans import checks
    from martkit.plans.shipments import load_tables, places, shipments

    sf = "/root/testdata/sf0.01"
    src, tgt = checks.delta_pair(spark, sf)
    actions = dict(checks.q_classify_delta(spark, sf).groupBy("action").count().collect())
    assert sum(actions.values()) == src.count()
    assert actions == {"insert": 10, "update": 13, "unchanged": 77}
    t = load_tables(spark, sf, checks.STAR)
    fact = shipments(t)
    orphans = checks.q_orphan_counts(spark, sf).agg(F.sum("Count_airports")).collect()[0][0]
    matched = fact.join(places(t), fact["dest"] == F.col("n_nationkey"), "left_semi").count()
    assert matched + orphans == fact.count()


def test_run_all_raises_after_all_actions(spark):
    import pytest

    done = []

    def ok(i):
        spark.range(10).count()
        done.append(i)

    def bad():
        raise RuntimeError("load failed")

    with pytest.raises(RuntimeError, match="load failed"):
        jobs.run_all({"a": lambda: ok(1), "b": bad, "c": lambda: ok(2)})
    assert sorted(done) == [1, 2]


def test_cli_run_and_copy(spark, tmp_path):
    from martkit.plans import cli

    root = str(tmp_path)
    src = _sources(spark, root)
    args = ["run", "--staging", f"{root}/stage", "--sink", f"parquet:{root}/wh", "--avg-scale", "2"]
    for name, path in src.items():
        args += ["--source", f"{name}={path}"]
    staged = cli.main(args, spark=spark)
    assert read_parquet(spark, f"{root}/wh/avg_flight").count() == 3
    copied = cli.main(["copy", "--src-root", f"{root}/wh", "--dst-root", f"{root}/copy", "avg_flight"], spark=spark)
    assert copied == {"copied": [f"{root}/copy/avg_flight"]}
    assert set(staged) == {"avg_flight", "airline_in_airport", "flights_cancellation", "airport_notin_thelist"}


def test_incremental_load_inserts_new_keys_once(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    from martkit.streaming.incremental import load_incremental

    schema = StructType([StructField("IATA_CODE", StringType()), StructField("AIRLINE", StringType())])
    landing, target, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_csv(spark.createDataFrame([("AA", "American"), ("UA", "United")], schema), f"{landing}/day1")
    load_incremental(spark, landing, schema, target, ckpt, "IATA_CODE")
    # day 2: one new key, one changed row (not applied: inserts only), one repeat
    write_csv(spark.createDataFrame([("DL", "Delta"), ("UA", "United 2"), ("AA", "American")], schema), f"{landing}/day2")
    load_incremental(spark, landing, schema, target, ckpt, "IATA_CODE")
    load_incremental(spark, landing, schema, target, ckpt, "IATA_CODE")  # nothing new
    got = sorted((r.IATA_CODE, r.AIRLINE) for r in read_parquet(spark, target).collect())
    assert got == [("AA", "American"), ("DL", "Delta"), ("UA", "United")]
    assert "hash_id" in read_parquet(spark, target).columns


def test_transform_partitioned_layout(spark, tmp_path):
    import os

    root = str(tmp_path)
    src = _sources(spark, root)
    inputs = jobs.extract(spark, src, {n: f"{root}/raw/{n}" for n in src})
    staged = jobs.transform(spark, inputs, f"{root}/marts", partition_by={"flights_cancellation": ["DESTINATION_AIRPORT"]})
    folders = sorted(d for d in os.listdir(staged["flights_cancellation"]) if d.startswith("DESTINATION_AIRPORT="))
    assert folders == ["DESTINATION_AIRPORT=JFK", "DESTINATION_AIRPORT=LAX", "DESTINATION_AIRPORT=XXX"]
    back = read_parquet(spark, staged["flights_cancellation"]).filter("DESTINATION_AIRPORT = 'LAX'")
    assert [(r.AIRLINE, r.count_airlines_cancel) for r in back.collect()] == [("AA", 1)]


def test_cli_extract_with_declared_schema(spark, tmp_path):
    from martkit.plans import cli

    root = str(tmp_path)
    src = _sources(spark, root)
    out = cli.main(
        ["extract", "--source", f"df_airline={src['df_airline']}", "--target", f"df_airline={root}/raw",
         "--schema", "df_airline=IATA_CODE string, AIRLINE string"],
        spark=spark,
    )
    assert out == {"df_airline": f"{root}/raw"}
    assert read_parquet(spark, f"{root}/raw").dtypes == [("IATA_CODE", "string"), ("AIRLINE", "string")]
