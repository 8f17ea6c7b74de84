"""Sources, sinks and contracts."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from martkit.operators.sizing import BroadcastPolicy, decide, decide_many, measure
from martkit.sources.contracts import MART_SCHEMAS, conform
from martkit.sources import files
from martkit.sources.files import copy_datasets, csv_to_parquet, read_csv, read_parquet, write_csv, write_parquet
from martkit.sources.jdbc import jdbc_options
from martkit.sources.tables import read_table, write_table


def test_csv_inferred_and_declared(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "k int, s string, d double")
    write_csv(df, str(tmp_path / "c"))
    inferred = read_csv(spark, str(tmp_path / "c"))
    assert dict(inferred.dtypes) == {"k": "int", "s": "string", "d": "double"}
    declared = read_csv(spark, str(tmp_path / "c"), schema="k long, s string, d double")
    assert dict(declared.dtypes)["k"] == "bigint"
    assert sorted(map(tuple, declared.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


HEADS = "k,s,d\n" + "".join(f"{i},Ab,1.5\n" for i in range(300))


@pytest.mark.parametrize(
    "text, passes",
    [
        (HEADS + "7,,\n,Cd,NaN\n", 1),  # the first rows settle the types, and the others fit them
        (HEADS + "XYZ,Ab,1.5\n", 2),
        (HEADS + "99999999999,Ab,1.5\n", 2),
        (HEADS + "0.5,Ab,1.5\n", 2),
        (HEADS + " 7,Ab,1.5\n", 2),
        (HEADS + "7\n", 2),  # too few fields
        (HEADS + "7,Ab,1.5,9\n", 2),  # too many
        ("k,t,e\n" + "1,2024-01-01,\n" * 300 + "2,2024-01-02,5\n", 1),  # left open: a date, and a number late
        ("k,f\n1,true\n2,N\n", 1),
    ],
)
def test_copied_csv_has_the_inferred_types_and_rows(spark, tmp_path, monkeypatch, text, passes):
    (tmp_path / "c.csv").write_text(text)
    path, target = str(tmp_path / "c.csv"), str(tmp_path / "p")
    want = read_csv(spark, path)
    tried = []
    monkeypatch.setattr(files, "write_parquet", lambda df, at: (tried.append(df.dtypes), write_parquet(df, at)))
    csv_to_parquet(spark, path, target)
    got = read_parquet(spark, target)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert len(tried) == passes


def test_extract_reads_a_settled_csv_once(spark, tmp_path, monkeypatch):
    from martkit.plans import jobs

    write_csv(spark.range(500).selectExpr("id AS k", "concat('n', id) AS s", "id / 4 AS d"), str(tmp_path / "c"))
    inferred, read = [], files.read_csv
    monkeypatch.setattr(files, "read_csv", lambda spark, path, schema=None, *a: (inferred.append(schema is None), read(spark, path, schema, *a))[1])
    monkeypatch.setattr(jobs, "read_csv", files.read_csv, raising=False)
    out = jobs.extract(spark, {"x": str(tmp_path / "c")}, {"x": str(tmp_path / "p")})
    assert read_parquet(spark, out["x"]).dtypes == [("k", "int"), ("s", "string"), ("d", "double")]
    assert inferred == [False]


def test_csv_mixed_column_is_text(spark, tmp_path):
    p = tmp_path / "mixed.csv"
    p.write_text("code\n10\nXYZ\n")
    assert read_csv(spark, str(p)).dtypes == [("code", "string")]


def test_parquet_roundtrip_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_parquet(df, str(tmp_path / "p"), partition_by=["k"])
    back = read_parquet(spark, str(tmp_path / "p"))
    assert sorted((r.k, r.v) for r in back.collect()) == [("a", 1), ("b", 2)]
    write_parquet(df.limit(1), str(tmp_path / "p"))  # overwrite
    assert read_parquet(spark, str(tmp_path / "p")).count() == 1


def test_copy_datasets(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    for name in ("df_airline", "df_airports"):
        spark.createDataFrame([(name,)], "n string").write.parquet(str(src / name))
    written = copy_datasets(spark, ["df_airline", "df_airports"], f"file://{src}", f"file://{dst}/")
    assert written == [f"file://{dst}/df_airline", f"file://{dst}/df_airports"]
    assert read_parquet(spark, str(dst / "df_airports")).collect()[0].n == "df_airports"


def test_format_table_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write_table(df, "parquet", {"compression": "zstd"}, path=str(tmp_path / "t"))
    assert read_table(spark, "parquet", path=str(tmp_path / "t")).collect()[0].k == "a"


def test_jdbc_options():
    opts = jdbc_options(
        "jdbc:postgresql://db/x", "airlines", {"user": "u", "password": "p"},
        partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4, batch_size=1000, truncate=True,
    )
    assert opts == {
        "url": "jdbc:postgresql://db/x", "dbtable": "airlines", "user": "u", "password": "p",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
        "batchsize": "1000", "truncate": "true",
    }
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="id")


def test_conform(spark):
    df = spark.createDataFrame([(7, "x", 3, "extra")], "DESTINATION_AIRPORT int, AIRLINE string, Count_visit_per_airline int, junk string")
    schema = StructType(MART_SCHEMAS["airline_in_airport"].fields[:3])
    out = conform(df, schema)
    assert out.schema == StructType([
        StructField("DESTINATION_AIRPORT", StringType()), StructField("AIRLINE", StringType()),
        StructField("Count_visit_per_airline", LongType()),
    ])
    with pytest.raises(ValueError):
        conform(df, MART_SCHEMAS["airline_in_airport"])


def test_size_check(spark):
    small = spark.range(10).selectExpr("id", "'abc' AS s")
    assert measure(small, 100) == (10, 10 * (16 + 8 + 3))
    assert measure(spark.range(1000))[0] == 1000
    assert decide(small, None) is True
    assert decide(small, BroadcastPolicy(max_rows=5)) is False
    assert decide(small, BroadcastPolicy(max_bytes=100)) is False
    assert decide(small, BroadcastPolicy(mode="never")) is False
    assert decide_many([(small, None), (spark.range(50), BroadcastPolicy(max_rows=10)), (small, True)]) == [True, False, True]


def test_shuffle_partitions_for():
    from martkit.session import shuffle_partitions_for

    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(2 * 1024**4) == 16384
    assert shuffle_partitions_for(128 * 1024**2 + 1, min_partitions=1) == 2


def test_failed_jdbc_load_raises(spark, tmp_path):
    """No database is started: the URL names no driver, and the error must
    reach the caller instead of being swallowed."""
    from martkit.plans import jobs

    staged = str(tmp_path / "mart")
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(staged)
    sink = jobs.jdbc_sink("jdbc:nodriver://nowhere/db", {"user": "u"})
    with pytest.raises(Exception, match="(?i)driver"):
        jobs.load(spark, {"avg_flight": staged}, sink)


def test_table_sink_passes_dataset_table_id(spark):
    """The warehouse sink's call shape (format + "table" option, overwrite),
    run with the built-in noop format since no connector jar is present."""
    from martkit.plans import jobs
    from martkit.sources.tables import table_id

    assert table_id("warehouse_prod", "avg_flight") == "warehouse_prod.avg_flight"
    sink = jobs.table_sink("noop", "warehouse_prod", {"writeMethod": "direct"})
    sink(spark.createDataFrame([("a", 1.0)], "AIRLINE_Name string, avg_DISTANCE double"), "avg_flight")
