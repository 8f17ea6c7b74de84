"""Null profile and read-back validation."""

from martkit.operators.quality import null_profile, readback_check


def test_null_profile(spark):
    df = spark.createDataFrame(
        [(None, 1, float("nan")), (None, 2, 1.0), (None, 3, None)], "a string, b int, c double"
    )
    got = [tuple(r) for r in null_profile(df).collect()]
    assert got == [("a", 3, True), ("b", 0, False), ("c", 1, True)]
    assert null_profile(df).dtypes == [("column_name", "string"), ("nulls", "bigint"), ("has_nulls", "boolean")]


def test_null_profile_is_one_job(spark):
    df = spark.range(10).selectExpr("id", "CASE WHEN id % 2 = 0 THEN NULL ELSE id END AS half")
    assert [tuple(r) for r in null_profile(df, ["half"]).collect()] == [("half", 5, True)]


def test_readback_check_counts_duplicates_and_nulls(spark):
    exp = spark.createDataFrame([("a", None), ("a", None), ("b", 1), (None, "a")], "x string, y string")
    act = spark.createDataFrame([("a", None), ("b", 1), ("c", 2), ("a", None), (None, "a")], "x string, y string")
    r = readback_check(exp, act).collect()[0]
    assert (r.expected_rows, r.actual_rows, r.missing_rows, r.extra_rows, r.matches) == (4, 5, 0, 1, False)
    same = readback_check(exp, exp).collect()[0]
    assert same.matches and same.missing_rows == 0


def test_readback_check_swapped_nulls_differ(spark):
    exp = spark.createDataFrame([("a", None)], "x string, y string")
    act = spark.createDataFrame([(None, "a")], "x string, y string")
    r = readback_check(exp, act).collect()[0]
    assert (r.missing_rows, r.extra_rows) == (1, 1)


def test_readback_check_empty(spark):
    e = spark.createDataFrame([], "x string")
    r = readback_check(e, e).collect()[0]
    assert (r.expected_rows, r.actual_rows, r.matches) == (0, 0, True)


def test_odd_column_names(spark):
    df = spark.createDataFrame([(None, 1)], "`a.b` string, `c d` int")
    assert [tuple(r) for r in null_profile(df).collect()] == [("a.b", 1, True), ("c d", 0, False)]
    assert readback_check(df, df).collect()[0].matches


def test_null_profile_no_columns(spark):
    assert null_profile(spark.range(3).select()).count() == 0
