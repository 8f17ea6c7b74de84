"""Order-free fingerprints of tables, and a comparison that reads rows only where
the fingerprints differ.

Each row is hashed to 128 bits, its NULLs and column places included.  Rows fall
into buckets by that hash (or by key columns); a bucket's fingerprint is its row
count and the sums of the hashes' four quarters.  Sums don't depend on order, are
combined map-side, and unlike xor they count repeated rows.  Two tables with
equal fingerprints are equal but for a chance of about 2^-64 a bucket, so a
comparison of equal tables moves ``buckets`` small rows and no other.

Where fingerprints differ, only the rows of those buckets are compared, as
multisets, by a 256-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.keys import column
from martkit.operators.quality import readback_check

BUCKETS = 4096
SUMS = ["s0", "s1", "s2", "s3"]


def _parts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """What a row's hash is taken of: each value, and whether it is NULL (a hash
    of several columns passes over NULLs).  Nested values go as JSON text, which
    keeps their own NULLs."""
    out = []
    for c in columns:
        value = column(c)
        if isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
        out += [value, column(c).isNull()]
    return out


def _hashes(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    parts = _parts(df, columns)
    return F.xxhash64(F.lit("first"), *parts), F.xxhash64(F.lit("second"), *parts)


def bucket(df: DataFrame, columns: Sequence[str], by: Sequence[str] | None, buckets: int) -> Column:
    """The bucket of a row, by the columns ``by`` or the whole row."""
    return F.pmod(F.xxhash64(F.lit("bucket"), *_parts(df, by or columns)), F.lit(buckets)).cast("int")


def fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """(bucket, rows, s0, s1, s2, s3) of each bucket that has rows.

    A quarter is below 2^32, so a sum holds 2^31 rows a bucket; beyond that raise
    ``buckets``."""
    names = list(columns) if columns is not None else list(df.columns)
    a, b = _hashes(df, names)
    low = F.lit((1 << 32) - 1).cast("bigint")
    quarters = [F.shiftrightunsigned(a, 32), a.bitwiseAND(low), F.shiftrightunsigned(b, 32), b.bitwiseAND(low)]
    rows = df.select(bucket(df, names, by, buckets).alias("bucket"), *[q.alias(s) for q, s in zip(quarters, SUMS, strict=True)])
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(s).alias(s) for s in SUMS])


Prints = dict[int, tuple[int, ...]]


def prints(*dfs: DataFrame, by: Sequence[str] | None = None, buckets: int = BUCKETS) -> list[Prints]:
    """The ``fingerprint`` of each table, taken in one job: its buckets' row counts
    and sums by bucket.  At most ``buckets`` small rows a table reach the driver."""
    each = [fingerprint(df, by=by, buckets=buckets).withColumn("i", F.lit(i)) for i, df in enumerate(dfs)]
    out: list[Prints] = [{} for _ in dfs]
    for r in reduce(DataFrame.unionByName, each).collect():
        out[r["i"]][r["bucket"]] = (r["rows"], *[r[c] for c in SUMS])
    return out


def table_digest(
    df: DataFrame, columns: Sequence[str] | None = None, taken: Prints | None = None
) -> tuple[str, int]:
    """(hex digest, rows) of a table, whatever the order of its rows: its column
    names and types and the sums over all buckets.  ``taken`` are the table's
    ``prints`` over these columns, if they are at hand."""
    names = list(columns) if columns is not None else list(df.columns)
    held = prints(df.select(*[column(c) for c in names]))[0] if taken is None else taken
    rows, *sums = [sum(p[i] for p in held.values()) for i in range(1 + len(SUMS))]
    kinds = ",".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names)
    text = "|".join([kinds, str(rows), *map(str, sums)])
    return hashlib.sha256(text.encode("utf-8")).hexdigest(), rows


REPORT = (
    "expected_rows bigint, actual_rows bigint, missing_rows bigint, extra_rows bigint, missing_columns string, "
    "extra_columns string, changed_types string, differing_buckets int, matches boolean"
)


def compare_tables(
    expected: DataFrame,
    actual: DataFrame,
    by: Sequence[str] | None = None,
    buckets: int = BUCKETS,
    taken: Prints | None = None,
) -> DataFrame:
    """V1: whether two tables have the same columns, types and multiset of rows.

    One row (``REPORT``).  Names and types come first and cost nothing: columns
    that only one side has, and types that differ (``name: int -> bigint``), each
    make ``matches`` false; rows are then compared over the shared columns, those
    of differing types as text.  The order of columns and rows doesn't matter.
    The driver holds both tables' fingerprints, ``buckets`` small rows each at most.
    ``taken`` are the ``prints`` of ``expected`` with their defaults, if they are at
    hand; they serve where the comparison is over the same columns and buckets."""
    spark = expected.sparkSession
    theirs = {f.name: f.dataType for f in actual.schema.fields}
    own = {f.name: f.dataType for f in expected.schema.fields}
    shared = [c for c in own if c in theirs]
    missing, extra = [c for c in own if c not in theirs], [c for c in theirs if c not in own]
    changed = [c for c in shared if own[c] != theirs[c]]
    types = [f"{c}: {own[c].simpleString()} -> {theirs[c].simpleString()}" for c in changed]
    told = [", ".join(missing), ", ".join(extra), ", ".join(types)]

    def shown(df: DataFrame) -> DataFrame:
        return df.select(*[column(c).cast("string").alias(c) if c in changed else column(c) for c in shared])

    e, a = shown(expected), shown(actual)
    keys = [c for c in by or [] if c in shared] or None
    serves = taken is not None and not (missing or changed or keys) and buckets == BUCKETS
    fe, fa = (taken, *prints(a, buckets=buckets)) if serves else prints(e, a, by=keys, buckets=buckets)
    rows_e, rows_a = (sum(p[0] for p in held.values()) for held in (fe, fa))
    differ = sorted(b for b in fe.keys() | fa.keys() if fe.get(b) != fa.get(b))
    if not differ:
        done = (rows_e, rows_a, 0, 0, *told, 0, not any(told))
        # literals need no task; rows handed over by the driver take several jobs
        return spark.sql("SELECT 1").select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(done, T.StructType.fromDDL(REPORT), strict=True)]
        )
    part = [df.where(bucket(df, shared, keys, buckets).isin(differ)) for df in (e, a)]
    return readback_check(*part).select(
        F.lit(rows_e).cast("bigint").alias("expected_rows"), F.lit(rows_a).cast("bigint").alias("actual_rows"), "missing_rows", "extra_rows",
        *[F.lit(t).alias(n) for t, n in zip(told, ("missing_columns", "extra_columns", "changed_types"), strict=True)],
        F.lit(len(differ)).alias("differing_buckets"), F.lit(False).alias("matches"),
    )
