"""Size-checked broadcast of dimension tables.

A broadcast hint is only placed on a side whose size has been measured: one
job counts its rows and bytes.  A side over either bound gets no hint; the
planner then uses a shuffle join, and AQE may still switch to a broadcast at
run time from the real shuffle size.

Cost: one pass over the projected columns (the one or two the join needs),
counted map-side, so only one small row per task is shuffled.  (A
``limit(n)`` would stop reading early, but its global limit gathers up to n
rows from every task into a single task.)  All dimensions of one operator
share one job.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.keys import column

_FIXED_WIDTH = {
    T.ByteType: 1,
    T.BooleanType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}
ROW_OVERHEAD = 16  # bytes per row in a hashed broadcast relation, roughly


@dataclass(frozen=True)
class BroadcastPolicy:
    """``mode``: "auto" (measure, then hint), "always" (hint unmeasured) or "never"."""

    mode: str = "auto"
    max_rows: int = 2_000_000
    max_bytes: int = 32 * 1024 * 1024


AUTO = BroadcastPolicy()


def _width(field: T.StructField) -> Column:
    for dtype, size in _FIXED_WIDTH.items():
        if isinstance(field.dataType, dtype):
            return F.lit(size)
    col = column(field.name)
    if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        col = col.cast("string")
    return F.coalesce(F.octet_length(col), F.lit(0))


def row_width(df: DataFrame) -> Column:
    """Bytes of a row in a hashed broadcast relation, roughly."""
    width = F.lit(ROW_OVERHEAD)
    for field in df.schema.fields:
        width = width + _width(field)
    return width


def _size(df: DataFrame, index: int) -> DataFrame:
    return df.agg(F.lit(index).alias("i"), F.count(F.lit(1)).alias("rows"), F.sum(row_width(df)).alias("bytes"))


def measure_many(dfs: list[DataFrame], max_rows: int | None = None) -> list[tuple[int, int]]:
    """(rows, bytes) of each frame; one job for all of them, one small row per
    frame returned to the driver.  ``max_rows`` is accepted for callers that
    state their bound; the count is exact either way."""
    if not dfs:
        return []
    parts = [_size(df, i) for i, df in enumerate(dfs)]
    found = {r["i"]: (int(r["rows"]), int(r["bytes"] or 0)) for r in reduce(DataFrame.unionByName, parts).collect()}
    return [found[i] for i in range(len(dfs))]


def measure(df: DataFrame, max_rows: int | None = None) -> tuple[int, int]:
    return measure_many([df], max_rows)[0]


def fits_broadcast(df: DataFrame, policy: BroadcastPolicy = AUTO) -> bool:
    rows, size = measure(df, policy.max_rows)
    return rows <= policy.max_rows and size <= policy.max_bytes


def decide_many(items: list[tuple[DataFrame, BroadcastPolicy | bool | None]]) -> list[bool]:
    """``decide`` for several frames, measuring all "auto" ones in one job."""
    out: list[bool | None] = []
    pending: list[tuple[int, DataFrame, BroadcastPolicy]] = []
    for i, (df, policy) in enumerate(items):
        if isinstance(policy, bool):
            out.append(policy)
            continue
        policy = policy or AUTO
        out.append(None if policy.mode == "auto" else policy.mode == "always")
        if policy.mode == "auto":
            pending.append((i, df, policy))
    if pending:
        bound = max(p.max_rows for _, _, p in pending)
        for (i, _, policy), (rows, size) in zip(pending, measure_many([d for _, d, _ in pending], bound)):
            out[i] = rows <= policy.max_rows and size <= policy.max_bytes
    return [bool(x) for x in out]


def decide(df: DataFrame, policy: BroadcastPolicy | bool | None) -> bool:
    """Whether to hint ``df`` for broadcast under ``policy``."""
    return decide_many([(df, policy)])[0]


def dimension(df: DataFrame, policy: BroadcastPolicy | bool | None = None) -> DataFrame:
    """``df`` with a broadcast hint when ``policy`` allows it."""
    return F.broadcast(df) if decide(df, policy) else df
