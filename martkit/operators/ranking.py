"""Rank within groups (``rank()``: ties share a rank, gaps follow).

``method="window"`` is the plain window function.  It sends every row of one
group to one task, so a group holding a third of the data sorts a third of the
data on one core.

``method="histogram"`` first collapses the rows to distinct (group, value)
pairs with their row counts (combined map-side), ranks those with a window,
and joins the ranks back.  A window then holds the *distinct values* of one
group, not its rows.  When the ranked value is itself a row count (as for
visit counts), a group whose counts add up to N has at most sqrt(2N) distinct
values, so even a group with a third of all rows stays small.

``method="distributed"`` (the default) computes the same numbers without ever
holding a whole group, whatever the values:

1. collapse the input to its distinct (group, value) pairs with their row
   counts (map-side combined, so duplicates never travel);
2. range-partition those pairs on (group, value order) — a hot group is split
   over many consecutive ranges — and number each range (``b``);
3. a row's rank is 1 + rows in earlier ranges of its group + rows before it in
   its own range.  The first term is a window over one row per (group, range),
   the second a window inside one range, so no window sees more than a range;
4. join the ranks back to the input rows on (group, value).

Ties never straddle two ranges, because a (group, value) pair is one row when
the ranges are cut.  The numbered pairs are written once to the checkpoint
folder: both uses of the range numbers must see the same cut, whether or not
Spark reuses the exchange, and a recomputation after a lost executor re-reads
the numbers instead of cutting again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.operators.sizing import BroadcastPolicy, dimension
from martkit.session import materialize


def _order(col: str, descending: bool) -> Column:
    # Spark's defaults: ascending puts NULLs first, descending puts them last.
    return F.col(col).desc() if descending else F.col(col).asc()


def rank_within(
    df: DataFrame,
    partition_by: str | Sequence[str],
    order_by: str,
    *,
    name: str = "ranking",
    descending: bool = True,
    method: str = "distributed",
    ranges: int | None = None,
    broadcast: BroadcastPolicy | bool | None = False,
) -> DataFrame:
    """``df`` plus ``name`` (bigint) = rank of ``order_by`` inside ``partition_by``."""
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    if method == "window":
        w = Window.partitionBy(*parts).orderBy(_order(order_by, descending))
        return df.withColumn(name, F.rank().over(w).cast("bigint"))
    if method == "histogram":
        ranks = _histogram_ranks(df, parts, order_by, descending)
    elif method == "distributed":
        ranks = _value_ranks(df, parts, order_by, descending, ranges)
    else:
        raise ValueError(f"unknown method {method!r}")
    ranks = dimension(ranks, broadcast)
    keys = parts + [order_by]
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(ranks[f"__r_{i}"]) for i, k in enumerate(keys)])
    return df.join(ranks, cond, "inner").select(*[df[c] for c in df.columns], F.col("__rank").alias(name))


def _histogram_ranks(df: DataFrame, parts: list[str], value: str, descending: bool) -> DataFrame:
    hist = df.groupBy(*parts, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*parts).orderBy(_order(value, descending)).rowsBetween(Window.unboundedPreceding, -1)
    keys = parts + [value]
    return hist.select(
        *[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)],
        (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).cast("bigint").alias("__rank"),
    )


def _value_ranks(
    df: DataFrame, parts: list[str], value: str, descending: bool, ranges: int | None
) -> DataFrame:
    """One row per distinct (parts, value) with its rank, as ``__r_i`` columns + ``__rank``."""
    order = _order(value, descending)
    hist = df.groupBy(*parts, value).agg(F.count(F.lit(1)).alias("__n"))
    # Without an explicit count, AQE sizes the ranges to the advisory partition
    # size and merges only neighbouring ranges, so range numbers stay in order.
    by = [*[F.col(p) for p in parts], order]
    numbered = (hist.repartitionByRange(ranges, *by) if ranges else hist.repartitionByRange(*by)).withColumn(
        "__b", F.spark_partition_id()
    )
    # The numbering feeds two branches (range totals and in-range prefixes).
    # Evaluated twice, each would sample its own range bounds, so it is written
    # once to the checkpoint folder and both branches read the same numbers.
    cut = materialize(numbered, "rank_ranges")
    before = Window.unboundedPreceding
    # rows of the same group in earlier ranges
    totals = cut.groupBy(*parts, "__b").agg(F.sum("__n").alias("__bn"))
    offsets = totals.select(
        *[F.col(p).alias(f"__o_{i}") for i, p in enumerate(parts)],
        F.col("__b").alias("__ob"),
        F.coalesce(
            F.sum("__bn").over(Window.partitionBy(*parts).orderBy("__b").rowsBetween(before, -1)),
            F.lit(0),
        ).alias("__off"),
    )
    # rows of the same group before this value inside its range
    local = cut.withColumn(
        "__loc",
        F.coalesce(
            F.sum("__n").over(Window.partitionBy(*parts, "__b").orderBy(order).rowsBetween(before, -1)),
            F.lit(0),
        ),
    )
    cond = reduce(
        lambda a, b: a & b,
        [local[p].eqNullSafe(offsets[f"__o_{i}"]) for i, p in enumerate(parts)] + [local["__b"] == offsets["__ob"]],
    )
    ranked = local.join(offsets, cond, "inner")
    keys = parts + [value]
    return ranked.select(
        *[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)],
        (F.col("__off") + F.col("__loc") + 1).cast("bigint").alias("__rank"),
    )
