"""Global positions: the row number of every row in one total order, without a
window that holds all rows.

The rows are range-partitioned on the order and sorted within each range, so the
ranges are consecutive pieces of the answer.  A row's position is its place in
its range plus the rows of the ranges before it; those counts are one small row
a range.  Nothing but ranges is ever gathered, and a range has a bounded share of
the rows unless many are equal in the whole order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.session import materialize

RANGE_BITS = 33  # monotonically_increasing_id: the range above, the place in it below


def with_positions(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "position", start: int = 1, ranges: int | None = None
) -> DataFrame:
    """O1 to O3: ``df`` plus ``name`` (bigint), the row's place in the order.

    Rows that are equal in ``order_by`` get consecutive places in an order of their
    own; name enough columns to make it total where that matters.  ``ranges`` fixes
    the number of ranges (by default adaptive execution sizes them).  The sorted
    rows are written once, so a lost executor can't deal them differently; the
    driver holds one count a range."""
    order = [F.col(c).asc() if isinstance(c, str) else c for c in order_by]
    if not order:
        raise ValueError("an order needs at least one column")
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    placed = materialize(dealt.sortWithinPartitions(*order).withColumn("__i", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("__i", RANGE_BITS)
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    shifts, before = [], start
    for p, n in counts:
        shifts.append((p, before - (p << RANGE_BITS)))
        before += n
    spark = df.sparkSession
    offsets = F.broadcast(spark.createDataFrame(shifts, "__p bigint, __shift bigint"))
    found = placed.join(offsets, part == F.col("__p"), "inner")
    return found.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__i") + F.col("__shift")).alias(name))
