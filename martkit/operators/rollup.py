"""Pre-aggregation of a fact table.

Every mart here is a count or a mean over group keys, possibly after equi-joins
that only filter or relabel the keys.  Aggregating the fact to its keys first
(with map-side combining) makes the later joins and shuffles work on key
combinations instead of raw rows, and makes hot keys harmless: a key holding a
third of the rows is reduced to one row per map task before any shuffle.

A ``Rollup`` can be built once and shared by several marts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "__rows"


def sum_col(measure: str) -> str:
    return f"__sum_{measure}"


def cnt_col(measure: str) -> str:
    return f"__cnt_{measure}"


@dataclass(frozen=True)
class Rollup:
    """A fact grouped by ``keys`` with its row count and per-measure sum/count."""

    df: DataFrame
    keys: tuple[str, ...]
    measures: tuple[str, ...] = ()

    def filter(self, condition: Column) -> Rollup:
        """Filter on key columns only (the condition must not need raw rows)."""
        return Rollup(self.df.filter(condition), self.keys, self.measures)


def rollup(
    fact: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] = (),
    distribute_by: Sequence[str] | None = None,
) -> Rollup:
    """Group ``fact`` by ``keys``: ``__rows`` = count(*), and for each measure
    its sum and non-null count (so a mean can be finished later).

    Sums of whole numbers never overflow: an int or bigint is summed in pieces of
    ``PIECE_BITS`` bits, each a plain bigint sum that holds 2^41 rows a group, and
    the pieces are put together as a decimal once per group.

    ``distribute_by`` deals the rolled-up rows by those columns into partitions
    of even size.  A value's rows go to ``SPLITS`` cells by a hash of the other
    keys, and cells are put together or split by their shuffled bytes (a
    rebalance), so a value that holds a third of all rows makes no large
    partition.  Raw rows never travel.
    """
    aggs = [F.count(F.lit(1)).alias(ROWS)]
    for m in measures:
        aggs += [*_pieces(fact, m), F.count(m).alias(cnt_col(m))]
    out = fact.groupBy(*keys).agg(*aggs)
    sums = [c for m in measures for c in (_whole(fact, m).alias(sum_col(m)), F.col(cnt_col(m)))]
    out = out.select(*keys, ROWS, *sums)
    if distribute_by:
        cell = F.pmod(F.xxhash64(*keys), F.lit(SPLITS))
        out = out.withColumn("__cell", cell).hint("rebalance", *distribute_by, "__cell").drop("__cell")
    return Rollup(out, tuple(keys), tuple(measures))


SPLITS = 64
PIECE_BITS = 21
PIECES = {T.LongType: 3, T.IntegerType: 2}


def _piece(measure: str, i: int) -> str:
    return f"__sum{i}_{measure}"


def _count_of_pieces(fact: DataFrame, measure: str) -> int:
    return PIECES.get(type(fact.schema[measure].dataType), 1)


def _pieces(fact: DataFrame, measure: str) -> list[Column]:
    n = _count_of_pieces(fact, measure)
    if n == 1:
        return [F.sum(measure).alias(_piece(measure, 0))]
    value = F.col(measure).cast("bigint")
    low = F.lit((1 << PIECE_BITS) - 1).cast("bigint")
    # the highest piece keeps the sign
    parts = [F.shiftright(value, PIECE_BITS * i) for i in range(n)]
    return [F.sum(p if i == n - 1 else p.bitwiseAND(low)).alias(_piece(measure, i)) for i, p in enumerate(parts)]


def _whole(fact: DataFrame, measure: str) -> Column:
    n = _count_of_pieces(fact, measure)
    if n == 1:
        return F.col(_piece(measure, 0))
    exact = "decimal(38,0)"
    terms = [(F.col(_piece(measure, i)).cast("decimal(19,0)") * F.lit(1 << (PIECE_BITS * i)).cast("decimal(19,0)")).cast(exact) for i in range(n)]
    return reduce(lambda a, b: (a + b).cast(exact), terms)


def as_rollup(
    fact: DataFrame | Rollup,
    keys: Sequence[str],
    measures: Sequence[str] = (),
    distribute_by: Sequence[str] | None = None,
) -> DataFrame:
    """The rolled-up rows of ``fact`` holding at least ``keys`` and ``measures``.

    A shared ``Rollup`` may carry more keys; callers re-aggregate over the keys
    they need, summing ``__rows`` and the measure columns.
    """
    if isinstance(fact, Rollup):
        missing = [k for k in keys if k not in fact.keys] + [m for m in measures if m not in fact.measures]
        if missing:
            raise ValueError(f"rollup lacks {missing}")
        return fact.df
    return rollup(fact, keys, measures, distribute_by).df
