"""Reducing a large target to the keys of a small delivery before any shuffle.

``narrow`` keeps every target row whose key is in the source and drops most or
all of the others where the rows are read:

1. the least and greatest source key become literals of a filter, which reaches
   the Parquet scan and skips row groups and pages (whole numbers, dates,
   decimals and strings; others have no such filter);
2. a source whose keys were measured to fit a broadcast is one: a semi-join that
   leaves exactly the matching rows, in the task that read them;
3. a larger source becomes a table of bits: each key sets one bit of
   ``filter_bits``, and a target row stays if its bit is set.  The table has at
   most ``filter_bits`` / 64 rows whatever the source's size, so its broadcast is
   bounded; with b bits a key about one in b of the other rows stays too;
4. beyond ``filter_bits`` / 2 keys only the range is left, and the join that
   follows shuffles what it must.

What is left is a superset of the rows that match, so the joins that follow are
unchanged.  One job over the source's key columns measures rows, bytes and range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.keys import column
from martkit.operators.sizing import row_width

RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.DecimalType, T.StringType)
WORD_BITS = 64


@dataclass(frozen=True)
class Pruning:
    """``max_rows``/``max_bytes``: the largest set of keys that is broadcast as it
    is.  ``filter_bits``: the size of the bit table for larger ones.
    ``min_target_bytes``: a target that the planner estimates to be smaller isn't
    worth the measuring job."""

    max_rows: int = 2_000_000
    max_bytes: int = 32 * 1024 * 1024
    filter_bits: int = 1 << 26
    min_target_bytes: int = 64 * 1024 * 1024


AUTO_PRUNE = Pruning()
NO_PRUNE = None


@dataclass(frozen=True)
class KeyStats:
    rows: int
    bytes: int
    least: tuple
    most: tuple
    has_null: tuple

    def fits(self, policy: Pruning) -> bool:
        return self.rows <= policy.max_rows and self.bytes <= policy.max_bytes


def key_stats(src: DataFrame, keys: Sequence[str]) -> KeyStats:
    """Rows, bytes and the range of each key column, counted map-side in one job."""
    own = src.select(*[column(k) for k in keys])
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(row_width(own)).alias("bytes")]
    for i, field in enumerate(own.schema.fields):
        ranged = isinstance(field.dataType, RANGED)
        for name, f in (("lo", F.min), ("hi", F.max)):
            aggs.append((f(column(field.name)) if ranged else F.lit(None)).alias(f"{name}{i}"))
        aggs.append((F.count_if(column(field.name).isNull()) > 0).alias(f"null{i}"))
    row = own.agg(*aggs).first()
    each = lambda name: tuple(row[f"{name}{i}"] for i in range(len(keys)))
    return KeyStats(int(row["rows"]), int(row["bytes"] or 0), each("lo"), each("hi"), each("null"))


def worth_pruning(tgt: DataFrame, policy: Pruning | None) -> bool:
    if policy is None:
        return False
    if policy.min_target_bytes <= 0:
        return True
    jdf = getattr(tgt, "_jdf", None)  # a Connect session has no planner to ask
    return jdf is None or int(str(jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= policy.min_target_bytes


def _range(tgt: DataFrame, src: DataFrame, keys: Sequence[str], stats: KeyStats, nulls: bool) -> Column | None:
    parts = []
    for i, k in enumerate(keys):
        kind = tgt.schema[k].dataType
        if not isinstance(kind, RANGED) or kind != src.schema[k].dataType:
            continue
        if stats.least[i] is None:  # only NULL keys
            parts.append(column(k).isNull() if nulls else F.lit(False))
            continue
        inside = column(k).between(F.lit(stats.least[i]).cast(kind), F.lit(stats.most[i]).cast(kind))
        parts.append(inside | column(k).isNull() if nulls and stats.has_null[i] else inside)
    return reduce(lambda a, b: a & b, parts) if parts else None


def bit_table(src: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(__word, __mask): the bits that the keys set, 64 to a row."""
    place = F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(bits))
    words = src.select(
        F.shiftright(place, 6).alias("__word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(WORD_BITS - 1).cast("int")).alias("__bit"),
    )
    return words.groupBy("__word").agg(F.bit_or("__bit").alias("__mask"))


def narrow(
    tgt: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    policy: Pruning | None = AUTO_PRUNE,
    nulls: bool = False,
    stats: KeyStats | None = None,
) -> DataFrame:
    """The target's rows whose key may be in the source; all that match are kept.

    ``nulls``: whether a NULL key matches a NULL key (else such rows may go)."""
    keys = list(keys)
    if not worth_pruning(tgt, policy):
        return tgt
    stats = stats or key_stats(src, keys)
    if not stats.rows:
        return tgt.where(F.lit(False))
    within = _range(tgt, src, keys, stats, nulls)
    out = tgt if within is None else tgt.where(within)
    same_types = all(tgt.schema[k].dataType == src.schema[k].dataType for k in keys)
    if stats.fits(policy):
        wanted = F.broadcast(src.select(*[column(k).alias(f"__p{i}") for i, k in enumerate(keys)]).distinct())
        match = [out[f"`{k}`"].eqNullSafe(wanted[f"__p{i}"]) if nulls else out[f"`{k}`"] == wanted[f"__p{i}"] for i, k in enumerate(keys)]
        return out.join(wanted, reduce(lambda a, b: a & b, match), "left_semi")
    if same_types and stats.rows <= policy.filter_bits // 2:
        place = F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(policy.filter_bits))
        table = F.broadcast(bit_table(src, keys, policy.filter_bits))
        bit = F.call_function("shiftright", F.col("__mask"), place.bitwiseAND(WORD_BITS - 1).cast("int")).bitwiseAND(F.lit(1).cast("bigint"))
        return out.join(table, (F.shiftright(place, 6) == F.col("__word")) & (bit == 1), "left_semi")
    return out
