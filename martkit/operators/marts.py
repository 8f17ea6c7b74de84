"""The mart aggregates: mean per dimension label, visit counts, flagged counts
and the referential-integrity (orphan) report.

All of them aggregate the fact to its keys first (``operators.rollup``), then
join the small rolled-up rows to the dimensions, then finish the aggregate.
Dimension columns are renamed before the join so a fact and a dimension column
with the same name never collide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.rollup import ROWS, Rollup, as_rollup, cnt_col, sum_col
from martkit.operators.sizing import BroadcastPolicy, decide_many, dimension

Policy = BroadcastPolicy | bool | None


def dim_average(
    fact: DataFrame | Rollup,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    label: str,
    measure: str,
    *,
    scale: int | None = None,
    label_name: str | None = None,
    value_name: str | None = None,
    order: bool = True,
    broadcast: Policy = None,
    distribute_by: Sequence[str] | None = None,
) -> DataFrame:
    """M1 (J1, A1/A2, A7, O1, P2): mean of ``measure`` per (fact key, dimension
    label), inner join on the key.

    Grouping is by code *and* label, so two codes sharing a label stay two rows.
    NULL measures are skipped; a key with only NULLs has a NULL mean (sorted
    last).  ``scale`` rounds half-up.  Output: (label_name, value_name), sorted by
    the mean descending, label ascending as tie-break.

    ``broadcast`` defaults to no hint: the rolled-up fact is already
    hash-partitioned by ``fact_key``, so a shuffle join moves only the
    dimension, and the planner (or AQE, from real sizes) broadcasts it when small.
    """
    label_name = label_name or label
    value_name = value_name or f"avg_{measure}"
    r = as_rollup(fact, [fact_key], [measure], distribute_by)
    d = dim.select(F.col(dim_key).alias("__dk"), F.col(label).alias("__label"))
    d = dimension(d, False if broadcast is None else broadcast)
    joined = r.join(d, r[fact_key] == d["__dk"], "inner")
    grouped = joined.groupBy(fact_key, "__label").agg(
        F.sum(sum_col(measure)).alias("__s"), F.sum(cnt_col(measure)).alias("__c")
    )
    # an exact sum of whole numbers is a decimal, whose quotient would be cut to a few digits
    mean = F.try_divide(F.col("__s").cast("double"), F.col("__c"))
    if scale is not None:
        mean = F.round(mean, scale)
    out = grouped.select(F.col("__label").alias(label_name), mean.alias(value_name))
    if order:
        out = out.orderBy(F.col(value_name).desc(), F.col(label_name).asc())
    return out


def visit_counts(
    fact: DataFrame | Rollup,
    places: DataFrame,
    carriers: DataFrame,
    *,
    origin: str,
    dest: str,
    carrier: str,
    place_key: str,
    carrier_key: str,
    carrier_label: str,
    dest_name: str | None = None,
    label_name: str | None = None,
    count_name: str = "Count_visit_per_airline",
    order: bool = True,
    broadcast: Policy = None,
    broadcast_places: Policy = None,
    distribute_by: Sequence[str] | None = None,
) -> DataFrame:
    """M2 (J2, A3, O2, P3): rows per (destination, carrier label) among rows
    whose *origin* is a listed place.

    Both lookups are inner joins, not semi-joins: a place or carrier code listed
    twice counts its rows twice.  Carriers sharing a label merge into one group.
    Output: (dest_name, label_name, count_name), sorted by destination, label.

    The rolled-up fact is partitioned by all three keys, while the joins are on
    origin and on carrier, so here a broadcast saves two exchanges: both
    dimensions are measured in one map-side counting job and hinted when they fit.
    """
    dest_name = dest_name or dest
    label_name = label_name or carrier_label
    r = as_rollup(fact, [origin, carrier, dest], distribute_by=distribute_by)
    p = places.select(F.col(place_key).alias("__pk"))
    c = carriers.select(F.col(carrier_key).alias("__ck"), F.col(carrier_label).alias("__cl"))
    p_bc, c_bc = decide_many([(p, broadcast_places if broadcast_places is not None else broadcast), (c, broadcast)])
    p = F.broadcast(p) if p_bc else p
    c = F.broadcast(c) if c_bc else c
    joined = r.join(p, r[origin] == p["__pk"], "inner").join(c, r[carrier] == c["__ck"], "inner")
    out = joined.groupBy(F.col(dest).alias(dest_name), F.col("__cl").alias(label_name)).agg(
        F.sum(ROWS).alias(count_name)
    )
    if order:
        out = out.orderBy(F.col(dest_name).asc(), F.col(label_name).asc())
    return out


def flagged_counts(
    fact: DataFrame | Rollup,
    flag: str,
    value: object,
    keys: Sequence[str],
    *,
    count_of: str | None = None,
    name: str = "count_airlines_cancel",
    order_by: Sequence[Column] | None = None,
    limit: int | None = None,
    distribute_by: Sequence[str] | None = None,
) -> DataFrame:
    """M4 / M5 (P1, F1, A4, O3, O4): non-null ``count_of`` (default: the first
    key) per ``keys`` among rows where ``flag == value``.

    The comparison follows Spark's coercion (an int, double or boolean flag
    matches the text "1"; the text "1.0" does not) and is pushed into the scan.
    A NULL ``count_of`` group is kept with count 0.  ``order_by`` defaults to the
    last key descending, then the others ascending; ``limit`` keeps the top rows
    of that order (a top-k, planned as TakeOrderedAndProject).
    """
    keys = list(keys)
    count_of = count_of or keys[0]
    # the rollup keeps count_of as a key so its NULLs can be told apart
    rolled = keys + ([count_of] if count_of not in keys else [])
    condition = F.col(flag) == F.lit(value)
    if isinstance(fact, Rollup):
        r = as_rollup(fact.filter(condition), rolled + [flag])
    else:
        r = as_rollup(fact.filter(condition), rolled, distribute_by=distribute_by)
    counted = F.when(F.col(count_of).isNotNull(), F.col(ROWS)).otherwise(F.lit(0))
    out = r.groupBy(*keys).agg(F.sum(counted).cast("bigint").alias(name))
    if order_by is None:
        order_by = [F.col(keys[-1]).desc()] + [F.col(k).asc() for k in keys[:-1]]
    out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    return out


def orphan_counts(
    fact: DataFrame | Rollup,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    *,
    name: str = "Count_airports",
    broadcast: Policy = None,
    distribute_by: Sequence[str] | None = None,
) -> DataFrame:
    """M6 (J3, P4, A5): fact rows per ``fact_key`` value that is not in ``dim``
    (a left anti-join).

    A NULL key matches nothing, so NULL-key rows are reported as one group.
    As in ``dim_average``, the rolled-up fact is already partitioned by the key,
    so without a hint only the dimension moves.
    """
    r = as_rollup(fact, [fact_key], distribute_by=distribute_by)
    # an anti-join needs each listed key once; duplicates are combined map-side
    d = dimension(dim.select(F.col(dim_key).alias("__dk")).distinct(), False if broadcast is None else broadcast)
    orphans = r.join(d, r[fact_key] == d["__dk"], "left_anti")
    return orphans.groupBy(fact_key).agg(F.sum(ROWS).alias(name))
