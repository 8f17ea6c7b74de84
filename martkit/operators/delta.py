"""Incremental load against an existing table: which source rows are new,
changed or unchanged, and how to apply them.

Source and target carry a business key and a row digest (see
``functions.row_hash``).  Every set is computed from one plan over the source
and the target as they are *before* any write; ``apply_inserts`` cuts the
lineage first, so appending to the target cannot change the rows appended.

The sets of D2 to D4 match keys as SQL does: a NULL key equals nothing.  What
is *applied* to a target (``apply_inserts``, ``upsert_snapshot``) matches NULL
keys with NULL keys and takes one source row per key, the one with the largest
digest, so a delivery that is replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.pruning import AUTO_PRUNE, Pruning, key_stats, narrow, worth_pruning
from martkit.session import materialize

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _target_keys(tgt: DataFrame, src: DataFrame, keys: list[str], prune: Pruning | None) -> DataFrame:
    """The target's distinct keys, of a large target only those that may be in
    the source.  Deduplicated map-side, so a key stored many times is one row
    when the join partitions are built."""
    return narrow(tgt.select(*keys), src, keys, prune).select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct()


def _target_digests(tgt: DataFrame, src: DataFrame, hash_col: str, prune: Pruning | None) -> DataFrame:
    """The target's distinct digests, of a large target only those that may be in
    the source."""
    return narrow(tgt.select(hash_col), src, [hash_col], prune).select(F.col(hash_col).alias("__t_hash")).distinct()


def _key_match(src: DataFrame, tk: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [src[k] == tk[f"__t_{k}"] for k in keys])


def _same_key(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    """Null-safe match of ``left``'s keys with ``right``'s prefixed ones."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def one_per_key(src: DataFrame, key: str | Sequence[str], hash_col: str = "hash_id") -> DataFrame:
    """One row per key (NULL is a key like any other): the one with the largest
    digest (a row without one counts as the smallest; rows alike in that, and
    sources without such a column, go by a hash of the row).  ``max_by`` combines
    map-side, so a key repeated many times never gathers in one task."""
    keys = _keys(key)
    rest = [c for c in src.columns if c not in keys]
    if not rest:
        return src.distinct()
    order = [F.xxhash64(*rest)]
    if hash_col in rest:
        order.insert(0, F.coalesce(F.col(hash_col).cast("string"), F.lit("")))
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return src.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in src.columns])


def delta_inserts(
    src: DataFrame, tgt: DataFrame, key: str | Sequence[str], prune: Pruning | None = AUTO_PRUNE
) -> DataFrame:
    """Source rows whose key is absent from the target (a left anti-join).

    Here and below ``prune`` says how a large target is reduced to the source's
    keys where it is read (``operators.pruning``), so that none of its other rows
    is shuffled."""
    keys = _keys(key)
    tk = _target_keys(tgt, src, keys, prune)
    return src.join(tk, _key_match(src, tk, keys), "left_anti")


def delta_matched(
    src: DataFrame,
    tgt: DataFrame,
    key: str | Sequence[str],
    hash_col: str = "hash_id",
    prune: Pruning | None = AUTO_PRUNE,
) -> DataFrame:
    """(key, source digest) of source rows whose key is in the target.

    A semi-join: each source row appears once, however many times its key is
    stored in the target (an inner join would emit every source x target pair
    of a key, which a key holding many rows turns into a blow-up).
    """
    keys = _keys(key)
    tk = _target_keys(tgt, src, keys, prune)
    return src.join(tk, _key_match(src, tk, keys), "left_semi").select(*[src[k] for k in keys], src[hash_col])


def delta_updates(
    src: DataFrame,
    tgt: DataFrame,
    key: str | Sequence[str],
    hash_col: str = "hash_id",
    prune: Pruning | None = AUTO_PRUNE,
) -> DataFrame:
    """Matched rows whose digest is not among the target's digests."""
    matched = delta_matched(src, tgt, key, hash_col, prune)
    th = _target_digests(tgt, src, hash_col, prune)
    return matched.join(th, matched[hash_col] == th["__t_hash"], "left_anti")


def classify_delta(
    src: DataFrame,
    tgt: DataFrame,
    key: str | Sequence[str],
    hash_col: str = "hash_id",
    action: str = "action",
    prune: Pruning | None = AUTO_PRUNE,
) -> DataFrame:
    """Every source row with ``action`` = insert | update | unchanged.

    insert: key not in the target; unchanged: key in the target and digest among
    the target's digests; update: otherwise.  Target-only rows are not reported.
    The target sides are reduced to distinct keys and distinct digests (combined
    map-side), so each source row meets at most one row in each left join.
    """
    keys = _keys(key)
    tk = _target_keys(tgt, src, keys, prune).withColumn("__has_key", F.lit(True))
    th = _target_digests(tgt, src, hash_col, prune).withColumn("__has_hash", F.lit(True))
    flagged = src.join(tk, _key_match(src, tk, keys), "left").join(
        th, src[hash_col] == th["__t_hash"], "left"
    )
    label = (
        F.when(F.col("__has_key").isNull(), F.lit(INSERT))
        .when(F.col("__has_hash").isNotNull(), F.lit(UNCHANGED))
        .otherwise(F.lit(UPDATE))
    )
    return flagged.select(*[src[c] for c in src.columns], label.alias(action))


def upsert_snapshot(
    src: DataFrame,
    tgt: DataFrame,
    key: str | Sequence[str],
    hash_col: str = "hash_id",
    prune: Pruning | None = AUTO_PRUNE,
) -> DataFrame:
    """The target after applying the source: inserted and updated source rows,
    plus every target row whose key the source did not change.

    Keys match null-safely, with one source row per key (``one_per_key``).  A
    source row is applied when no target row of its key has its digest; then all
    old rows of the key go.  Applying the same source again changes nothing.
    The first join is on key and digest, so a key holding many target rows is
    spread over the partitions; in the second the target is the side that
    adaptive execution may split.  Where the source's keys were measured to fit,
    the keys to remove are broadcast and the target isn't shuffled at all.

    Columns and order are the target's.  To store the result use
    ``sources.snapshots``; reading and overwriting one path in one job is not safe.
    """
    keys = _keys(key)
    new = one_per_key(src, keys, hash_col)
    stats = key_stats(src, keys) if worth_pruning(tgt, prune) else None
    met = narrow(tgt.select(*keys, hash_col), src, keys, prune, nulls=True, stats=stats)
    stored = met.select(*[F.col(k).alias(f"__t_{k}") for k in keys], F.col(hash_col).alias("__t_hash")).distinct()
    same = _same_key(new, stored, keys, "__t_") & new[hash_col].eqNullSafe(stored["__t_hash"])
    changes = new.join(stored, same, "left_anti")
    gone = changes.select(*[F.col(k).alias(f"__c_{k}") for k in keys])
    if stats is not None and stats.fits(prune):
        gone = F.broadcast(gone)
    kept = tgt.join(gone, _same_key(tgt, gone, keys, "__c_"), "left_anti")
    return kept.unionByName(changes.select(*tgt.columns))


def apply_inserts(
    src: DataFrame,
    tgt: DataFrame,
    key: str | Sequence[str],
    write: Callable[[DataFrame], None],
    hash_col: str = "hash_id",
    prune: Pruning | None = AUTO_PRUNE,
) -> DataFrame:
    """Append the insert set through ``write`` and return it.

    The set is written once to the session's checkpoint folder before the write:
    the target is read lazily, and without that cut an append would change what
    the insert set contains on any later evaluation.  Keys match null-safely and
    a key repeated in the source is inserted once (``one_per_key``), so applying
    the same source again appends nothing.
    """
    keys = _keys(key)
    new = one_per_key(src, keys, hash_col)
    met = narrow(tgt.select(*keys), src, keys, prune, nulls=True)
    tk = met.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct()
    inserts = materialize(new.join(tk, _same_key(new, tk, keys, "__t_"), "left_anti"), "delta_inserts")
    write(inserts)
    return inserts
