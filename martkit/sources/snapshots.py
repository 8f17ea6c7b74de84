"""Versioned Parquet tables: data files are only ever added, and a small manifest
names those of each version.

A write goes to a folder of its own; it becomes the current version when its
manifest is created, one small file under a number that only one writer can take.
A writer that is killed before that leaves readers on the version they had, and a
reader keeps the files of the version it opened.  ``vacuum`` removes what no kept
version names.

A table may be cut into buckets by its keys' hash.  ``upsert_into`` then reads
only the buckets that the delivery falls in, writes only those that it changes,
and its manifest names the old files of all others.

    table/
      versions/0000000003.json        parts: bucket -> folder, schema, keys
      data/<id>/__bucket=7/part-...
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martkit.functions.keys import column
from martkit.operators.delta import INSERT, UPDATE, one_per_key
from martkit.operators.pruning import AUTO_PRUNE, Pruning, narrow
from martkit.session import materialize
from martkit.sources.smallfiles import Folder

BUCKET = "__bucket"
WHOLE = ""  # the part of a table without buckets


class VersionConflict(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: StructType
    parts: dict[str, str]
    keys: tuple[str, ...] = ()
    buckets: int = 0

    def text(self) -> str:
        held = {"version": self.version, "schema": self.schema.jsonValue(), "keys": list(self.keys), "buckets": self.buckets}
        return json.dumps({**held, "parts": self.parts, "complete": True})


def _name(version: int) -> str:
    return f"{version:010d}.json"


def _parse(text: str | None) -> Manifest | None:
    """None for a manifest that was not written to its end."""
    try:
        held = json.loads(text or "")
        if not held["complete"]:
            return None
    except (ValueError, KeyError):
        return None
    return Manifest(held["version"], StructType.fromJson(held["schema"]), held["parts"], tuple(held["keys"]), held["buckets"])


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all committed versions, ascending."""
    folder = Folder(spark, f"{path.rstrip('/')}/versions")
    return [m.version for n in folder.names() if n.endswith(".json") and (m := _parse(folder.read(n)))]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version (the newest by default); None for a new table."""
    folder = Folder(spark, f"{path.rstrip('/')}/versions")
    if version is not None:
        return _parse(folder.read(_name(version)))
    for name in reversed([n for n in folder.names() if n.endswith(".json")]):
        found = _parse(folder.read(name))
        if found:
            return found
    return None


def _read_parts(spark: SparkSession, path: str, held: Manifest, parts: Iterable[str] | None = None) -> DataFrame:
    chosen = [held.parts[p] for p in (held.parts if parts is None else parts) if p in held.parts]
    if not chosen:
        return spark.createDataFrame([], held.schema)
    frame = spark.read.schema(held.schema).parquet(*[f"{path.rstrip('/')}/{p}" for p in sorted(chosen)])
    return frame.select(*[column(f.name) for f in held.schema.fields])


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the newest by default."""
    held = manifest(spark, path, version)
    if held is None:
        raise FileNotFoundError(f"no version {'' if version is None else version} of a snapshot table at {path}")
    return _read_parts(spark, path, held)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(buckets)).cast("int")


def _write_data(df: DataFrame, path: str, keys: Sequence[str], buckets: int, partition_by: Sequence[str]) -> dict[str, str]:
    """Write to a new folder; its parts by bucket."""
    spark, name = df.sparkSession, f"data/{uuid.uuid4().hex}"
    target = f"{path.rstrip('/')}/{name}"
    if not buckets:
        df.write.partitionBy(*partition_by).parquet(target) if partition_by else df.write.parquet(target)
        return {WHOLE: name}
    # a bucket's rows go to one task, and to several where they are many
    dealt = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
    dealt.write.partitionBy(BUCKET).parquet(target)
    found = [n for n in Folder(spark, target).names() if n.startswith(f"{BUCKET}=")]
    return {n.split("=")[1]: f"{name}/{n}" for n in found}


def commit(spark: SparkSession, path: str, held: Manifest) -> Manifest:
    """Make a manifest the newest version, if its number is still free."""
    folder = Folder(spark, f"{path.rstrip('/')}/versions")
    if not folder.create(_name(held.version), held.text()):
        raise VersionConflict(f"version {held.version} of {path} is taken")
    return held


def _next(spark: SparkSession, path: str) -> int:
    """A number above all that were taken, whether or not they were completed."""
    taken = [int(n[:-5]) for n in Folder(spark, f"{path.rstrip('/')}/versions").names() if n.endswith(".json")]
    return max(taken, default=0) + 1


def write_snapshot(
    df: DataFrame,
    path: str,
    keys: str | Sequence[str] = (),
    buckets: int = 0,
    partition_by: Sequence[str] = (),
) -> Manifest:
    """Write ``df`` as the next version of the table.

    ``keys`` and ``buckets`` cut it for ``upsert_into``; ``partition_by`` lays out
    folders for partition pruning instead."""
    spark = df.sparkSession
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    if bool(keys) != bool(buckets) or (buckets and partition_by):
        raise ValueError("keys and buckets go together, and not with partition_by")
    version = _next(spark, path)
    parts = _write_data(df, path, keys, buckets, partition_by)
    return commit(spark, path, Manifest(version, df.schema, parts, keys, buckets))


@dataclass(frozen=True)
class Upsert:
    """What a delivery did.  ``changes``: the rows written, with ``action`` insert
    or update; ``buckets``: those written anew."""

    version: int
    inserted: int
    updated: int
    buckets: tuple[str, ...]
    changes: DataFrame


def upsert_into(
    src: DataFrame, path: str, hash_col: str = "hash_id", action: str = "action", prune: Pruning | None = AUTO_PRUNE
) -> Upsert:
    """D5 on a bucketed snapshot table: insert new keys, replace changed ones.

    Keys match null-safely, one source row a key (``one_per_key``); a row is
    applied when no stored row of its key has its digest, and then replaces all
    of them.  Only the buckets of the delivery's keys are read, only those with a
    change are written, and without a change there is no new version, so a
    delivery may be replayed.  The driver holds bucket numbers and two counts."""
    spark = src.sparkSession
    held = manifest(spark, path)
    if held is None or not held.buckets:
        raise ValueError(f"{path} has no bucketed version to apply a delivery to")
    version = _next(spark, path)
    keys, names = list(held.keys), [f.name for f in held.schema.fields]
    new = materialize(one_per_key(src, keys, hash_col).withColumn(BUCKET, bucket_of(keys, held.buckets)), "delivery")
    touched = [str(r[0]) for r in new.select(BUCKET).distinct().collect()]
    stored = narrow(_read_parts(spark, path, held, touched).select(*keys, hash_col), new, keys, prune, nulls=True)
    stored = stored.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)], F.col(hash_col).alias("__t_hash"))
    by_key = stored.groupBy(*[f"__t{i}" for i in range(len(keys))]).agg(F.collect_set("__t_hash").alias("__had"), F.max(F.col("__t_hash").isNull()).alias("__null"))
    match = reduce(lambda a, b: a & b, [new[k].eqNullSafe(by_key[f"__t{i}"]) for i, k in enumerate(keys)])
    digest = new[hash_col]
    same = F.when(digest.isNull(), F.col("__null")).otherwise(F.array_contains("__had", digest))
    found = new.join(by_key, match, "left").where(F.col("__had").isNull() | ~same)
    changes = materialize(found.select(*names, BUCKET, F.when(F.col("__had").isNull(), INSERT).otherwise(UPDATE).alias(action)), "changes")
    counts = {(str(r[BUCKET]), r[action]): r["n"] for r in changes.groupBy(BUCKET, action).agg(F.count("*").alias("n")).collect()}
    total = lambda kind: sum(n for (_, a), n in counts.items() if a == kind)
    buckets = tuple(sorted({b for b, _ in counts}, key=int))
    if not buckets:
        return Upsert(held.version, 0, 0, (), changes.drop(BUCKET))
    old = _read_parts(spark, path, held, buckets)
    gone = changes.where(F.col(action) == UPDATE).select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)])
    cond = reduce(lambda a, b: a & b, [old[k].eqNullSafe(gone[f"__g{i}"]) for i, k in enumerate(keys)])
    kept = old.join(gone, cond, "left_anti").unionByName(changes.select(*names))
    written = _write_data(kept, path, keys, held.buckets, ())
    after = Manifest(version, held.schema, {**held.parts, **written}, held.keys, held.buckets)
    commit(spark, path, after)
    return Upsert(version, total(INSERT), total(UPDATE), buckets, changes.drop(BUCKET))


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than_s: float = 86_400) -> list[str]:
    """Drop all but the newest ``keep`` versions, and the data folders that none of
    those names and that are older than ``older_than_s``, so that a write that is
    still going on keeps its folder.  Returns the folders removed."""
    root = Folder(spark, path)
    known = versions(spark, path)
    held = [manifest(spark, path, v) for v in known[-max(1, keep) :]]
    named = {p.split("/")[1] for m in held for p in m.parts.values()}
    for version in known[: -max(1, keep)]:
        root.delete(f"versions/{_name(version)}")
    limit = time.time() - older_than_s
    gone = [n for n in root.names("data") if n not in named and root.modified(f"data/{n}") <= limit]
    for name in gone:
        root.delete(f"data/{name}")
    return gone
