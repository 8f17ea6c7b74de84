"""Session construction and the shared scratch location.

Scratch data (lineage cuts, round-trip checks, staged tables) always goes to the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting is
absent *and* Spark runs in local mode do we make a temporary folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins and partition counts from
# real shuffle sizes; skew-join splitting covers hot keys the code cannot see.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # coalesce to the advisory size rather than to the core count: on a large
    # cluster this avoids thousands of tiny reduce tasks after a filter
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "martkit",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the defaults above.

    ``shuffle_partitions`` should be sized to the data (``shuffle_partitions_for``:
    about one partition per 128 MB of shuffle input); AQE coalesces the small
    ones afterwards.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


ADVISORY_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, min_partitions: int = 8) -> int:
    """Initial shuffle partition count for an expected shuffle volume: one
    partition per 128 MB, so no reduce task has to spill a multi-GB partition.
    AQE merges the partitions of smaller shuffles back to the same size.

    For example, 100 TB of fact rows pre-aggregated to ~2 TB of shuffle data
    gives about 16,000 partitions.
    """
    return max(min_partitions, -(-int(shuffle_bytes) // ADVISORY_PARTITION_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, reading it from the session.

    A folder of our own is made only when nothing is configured and the master
    is local (tests); on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="martkit-checkpoint-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/martkit-{uuid.uuid4().hex}/{name}"


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads files instead of recomputing
    the plan) and, unlike an un-persisted ``checkpoint()``, computes ``df`` once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
