"""JDBC source and sink.

Credentials are passed in by the caller (``properties``), never stored.  A JDBC
scan is a single task unless a numeric ``partition_column`` and its bounds are
given; a write opens one connection per partition, so ``num_partitions`` caps
the load put on the database.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
    batch_size: int | None = None,
    truncate: bool | None = None,
) -> dict[str, str]:
    """All options of one JDBC read or write as strings."""
    opts = {"url": url, "dbtable": table}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
        )
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    if batch_size:
        opts["batchsize"] = str(batch_size)
    if truncate is not None:
        opts["truncate"] = str(truncate).lower()
    return opts


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    **partitioning,
) -> DataFrame:
    """JDBC scan; a ``columns`` projection is pushed into the database query."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **partitioning)).load()
    return df.select(*columns) if columns else df


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    **tuning,
) -> None:
    """JDBC sink (``overwrite`` per mart, ``append`` for incremental inserts).

    Errors propagate: a failed load must fail the job.
    """
    df.write.format("jdbc").options(**jdbc_options(url, table, properties, **tuning)).mode(mode).save()
