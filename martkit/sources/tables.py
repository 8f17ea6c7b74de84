"""Any Spark table format as a sink or source (a warehouse connector, Parquet, ...).

The format name is a parameter, so the same code writes to a warehouse
connector on a cluster that has one and to a file format in tests.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def table_id(dataset: str, table: str) -> str:
    return f"{dataset}.{table}"


def write_table(
    df: DataFrame,
    fmt: str,
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    path: str | None = None,
) -> None:
    writer = df.write.format(fmt).mode(mode)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if path is None:
        writer.save()
    else:
        writer.save(path)


def read_table(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    reader = spark.read.format(fmt)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load() if path is None else reader.load(path)
