"""CSV intake with bad records kept apart.

A record is bad if a value does not fit its declared type or if it has too few or
too many fields.  It is never loaded with NULL in the place of what didn't fit:
it goes to a quarantine table as the text it was, with its file and what could be
read of it, and its number is reported.  Every field of a record is parsed
whatever the query selects, so a record is good or bad for all queries alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from martkit.functions.keys import column

RECORD, FILE = "_record", "_file"


def as_struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def checked_options(schema: StructType, header: bool) -> dict[str, str]:
    """Reader options under which a bad record shows in the column ``_record``."""
    taken = {f.name.lower() for f in schema.fields} & {RECORD, FILE}
    if taken:
        raise ValueError(f"columns reserved for bad records: {sorted(taken)}")
    return {
        "header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD,
        "enforceSchema": "false" if header else "true",
    }


def checked(reader, path, schema: StructType, header: bool = True, **options: str) -> DataFrame:
    """Parsed records, good and bad, with ``_record`` (NULL for good ones) and
    ``_file``; ``reader`` is ``spark.read`` or ``spark.readStream``."""
    read = reader.schema(StructType([*schema.fields]).add(RECORD, StringType()))
    for key, value in {**checked_options(schema, header), **options}.items():
        read = read.option(key, value)
    return read.csv(path).withColumn(FILE, F.col("_metadata.file_path"))


def _whole(records: DataFrame, chosen: Column) -> DataFrame:
    """The chosen records.  The parser converts only the fields that a query
    reads, so the condition reads them all: whether a record is bad must not
    depend on the columns selected later.  (The hash is never below its least
    value, which the optimizer doesn't know.)"""
    fields = [column(c) for c in records.columns if c not in (RECORD, FILE)]
    return records.where(chosen & (F.xxhash64(*fields) >= F.lit(-(1 << 63)).cast("bigint")))


def good(records: DataFrame) -> DataFrame:
    return _whole(records, F.col(RECORD).isNull()).drop(RECORD, FILE)


def bad(records: DataFrame) -> DataFrame:
    return _whole(records, F.col(RECORD).isNotNull())


def split_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str, header: bool = True, **options: str
) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad records) of a CSV source."""
    records = checked(spark.read, path, as_struct(schema), header, **options)
    return good(records), bad(records)


@dataclass(frozen=True)
class Intake:
    rows: int
    rejected: int


def ingest_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    target: str,
    quarantine: str,
    header: bool = True,
    partition_by: Sequence[str] = (),
    **options: str,
) -> Intake:
    """S1 to S3 with a quarantine: good rows overwrite ``target``, bad records are
    appended to ``quarantine``.  The write counts both as it parses; the source is
    read again only if there are bad records to fetch."""
    records = checked(spark.read, path, as_struct(schema), header, **options)
    seen = Observation()
    counted = records.observe(seen, F.count_if(F.col(RECORD).isNull()).alias("rows"), F.count_if(F.col(RECORD).isNotNull()).alias("rejected"))
    writer = good(counted).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    found = Intake(int(seen.get["rows"]), int(seen.get["rejected"]))
    if found.rejected:
        bad(records).select(*[column(c) for c in records.columns]).write.mode("append").parquet(quarantine)
    return found
