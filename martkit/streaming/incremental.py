"""The extract step run incrementally.

A scheduled batch extract re-reads every CSV on each run.  Here the landing
folder is a streaming file source: each run (``availableNow``) ingests only the
files that arrived since the last run, and the checkpoint folder records which
files were committed, so a retried or restarted run neither skips nor
duplicates a file.  The schema is given up front (no inference pass).

A record that doesn't fit the schema fails the run, or, where a ``quarantine`` is
named, goes there as text (``sources.records``); it is never loaded with NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martkit.functions.keys import row_hash
from martkit.operators.delta import apply_inserts
from martkit.session import materialize
from martkit.sources.records import RECORD, bad, checked, good


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise  # a table that is there but cannot be read is no empty table
        return None


def _rows(spark: SparkSession, path: str) -> int:
    held = _stored(spark, path)
    return 0 if held is None else held.count()


def extract_incremental(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    header: bool = True,
    partition_by: Sequence[str] | None = None,
    max_files_per_trigger: int | None = None,
    recursive: bool = True,
    quarantine: str | None = None,
) -> int:
    """Append all not-yet-ingested CSV files under ``landing`` to Parquet ``target``.

    Returns, when the files present at the start have been committed, the number
    of bad records of this run.  ``max_files_per_trigger`` bounds the size of each
    micro-batch; ``recursive`` picks up files in sub-folders (one per landing,
    say).  Bad records are a stream of their own, with its own checkpoint beside
    the first, so each file's are written exactly once too.
    """
    options = {"recursiveFileLookup": "true"} if recursive else {}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)

    def run(frame: DataFrame, path: str, ckpt: str, layout: Sequence[str] | None = None) -> None:
        writer = frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt)
        writer = writer.outputMode("append").trigger(availableNow=True)
        (writer.partitionBy(*layout) if layout else writer).start().awaitTermination()

    if quarantine is None:
        reader = spark.readStream.schema(schema).option("header", header).option("mode", "FAILFAST")
        run(reader.options(**options).csv(landing), target, checkpoint, partition_by)
        return 0
    before = _rows(spark, quarantine)
    records = checked(spark.readStream, landing, schema, header, **options)
    run(bad(records), quarantine, f"{checkpoint.rstrip('/')}_rejected")
    run(good(records), target, checkpoint, partition_by)
    return _rows(spark, quarantine) - before


def load_incremental(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    key: str | Sequence[str],
    source_format: str = "csv",
    hash_name: str = "hash_id",
    options: dict[str, str] | None = None,
    quarantine: str | None = None,
) -> int:
    """The incremental warehouse load as a stream: every newly landed source
    file is hashed and its rows whose key is not yet in ``target`` are appended.

    Each micro-batch runs ``apply_inserts`` against the target as it is then,
    so a batch replayed after a failure inserts nothing twice, and the stream's
    checkpoint makes sure each landed file is processed.  Returns, when the files
    present at the start have been loaded, the number of bad records (CSV with a
    ``quarantine``: each batch's are a folder of their own, so a replayed batch
    writes the same folder again).
    """
    apart = quarantine is not None and source_format == "csv"
    rejected = 0

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal rejected
        if apart:
            held = materialize(batch, "records")  # parsed once
            wrong = held.where(F.col(RECORD).isNotNull())
            found = wrong.count()
            if found:
                wrong.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch_id}")
            rejected += found
            batch = good(held)
        hashed = row_hash(batch, list(schema.fieldNames()), name=hash_name)
        current = _stored(spark, target)
        current = spark.createDataFrame([], hashed.schema) if current is None else current
        apply_inserts(hashed, current, key, lambda df: df.write.mode("append").parquet(target), hash_name)

    extra = {"recursiveFileLookup": "true", **(options or {})}
    if apart:
        source = checked(spark.readStream, landing, schema, **extra)
    else:
        reader = spark.readStream.schema(schema)
        if source_format == "csv":
            reader = reader.option("header", "true").option("mode", "FAILFAST")
        source = reader.options(**extra).format(source_format).load(landing)
    writer = source.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return rejected
