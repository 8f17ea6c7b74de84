"""File sources and sinks (CSV in, Parquet between stages)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from martkit.functions.keys import column
from martkit.sources.smallfiles import Folder


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    **options: str,
) -> DataFrame:
    """CSV scan with a header row.

    Without ``schema`` the types are inferred, which costs one extra pass over
    the input; on large inputs pass ``schema`` so the scan is
    read once; a value that does not fit its declared type then raises.
    (``csv_to_parquet`` infers the same types, as a rule in the pass that copies.)
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        reader = reader.option("inferSchema", True)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet scan; column pruning and filter pushdown come from Catalyst."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """S3: Parquet sink.  ``partition_by`` lays out folders for partition pruning."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


# Texts that alone are inferred as the type.  A column that holds one of them and
# whose values all parse as the type is inferred as that type.
SURE = (
    ("double", r"^-?[0-9]{1,15}\.[0-9]{1,15}\z"),
    ("bigint", r"^-?[1-9][0-9]{10,17}\z"),
    ("int", r"^-?[0-9]{1,9}\z"),
)
# widest first
TYPES = {"string": StringType(), "double": DoubleType(), "bigint": LongType(), "int": IntegerType()}
HEAD = 100


def _sure(name: str) -> Column:
    """The type of ``TYPES`` that the text of a column settles, or NULL."""
    text = column(name)
    word = text.rlike("^[A-Za-z]")
    for other in ("double", "boolean", "date", "timestamp"):
        word = word & text.try_cast(other).isNull()
    kind = F.when(word, F.lit("string"))
    for name, pattern in SURE:
        kind = kind.when(text.rlike(pattern), F.lit(name))
    return kind


def _settled(spark: SparkSession, path: str | Sequence[str], header: bool) -> StructType | None:
    """The types that the first ``HEAD`` rows settle, if the other rows fit them; None
    where they leave a column open, or folder names add columns."""
    raw = spark.read.option("header", header).csv(path)
    reserved = spark.conf.get("spark.sql.columnNameOfCorruptRecord").lower()
    if reserved in {c.lower() for c in raw.columns} or any("=" in f for f in raw.inputFiles()):
        return None
    rows = raw.select(*[_sure(c).alias(f"k{i}") for i, c in enumerate(raw.columns)]).take(HEAD)
    found = [{r[i] for r in rows} for i in range(len(raw.columns))]
    kinds = [next((k for k in TYPES if k in held), None) for held in found]
    if not kinds or None in kinds:
        return None
    return StructType([StructField(name, TYPES[kind]) for name, kind in zip(raw.columns, kinds, strict=True)])


def csv_to_parquet(
    spark: SparkSession, path: str | Sequence[str], target: str, schema: StructType | str | None = None, header: bool = True
) -> None:
    """``read_csv`` written by ``write_parquet``.

    Without ``schema`` the types are those inferred from all rows, as a rule without
    a pass of their own: the first rows settle what the types are if every other row
    fits them, and the copy stops at a record that doesn't.  Only if it stops, or the
    first rows leave a type open, the types are inferred before the copy."""
    settled = _settled(spark, path, header) if schema is None else None
    if settled is not None:
        try:
            write_parquet(read_csv(spark, path, settled, header), target)
            return
        except (PySparkException, Py4JJavaError):
            pass  # an error of another cause comes again below
    write_parquet(read_csv(spark, path, schema, header), target)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    df.write.mode(mode).option("header", header).csv(path)


#: what a copy last took from its source; readers pass over names with an underscore
COPIED = "_copied.json"


def folder_digests(spark: SparkSession, path: str) -> dict[str, str]:
    """A digest of the files (name, size, time) of each folder of a dataset that
    holds any; "" is the dataset's own folder."""
    held: dict[str, list] = {}
    for name, size, changed in Folder(spark, path).files():
        folder, _, file = name.rpartition("/")
        held.setdefault(folder, []).append((file, size, changed))
    return {f: hashlib.sha256(json.dumps(files).encode("utf-8")).hexdigest() for f, files in held.items()}


def partition_columns(folders: Iterable[str]) -> list[str]:
    """The columns that folder names such as ``a=1/b=2`` lay a dataset out by."""
    layouts = {tuple(part.partition("=")[0] if "=" in part else "" for part in f.split("/") if part) for f in folders}
    if not layouts or layouts == {()}:
        return []
    if len(layouts) > 1 or "" in next(iter(layouts)):
        raise ValueError(f"folders are laid out in different ways: {sorted(layouts)}")
    return list(next(iter(layouts)))


def _copy_one(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy what changed since the last copy; the folders copied."""
    now, book = folder_digests(spark, source), Folder(spark, target)
    before = json.loads(book.read(COPIED) or "{}")
    layout = partition_columns(now)
    known = bool(before) and partition_columns(before) == layout
    changed = [f for f in now if not known or before.get(f) != now[f]]
    gone = [f for f in before if f not in now] if known else []
    if not changed and not gone and known:
        return []
    frame = spark.read.option("basePath", source) if layout else spark.read
    if layout:  # folder values as text, so that 01 stays 01
        own = spark.read.parquet(f"{source}/{changed[0]}" if changed else source)
        fields = [f for f in own.schema.fields if f.name not in layout]
        frame = frame.schema(StructType([*fields, *[StructField(c, StringType()) for c in layout]]))
    if not known or not layout:
        data = frame.parquet(source)
        (data.write.partitionBy(*layout) if layout else data.write).mode("overwrite").parquet(target)
    else:
        if changed:
            data = frame.parquet(*[f"{source}/{f}" for f in changed])
            writer = data.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*layout).parquet(target)
        for folder in gone:
            book.delete(folder)
    # the note goes last: a copy that was stopped is taken up from the older one
    book.delete(COPIED)
    book.create(COPIED, json.dumps(now))
    return changed


def copy_datasets(
    spark: SparkSession,
    names: Iterable[str],
    src_root: str,
    dst_root: str,
    mode: str = "overwrite",
) -> list[str]:
    """Copy Parquet datasets ``src_root/<name>`` to ``dst_root/<name>``.

    Each copy is a distributed read and write; nothing passes the driver.  The
    roots may be any Hadoop file-system URI (``s3a://``, ``gs://``, ``hdfs://``,
    ``file:``) for which the cluster has a connector.

    A dataset laid out in folders keeps them, values as they are written, and a
    note beside the copy tells what was taken: a second copy rewrites only the
    folders whose files changed, drops those that went, and leaves a dataset
    without changes alone.  (Modes other than ``overwrite`` copy all rows.)
    """
    src, dst = src_root.rstrip("/"), dst_root.rstrip("/")
    names = list(names)

    def copy(name: str) -> None:
        if mode == "overwrite":
            _copy_one(spark, f"{src}/{name}", f"{dst}/{name}")
            return
        spark.read.parquet(f"{src}/{name}").write.mode(mode).parquet(f"{dst}/{name}")

    # independent copies run as concurrent jobs; the first failure is raised
    with ThreadPoolExecutor(max_workers=max(1, min(len(names), 8))) as pool:
        futures = [pool.submit(copy, n) for n in names]
    for f in futures:
        f.result()
    return [f"{dst}/{n}" for n in names]
