"""Helpers shared by the text operators.

Texts travel as UTF-8 bytes inside Arrow batches.  The word classes used here
only name ASCII separators, so splitting and lower-casing A-Z on bytes gives the
same words as on code points, and much faster.
"""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.session import scratch_path

# bytes.split() with no argument cuts at exactly space and \x09-\x0D.
ALNUM_SEPARATORS = bytes(
    b if (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) else (b + 32 if 65 <= b <= 90 else 32)
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_values(column: pa.Array) -> list[bytes]:
    """Texts as bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    return [b"" if v is None else v for v in column.to_pylist()]


def alnum_words(raw: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return raw.translate(ALNUM_SEPARATORS).split()


def space_words(raw: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    return raw.lower().split()


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(id_column, modulus: int, remainder: int):
    """Whether crc32(id as text) mod ``modulus`` is ``remainder`` (null id: false)."""
    return F.coalesce(F.crc32(id_column.cast("string")) % modulus == remainder, F.lit(False))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back; the
    shuffle files of what came before can then be cleaned."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    return df.sparkSession.read.parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``stage``, after which the driver drops what it no longer refers to, so that
    the shuffle files of finished rounds go before the next round writes its own."""
    out = stage(df, name)
    jvm = getattr(df.sparkSession, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()
    return out
