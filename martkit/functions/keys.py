"""Row digests for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The separator placed between column texts and the digest width.
HASH_SEPARATOR = "||"
HASH_BITS = 256


def column(name: str) -> Column:
    """A top-level column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    col = column(name)
    if isinstance(dtype, StringType):
        return col
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StringType):
        return col
    return col.cast("string")


def row_hash_column(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    null_token: str | None = None,
    separator: str = HASH_SEPARATOR,
) -> Column:
    """H1 (C1, C2, P7): SHA-256 (lower-case hex) of the columns' texts joined by
    ``separator``.

    By default NULLs are skipped, as ``concat_ws`` does, so ``(a, NULL, b)`` and
    ``(a, b, NULL)`` share a digest.  A ``null_token`` stands in for NULL and
    removes that collision.
    """
    names = list(columns) if columns is not None else list(df.columns)
    parts = [_as_text(df, c) for c in names]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws(separator, *parts), HASH_BITS)


def row_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    name: str = "hash_id",
    null_token: str | None = None,
) -> DataFrame:
    """Append the row digest of ``columns`` (all columns, in order, by default)."""
    return df.withColumn(name, row_hash_column(df, columns, null_token))
