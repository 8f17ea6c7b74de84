"""Dates built from year, month and day parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text layout the parts are joined into.
DATE_PATTERN = "yyyyMMdd"


def pad_part(col: str | Column) -> Column:
    """C4-C6 (`pad_key`): text of a month or day, left-padded with '0' when it
    has one character.

    The length guard matters: ``lpad`` alone would cut a longer value (123 -> 12).
    Each part is cast to text first, so the result stays a string under ANSI mode.
    """
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.when(F.length(text) == 1, F.lpad(text, 2, "0")).otherwise(text)


def date_text(year: str | Column, month: str | Column, day: str | Column) -> Column:
    y = (F.col(year) if isinstance(year, str) else year).cast("string")
    return F.concat(y, pad_part(month), pad_part(day))


def compose_date(df: DataFrame, year: str, month: str, day: str, name: str = "DATE") -> DataFrame:
    """D1 (C3, C7): append ``name`` as a DATE made from the three parts.

    A NULL part, an impossible date (Feb 30) or a malformed part gives NULL, in
    and out of ANSI mode.
    """
    return df.withColumn(name, F.try_to_date(date_text(year, month, day), DATE_PATTERN))
