"""Target schema contracts and ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martkit.functions.keys import column
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# The four mart tables of the target warehouse, names and types
# as declared there (STRING -> string, FLOAT64 -> double, INT64 -> bigint).
MART_SCHEMAS: dict[str, StructType] = {
    "avg_flight": _schema(("AIRLINE_Name", StringType()), ("avg_DISTANCE", DoubleType())),
    "flights_cancellation": _schema(
        ("AIRLINE", StringType()),
        ("DESTINATION_AIRPORT", StringType()),
        ("count_airlines_cancel", LongType()),
    ),
    "airline_in_airport": _schema(
        ("DESTINATION_AIRPORT", StringType()),
        ("AIRLINE", StringType()),
        ("Count_visit_per_airline", LongType()),
        ("ranking", LongType()),
    ),
    "airport_notin_thelist": _schema(
        ("DESTINATION_AIRPORT", StringType()),
        ("Count_airports", LongType()),
    ),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: declared order, declared types.

    A missing column is an error; extra columns are dropped.  The casts are
    plain projections, so they stay inside whole-stage codegen.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the contract: {missing}")
    return df.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
