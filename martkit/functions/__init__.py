"""Column builders: JVM-side expressions only, no Python UDF."""

from martkit.functions.dates import compose_date, date_text, pad_part
from martkit.functions.keys import row_hash, row_hash_column

__all__ = ["compose_date", "date_text", "pad_part", "row_hash", "row_hash_column"]
