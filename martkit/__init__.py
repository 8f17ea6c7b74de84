"""martkit: star-schema mart building and incremental loading on Spark.

Every operator takes and returns DataFrames; planning and execution stay in
Spark SQL (Catalyst, AQE, whole-stage codegen).  Sub-packages:

- ``sources``   readers and writers (CSV, Parquet, JDBC, any ``format``), schema contracts
- ``functions`` column builders (row hash, date composition)
- ``operators`` mart aggregates, distributed ranking, quality reports, delta load
- ``plans``     whole jobs (extract, transform, load, full run) and check queries
- ``streaming`` incremental extract and insert load with Structured Streaming
"""

from martkit.session import build_session, materialize, scratch_path, shuffle_partitions_for

__all__ = ["build_session", "materialize", "scratch_path", "shuffle_partitions_for"]
