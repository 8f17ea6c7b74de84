"""The batch jobs: extract (CSV -> Parquet), transform (Parquet -> four marts),
load (marts -> a sink), and a full run of the three.

Errors propagate: a failed read, mart or write fails the run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martkit.operators.fingerprint import compare_tables, prints, table_digest
from martkit.operators.marts import dim_average, flagged_counts, orphan_counts, visit_counts
from martkit.operators.ranking import rank_within
from martkit.operators.rollup import Rollup, rollup
from martkit.operators.sizing import BroadcastPolicy, decide_many
from martkit.plans.ledger import Ledger
from martkit.session import materialize
from martkit.sources.contracts import MART_SCHEMAS, conform
from martkit.sources.files import csv_to_parquet, write_parquet
from martkit.sources.jdbc import read_jdbc, write_jdbc
from martkit.sources.records import Intake, ingest_csv
from martkit.sources.snapshots import read_snapshot, write_snapshot
from martkit.sources.tables import read_table, table_id, write_table

Sink = Callable[[DataFrame, str], None]


# The defaults below are the flight data's own column names and
# its cancelled-flag value.
@dataclass(frozen=True)
class Roles:
    """Which columns play which part."""

    carrier: str = "AIRLINE"
    origin: str = "ORIGIN_AIRPORT"
    dest: str = "DESTINATION_AIRPORT"
    measure: str = "DISTANCE"
    flag: str = "CANCELLED"
    flag_value: object = "1"
    carrier_key: str = "IATA_CODE"
    carrier_label: str = "AIRLINE"
    place_key: str = "IATA_CODE"


# Dataset names of the three inputs and of the staged marts (the
# cancellation mart is staged under another name than its table).
INPUTS = ("df_flights", "df_airline", "df_airports")
STAGED_AS = {
    "avg_flight": "avg_flight",
    "airline_in_airport": "airline_in_airport",
    "flights_cancellation": "flights_per_cancell",
    "airport_notin_thelist": "airport_notin_thelist",
}


def extract(
    spark: SparkSession,
    sources: Mapping[str, str],
    targets: Mapping[str, str],
    schemas: Mapping[str, StructType | str] | None = None,
    parallel: bool = True,
    quarantine: str | None = None,
    report: dict[str, Intake] | None = None,
) -> dict[str, str]:
    """Each CSV ``sources[name]`` to Parquet at ``targets[name]``, the
    datasets as concurrent jobs.  With a ``quarantine`` folder, bad records of a
    dataset with a schema go to its sub-folder of that name instead of failing the
    run, and ``report`` gets the counts."""
    schemas = schemas or {}

    def one(name: str) -> None:
        if quarantine and schemas.get(name) is not None:
            found = ingest_csv(spark, sources[name], schemas[name], targets[name], f"{quarantine.rstrip('/')}/{name}")
            if report is not None:
                report[name] = found
            return
        csv_to_parquet(spark, sources[name], targets[name], schema=schemas.get(name))

    run_all({name: partial(one, name) for name in sources}, parallel)
    return {name: targets[name] for name in sources}


#: one method at every size; no window holds a whole destination
VISITS_RANK_METHOD = "histogram"


def build_marts(
    fact: DataFrame,
    carriers: DataFrame,
    places: DataFrame,
    roles: Roles = Roles(),
    *,
    avg_scale: int | None = None,
    cancel_limit: int | None = None,
    shared: bool = True,
    broadcast: BroadcastPolicy | bool | None = None,
    rank_method: str = VISITS_RANK_METHOD,
) -> dict[str, DataFrame]:
    """The four marts, conformed to their contracts.

    ``avg_scale=2`` and ``cancel_limit=100`` give the rounded / top-100 variant.
    With ``shared`` the fact is scanned once: it is rolled up to
    (carrier, origin, dest, flag) with row counts and measure sums, written to
    the checkpoint folder, and all four marts are finished from those rows.
    The visits are ranked by the ``histogram`` method at every size, from the
    rollup (or, unshared, from visits written once): the ranked value is a row
    count, so one destination has at most sqrt(2 * its rows) distinct values and
    no window holds more than that.
    """
    r = roles
    source: DataFrame | Rollup = fact
    if shared:
        summary = rollup(fact, [r.carrier, r.origin, r.dest, r.flag], [r.measure])
        source = Rollup(materialize(summary.df, "fact_rollup"), summary.keys, summary.measures)
    # measured once, used by the visit counts (the other marts join on the
    # rollup's own partitioning key and need no hint)
    carriers_bc, places_bc = decide_many(
        [(carriers.select(r.carrier_key, r.carrier_label), broadcast), (places.select(r.place_key), broadcast)]
    )

    avg = dim_average(
        source, carriers, r.carrier, r.carrier_key, r.carrier_label, r.measure,
        scale=avg_scale, label_name="AIRLINE_Name", value_name="avg_DISTANCE",
    )
    visits = visit_counts(
        source, places, carriers,
        origin=r.origin, dest=r.dest, carrier=r.carrier, place_key=r.place_key,
        carrier_key=r.carrier_key, carrier_label=r.carrier_label,
        dest_name="DESTINATION_AIRPORT", label_name="AIRLINE",
        order=False, broadcast=carriers_bc, broadcast_places=places_bc,
    )
    visits = conform(visits, StructType(MART_SCHEMAS["airline_in_airport"].fields[:3]))
    if not shared:  # the ranks and the rows they join to read the same visits, or the written rollup
        visits = materialize(visits, "visits")
    ranked = rank_within(visits, "DESTINATION_AIRPORT", "Count_visit_per_airline", method=rank_method).orderBy(
        "DESTINATION_AIRPORT", "ranking", "AIRLINE"
    )
    cancels = flagged_counts(source, r.flag, r.flag_value, [r.carrier, r.dest], limit=cancel_limit).select(
        F.col(r.carrier).alias("AIRLINE"), F.col(r.dest).alias("DESTINATION_AIRPORT"), "count_airlines_cancel"
    )
    orphans = orphan_counts(source, places, r.dest, r.place_key).select(
        F.col(r.dest).alias("DESTINATION_AIRPORT"), "Count_airports"
    )
    return {
        "avg_flight": conform(avg, MART_SCHEMAS["avg_flight"]),
        "airline_in_airport": conform(ranked, MART_SCHEMAS["airline_in_airport"]),
        "flights_cancellation": conform(cancels, MART_SCHEMAS["flights_cancellation"]),
        "airport_notin_thelist": conform(orphans, MART_SCHEMAS["airport_notin_thelist"]),
    }


def run_all(actions: Mapping[str, Callable[[], None]], parallel: bool = True) -> None:
    """Run independent Spark actions, concurrently when ``parallel``.

    Each action is its own job; submitted from separate threads they share the
    executors instead of queueing one after another (small jobs leave most
    cores idle).  The first failure is raised after all actions have ended.
    """
    if not parallel or len(actions) < 2:
        for action in actions.values():
            action()
        return
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(action) for action in actions.values()]
    for future in futures:
        future.result()


def transform(
    spark: SparkSession,
    inputs: Mapping[str, str],
    staging_root: str,
    roles: Roles = Roles(),
    parallel: bool = True,
    partition_by: Mapping[str, list[str]] | None = None,
    **options,
) -> dict[str, str]:
    """E2 as a job: read the three staged inputs, write the four marts as Parquet.

    ``partition_by`` maps a mart to the columns its folders are laid out by, so
    readers filtering on them prune whole folders.
    """
    fact, carriers, places = (spark.read.parquet(inputs[n]) for n in INPUTS)
    marts = build_marts(fact, carriers, places, roles, **options)
    root = staging_root.rstrip("/")
    written = {name: f"{root}/{STAGED_AS[name]}" for name in marts}
    layout = partition_by or {}
    run_all(
        {name: partial(write_parquet, df, written[name], partition_by=layout.get(name)) for name, df in marts.items()},
        parallel,
    )
    return written


class LoadMismatch(RuntimeError):
    """What a sink holds after a load is not what was staged."""


def load(
    spark: SparkSession,
    staged: Mapping[str, str],
    sink: Sink,
    parallel: bool = True,
    verify: bool = False,
    ledger: Ledger | str | None = None,
) -> list[str]:
    """Write each staged mart to ``sink`` under its table name; returns the
    names of those written.

    With ``verify`` each table is read back through the sink and compared with
    its mart (``compare_tables``); a difference raises ``LoadMismatch``.  With a
    ``ledger`` a mart is recorded, with its digest, once it is stored (and
    verified), and a run that finds its digest recorded leaves that table as it
    is: a restarted load goes on at the first unfinished mart.
    """
    book = Ledger(spark, ledger) if isinstance(ledger, str) else ledger
    written: list[str] = []

    def one(name: str, path: str) -> None:
        df = spark.read.parquet(path)
        # the mart's fingerprint is taken once, for its digest and for each read-back
        taken = prints(df)[0] if book or verify else None

        def matches() -> bool:
            return bool(compare_tables(df, sink.read(spark, name), taken=taken).first()["matches"])

        digest, rows = table_digest(df, taken=taken) if book else ("", 0)
        if book:
            last = book.last(f"load/{name}")
            if last and last["digest"] == digest and (not verify or matches()):
                return
        sink(df, name)
        if verify and not matches():
            raise LoadMismatch(f"{name} was read back with other rows, columns or types than were written")
        if book:
            book.record(f"load/{name}", digest=digest, rows=rows)
        written.append(name)

    run_all({name: partial(one, name, path) for name, path in staged.items()}, parallel)
    return [name for name in staged if name in written]


def run(
    spark: SparkSession,
    sources: Mapping[str, str],
    staging_root: str,
    sink: Sink,
    roles: Roles = Roles(),
    schemas: Mapping[str, StructType | str] | None = None,
    verify: bool = False,
    ledger: str | None = None,
    quarantine: str | None = None,
    **options,
) -> dict[str, str]:
    """Extract, transform and load in one application; returns the staged marts.

    ``ledger`` is a folder for this run (one per run of the schedule): a dataset
    extracted, the marts staged and each mart loaded are recorded there, and a
    restart with the same folder does only what is missing."""
    root = staging_root.rstrip("/")
    inputs = {n: f"{root}/raw/{n}" for n in sources}
    staged = {name: f"{root}/marts/{folder}" for name, folder in STAGED_AS.items()}
    book = Ledger(spark, ledger) if ledger else None
    todo = [n for n in sources if book is None or book.last(f"extract/{n}") is None]
    extract(spark, {n: sources[n] for n in todo}, inputs, schemas, quarantine=quarantine)
    for n in todo if book else []:
        book.record(f"extract/{n}")
    staging = partial(transform, spark, inputs, f"{root}/marts", roles, **options)
    if book:
        book.once("transform", staging)
    else:
        staging()
    load(spark, staged, sink, verify=verify, ledger=book)
    return staged


# Sinks -------------------------------------------------------------------


@dataclass(frozen=True)
class Store:
    """A sink that can be read back: call it to write, ``read`` a table by name."""

    write: Callable[[DataFrame, str], object]
    read: Callable[[SparkSession, str], DataFrame]

    def __call__(self, df: DataFrame, table: str) -> None:
        self.write(df, table)


def parquet_sink(root: str, partition_by: Mapping[str, list[str]] | None = None) -> Store:
    layout, root = partition_by or {}, root.rstrip("/")

    def write(df: DataFrame, table: str) -> None:
        write_parquet(df, f"{root}/{table}", partition_by=layout.get(table))

    def read(spark: SparkSession, table: str) -> DataFrame:
        # folder names carry no types, so those of a laid-out mart are its contract's
        reader = spark.read.schema(MART_SCHEMAS[table]) if layout.get(table) and table in MART_SCHEMAS else spark.read
        return reader.parquet(f"{root}/{table}")

    return Store(write, read)


def snapshot_sink(root: str) -> Store:
    """Versioned tables (``sources.snapshots``): a load is seen whole or not at all."""
    root = root.rstrip("/")
    return Store(lambda df, table: write_snapshot(df, f"{root}/{table}"), lambda spark, table: read_snapshot(spark, f"{root}/{table}"))


def jdbc_sink(url: str, properties: Mapping[str, str], mode: str = "overwrite", **tuning) -> Store:
    return Store(
        lambda df, table: write_jdbc(df, url, table, properties, mode=mode, **tuning),
        lambda spark, table: read_jdbc(spark, url, table, properties),
    )


def table_sink(fmt: str, dataset: str, options: Mapping[str, str] | None = None) -> Store:
    """A warehouse-style sink: ``table`` option ``dataset.table``, overwrite."""
    return Store(
        lambda df, table: write_table(df, fmt, {**(options or {}), "table": table_id(dataset, table)}),
        lambda spark, table: table_source(spark, fmt, dataset, table, options),
    )


def table_source(spark: SparkSession, fmt: str, dataset: str, table: str, options=None) -> DataFrame:
    return read_table(spark, fmt, {**(options or {}), "table": table_id(dataset, table)})
