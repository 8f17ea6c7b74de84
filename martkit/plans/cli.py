"""Command line for the batch jobs, for use with ``spark-submit``.

    spark-submit martkit/plans/cli.py run \\
        --source df_flights=s3a://in/flights.csv --source df_airline=... --source df_airports=... \\
        --staging s3a://stage/ --sink parquet:s3a://warehouse/

Sinks: ``parquet:<root>``, ``snapshot:<root>`` (versioned tables), ``jdbc:<url>``
(connection properties from the JSON file given with ``--jdbc-properties``;
nothing is stored) or ``table:<format>:<dataset>`` for a warehouse connector.
``--sink-option`` passes options on to the last two, such as ``batchsize=10000``,
``numPartitions=16`` or a connector's staging bucket.

Unless ``--shuffle-partitions`` is given, a job sizes its shuffles by the bytes of
its input files.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from martkit.plans import jobs  # noqa: E402
from martkit.session import build_session, shuffle_partitions_for  # noqa: E402
from martkit.sources.files import copy_datasets  # noqa: E402
from martkit.sources.smallfiles import Folder  # noqa: E402


def _pairs(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items or []:
        name, sep, path = item.partition("=")
        if not sep:
            raise SystemExit(f"expected name=path, got {item!r}")
        out[name] = path
    return out


def _sink(spec: str, properties_file: str | None, options: dict[str, str] | None = None) -> jobs.Sink:
    kind, _, rest = spec.partition(":")
    if kind == "parquet":
        return jobs.parquet_sink(rest)
    if kind == "snapshot":
        return jobs.snapshot_sink(rest)
    if kind == "jdbc":
        with open(properties_file or "", encoding="utf-8") as fh:
            props = json.load(fh)
        return jobs.jdbc_sink(f"jdbc:{rest}", {**props, **(options or {})})
    if kind == "table":
        fmt, _, dataset = rest.partition(":")
        return jobs.table_sink(fmt, dataset, options)
    raise SystemExit(f"unknown sink {spec!r}")


def size_shuffles(spark, paths: list[str], given: int | None) -> int:
    """Set the session's shuffle partitions: as given, or one for each 128 MB of
    the input files; adaptive execution merges those that turn out small."""
    count = given or shuffle_partitions_for(sum(Folder(spark, p).size() for p in paths))
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="martkit")
    sub = p.add_subparsers(dest="command", required=True)
    ex = sub.add_parser("extract", help="CSV to Parquet")
    ex.add_argument("--source", action="append", required=True, help="name=csv_path")
    ex.add_argument("--target", action="append", required=True, help="name=parquet_path")
    tr = sub.add_parser("transform", help="three Parquet inputs to four marts")
    tr.add_argument("--input", action="append", required=True, help="df_flights|df_airline|df_airports=path")
    tr.add_argument("--staging", required=True)
    ld = sub.add_parser("load", help="staged marts to a sink")
    ld.add_argument("--mart", action="append", required=True, help="mart=staged_path")
    rn = sub.add_parser("run", help="extract, transform and load")
    rn.add_argument("--source", action="append", required=True, help="name=csv_path")
    rn.add_argument("--staging", required=True)
    for s in (ex, rn):
        s.add_argument(
            "--schema", action="append", default=[],
            help="name=DDL, e.g. 'df_airline=IATA_CODE string, AIRLINE string'; skips the inference pass",
        )
        s.add_argument("--quarantine", help="folder for bad records of datasets with a --schema; without it they fail the run")
    cp = sub.add_parser("copy", help="copy Parquet datasets between roots")
    cp.add_argument("--src-root", required=True)
    cp.add_argument("--dst-root", required=True)
    cp.add_argument("names", nargs="+")
    for s in (tr, rn):
        s.add_argument("--avg-scale", type=int, default=None, help="round the mean (2 for the rounded variant)")
        s.add_argument("--cancel-limit", type=int, default=None, help="keep the top N cancellation rows")
    for s in (ld, rn):
        s.add_argument("--sink", required=True, help="parquet:<root> | snapshot:<root> | jdbc:<url> | table:<format>:<dataset>")
        s.add_argument("--sink-option", action="append", default=[], help="key=value for a jdbc or table sink")
        s.add_argument("--verify", action="store_true", help="read each table back and compare it with its mart")
        s.add_argument("--ledger", help="folder that records finished steps; a restart with it does only what is missing")
        s.add_argument("--jdbc-properties", help="JSON file with user, password, driver")
    for s in (ex, tr, ld, rn):
        s.add_argument("--shuffle-partitions", type=int, default=None)
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or build_session(app_name=f"martkit-{args.command}")
    opts = {}
    if args.command in ("transform", "run"):
        opts = {"avg_scale": args.avg_scale, "cancel_limit": args.cancel_limit}
    schemas = _pairs(getattr(args, "schema", None))
    if args.command != "copy":
        read = getattr(args, "source", None) or getattr(args, "input", None) or args.mart
        size_shuffles(spark, list(_pairs(read).values()), args.shuffle_partitions)
    if args.command == "extract":
        return jobs.extract(spark, _pairs(args.source), _pairs(args.target), schemas, quarantine=args.quarantine)
    if args.command == "transform":
        return jobs.transform(spark, _pairs(args.input), args.staging, **opts)
    if args.command == "load":
        sink = _sink(args.sink, args.jdbc_properties, _pairs(args.sink_option))
        return {"loaded": jobs.load(spark, _pairs(args.mart), sink, verify=args.verify, ledger=args.ledger)}
    if args.command == "run":
        sink = _sink(args.sink, args.jdbc_properties, _pairs(args.sink_option))
        return jobs.run(
            spark, _pairs(args.source), args.staging, sink, schemas=schemas, verify=args.verify, ledger=args.ledger,
            quarantine=args.quarantine, **opts,
        )
    return {"copied": copy_datasets(spark, args.names, args.src_root, args.dst_root)}


if __name__ == "__main__":
    print(json.dumps(main()))
