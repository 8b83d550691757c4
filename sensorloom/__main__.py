"""Command line: `python -m sensorloom JOB ...`, or the same through spark-submit."""

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from sensorloom.operators import profile, quality
from sensorloom.plans import JobConfig, run_all, run_event_geo, run_sensor_health, run_temp_humidity
from sensorloom.session import build_session
from sensorloom.sinks import write_parquet
from sensorloom.sources import read_bronze
from sensorloom.streaming import ingest_bronze, ingest_errors
from sensorloom.streaming.ingest import INGEST_CONF, MAX_BYTES_PER_TRIGGER, MAX_FILE_AGE, read_lines

JOBS = {
    "sensor-health": run_sensor_health,
    "temp-humidity": run_temp_humidity,
    "event-geo": run_event_geo,
}


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="{asctime} {levelname} {name}: {message}", style="{")
    args = _parser().parse_args(argv)
    conf = dict(setting.split("=", 1) for setting in args.conf)
    if args.job == "ingest":
        return _ingest(args, conf)
    if args.job == "profile":
        return _profile(args, conf)
    config = JobConfig(
        args.bronze,
        args.database,
        getattr(args, "table", "sensor_health"),
        args.warehouse,
        args.catalog,
        args.partitioned,
        args.allow_empty,
    ).validate()
    spark = build_session(f"sensorloom {args.job}", args.catalog, args.warehouse, conf, args.catalog_type)
    try:
        if args.job == "all":
            run_all(
                spark,
                config.bronze,
                config.database,
                config.warehouse,
                config.catalog,
                config.partitioned,
                allow_empty=config.allow_empty,
            )
        else:
            JOBS[args.job](spark, config)
    finally:
        spark.stop()


def _ingest(args: argparse.Namespace, conf: dict[str, str]) -> None:
    spark = build_session("sensorloom ingest", conf={**INGEST_CONF, **conf})
    trigger = {"availableNow": True} if args.once else None
    try:
        routes = [
            start(
                spark,
                read_lines(spark, args.source, args.max_bytes_per_trigger, args.max_file_age),
                args.bronze,
                args.checkpoint,
                trigger,
            )
            for start in (ingest_bronze, ingest_errors)
        ]
        # Either route failing ends the run; `once` waits for both.
        if args.once:
            for route in routes:
                route.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        spark.stop()


def profile_tables(spark: SparkSession, bronze: str, output: str, partitioned: bool = False) -> list[str]:
    """Writes the profile of a bronze as Parquet directories under `output`, and names them."""
    readings = read_bronze(spark, bronze, partitioned)
    tables = {
        "status_distribution": profile.distribution(readings, "status"),
        "event_type_distribution": profile.distribution(readings, "event_type"),
        "numeric_summary": profile.describe_numeric(readings),
        "scorecard": quality.validate(readings),
        "completeness": quality.completeness(readings),
    }
    return [write_parquet(table, output, name) for name, table in tables.items()]


def _profile(args: argparse.Namespace, conf: dict[str, str]) -> None:
    spark = build_session("sensorloom profile", conf=conf)
    try:
        profile_tables(spark, args.bronze, args.output, args.partitioned)
    finally:
        spark.stop()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sensorloom")
    commands = parser.add_subparsers(dest="job", required=True)
    for name in (*JOBS, "all"):
        job = commands.add_parser(name)
        job.add_argument("bronze")
        job.add_argument("database")
        if name != "all":
            job.add_argument("table")
        job.add_argument("warehouse", nargs="?")
        job.add_argument("--catalog", help="named Iceberg catalog; default: Parquet tables in the built-in catalog")
        job.add_argument("--catalog-type", choices=("glue", "hadoop"), default="glue")
        job.add_argument("--partitioned", action="store_true", help="bronze has day= directories")
        job.add_argument("--allow-empty", action="store_true", help="a bronze without readings empties the tables")
        job.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    profiled = commands.add_parser("profile")
    profiled.add_argument("bronze")
    profiled.add_argument("output")
    profiled.add_argument("--partitioned", action="store_true", help="bronze has day= directories")
    profiled.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    ingest = commands.add_parser("ingest")
    ingest.add_argument("source")
    ingest.add_argument("bronze")
    ingest.add_argument("checkpoint")
    ingest.add_argument("--once", action="store_true", help="take what is there and stop")
    ingest.add_argument("--max-bytes-per-trigger", type=int, default=MAX_BYTES_PER_TRIGGER, help="step of a backlog")
    ingest.add_argument("--max-file-age", default=MAX_FILE_AGE, help="older files than the newest by this are skipped")
    ingest.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    return parser


if __name__ == "__main__":
    main()
