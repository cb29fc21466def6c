"""Run a flow: ``spark-submit run.py <flow> ...`` or ``python -m panelspark <flow> ...``."""

import argparse
import sys

from pyspark.sql import SparkSession

from panelspark import pipeline
from panelspark.operators.quality import require_passed, verdicts
from panelspark.session import remove_scratch
from panelspark.sinks.tables import declare_warehouse, export_tables
from panelspark.streaming.observations import landed_observations, read_rejected, start_store


def _places(spark: SparkSession, args: argparse.Namespace) -> None:
    mapped, unmapped = pipeline.load_places(spark, args.input, args.names, args.out)
    print(f"places: {mapped:,} codes with a name, {unmapped:,} without")


def _gdp(spark: SparkSession, args: argparse.Namespace) -> None:
    load = pipeline.load_gdp_changes if args.changes else pipeline.load_gdp
    bronze = load(spark, args.input, args.dimension, args.out)
    print(f"bronze: {bronze.rows:,} rows, {bronze.unmapped:,} without a known place")
    for table, rows in pipeline.build_gdp(spark, args.out).items():
        print(f"{table}: {rows:,} rows")


def _population(spark: SparkSession, args: argparse.Namespace) -> None:
    for bronze in pipeline.load_population(spark, args.input, args.out):
        print(f"{bronze.path}: {bronze.rows:,} rows")
    for table, rows in pipeline.build_population(spark, args.out, args.dimension).items():
        print(f"{table}: {rows:,} rows")


def _epa(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"all_epa_data: {pipeline.consolidate_epa(spark, args.input, args.out):,} rows")
    for table, rows in pipeline.build_epa(spark, args.out).items():
        print(f"{table}: {rows:,} rows")


def _observations(spark: SparkSession, args: argparse.Namespace) -> None:
    root = f"{args.out}/air_quality"
    landed = landed_observations(
        spark, args.input, files_per_batch=args.files_per_batch, archive=args.archive, keep_malformed=True
    )
    paths = [f"{root}/{name}" for name in ("history", "current", "checkpoint")]
    start_store(landed, *paths, args.every, f"{root}/rejected").awaitTermination()
    print(f"malformed files: {read_rejected(spark, f'{root}/rejected').count():,}")


def _check(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.published:
        report = pipeline.check_published(spark, args.flow, pipeline.GDP_EXPECTATIONS, args.database)
    else:
        report = pipeline.check_gold(spark, args.out, args.flow, pipeline.GDP_EXPECTATIONS)
    report = report.persist()
    for row in verdicts(report).orderBy("table_name").collect():
        print(f"{row.table_name}: {row.verdict}")
    require_passed(report)


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    declare_warehouse(spark, args.database)
    if args.flow == "observations":
        loads = pipeline.publish_observations(spark, args.out, args.database)
    else:
        loads = export_tables(spark, pipeline.export_paths(args.out, args.flow), args.database)
    for load in loads:
        print(f"{load.table}: {f'{load.rows:,} rows' if load.loaded else load.reason}")
    print(f"in all: {sum(load.rows for load in loads):,} rows")


def main(argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="panelspark")
    flows = parser.add_subparsers(dest="command", required=True)

    def flow(name, run, *, source=False, dimension=False):
        sub = flows.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--out", required=True, help="folder of the bronze, gold and curated tables")
        if source:
            sub.add_argument("--input", required=True, help="path or glob of the input files")
        if dimension:
            sub.add_argument("--dimension", required=True, help="CSV file with the place names")
        return sub

    flow("places", _places, source=True).add_argument("--names", required=True, help="JSON file of place names")
    gdp = flow("gdp", _gdp, source=True, dimension=True)
    gdp.add_argument("--changes", action="store_true", help="load only the states whose files or places have changed")
    flow("population", _population, source=True, dimension=True)
    flow("epa", _epa, source=True)
    observations = flow("observations", _observations, source=True)
    observations.add_argument("--every", help='interval, such as "20 minutes"')
    observations.add_argument("--files-per-batch", type=int, help="most files that one batch takes in")
    observations.add_argument("--archive", help="folder to which files move that are done with")
    for name, run in (("check", _check), ("export", _export)):
        sub = flow(name, run)
        flows_of = ["gdp", "population"] + ["observations"] * (name == "export")
        sub.add_argument("--flow", choices=flows_of, required=True)
        sub.add_argument("--database", default="default")
        if name == "check":
            sub.add_argument("--published", action="store_true", help="check the catalog tables, not the folders")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"panelspark-{args.command}").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        remove_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
