"""The flows from files to gold tables.

Each stage reads a table the stage before has written. The rows sorted by county
are computed once and kept on executor disks while the tables made of them are
written; a lost executor costs only the recomputation of its share.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import schemas
from panelspark.functions.keys import entity_key_from_file, file_base_name
from panelspark.operators.joins import build_dimension, unmapped_keys
from panelspark.operators.quality import Expectation, quality_report, require_rows, require_unique
from panelspark.places import state_names
from panelspark.plans import airquality, gdp, population
from panelspark.session import remove, written
from panelspark.sinks import ledger
from panelspark.sinks.files import write_csv, write_partitioned, write_table
from panelspark.sinks.tables import WAREHOUSE, Load, load
from panelspark.sources.files import (
    scan_code_list,
    scan_csv,
    scan_dimension,
    scan_entity_csv,
    scan_or_empty,
    scan_place_names,
    scan_table,
)
from panelspark.sources.manifest import changed, listed_files, read_manifest
from panelspark.sources.records import scan_records
from panelspark.streaming.observations import read_snapshot

COUNTY_ORDER = ["state_code", "fips_code", "year"]

#: Row floors and key columns of the published GDP tables.
GDP_EXPECTATIONS = {
    "gdp_by_year": Expectation(50_000, ("fips_code", "year", "gdp_value")),
    "gdp_with_growth": Expectation(45_000, ("fips_code", "year", "gdp_value")),
    "gdp_county_summary": Expectation(3_000, ("fips_code", "county_name", "years_of_data")),
    "gdp_state_summary": Expectation(50, ("state_code", "state_name", "num_counties")),
    "gdp_by_state_by_year": Expectation(800, ("state_code", "year", "total_gdp")),
}


@dataclass(frozen=True)
class Bronze:
    """Outcome of a bronze load."""

    path: str
    rows: int
    unmapped: int = 0


def _dimension(spark: SparkSession, path: str) -> DataFrame:
    """The dimension, if no code has two names: those would count their facts twice."""
    return require_unique(scan_dimension(spark, path), ["fips_code"], "the dimension")


def load_gdp(spark: SparkSession, csv_glob: str, dimension_path: str, out: str) -> Bronze:
    """Per-county CSV files to the bronze GDP table; rows without a known place are counted."""
    rows = gdp.bronze(scan_entity_csv(spark, csv_glob), _dimension(spark, dimension_path))
    path = f"{out}/bronze/gdp_data"
    count = write_partitioned(rows, path, "state_code")
    unmapped = scan_table(spark, path, schemas.BRONZE_GDP).filter("state_code is null")  # one partition folder
    return Bronze(path, count, unmapped.count())


def load_gdp_changes(spark: SparkSession, csv_glob: str, dimension_path: str, out: str) -> Bronze:
    """As ``load_gdp``, but only for the states in which something has changed since; ``rows`` are those written.

    A manifest beside the table holds every file with its length, time, county and the place the county has. Where a file or
    a place differs, the state is read and written anew, and no other file is opened. A failed run is made good by the next,
    since the manifest is written last.
    """
    path, places = f"{out}/bronze/gdp_data", _dimension(spark, dimension_path)
    place = places.select("fips_code", "state_code", F.sha2(F.to_json(F.struct(*sorted(places.columns))), 256).alias("place"))
    files = listed_files(spark, csv_glob).withColumn("fips_code", entity_key_from_file(file_base_name(F.col("path"))))
    files = written(files.join(place, "fips_code", "left").select("path", "length", "modified", "fips_code", "state_code", "place"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema)
    before = read_manifest(spark, f"{path}_files", ddl)
    states = written(changed(files, before, ["state_code"]))
    touched = files.join(states.withColumnRenamed("state_code", "s"), F.col("state_code").eqNullSafe(F.col("s")), "left_semi")
    paths = [r.path for r in touched.select("path").collect()]  # as many as Spark opens
    count = 0
    if paths:
        rows = gdp.bronze(scan_entity_csv(spark, paths), places)
        count = write_partitioned(rows, path, "state_code", given_only=True)
    left = states.join(files.select(F.col("state_code").alias("s")), F.col("state_code").eqNullSafe(F.col("s")), "left_anti")
    for row in left.collect():  # at most one for each state
        remove(spark, f"{path}/state_code={row.state_code or '__HIVE_DEFAULT_PARTITION__'}")
    if count or not states.isEmpty():
        files.write.mode("overwrite").parquet(f"{path}_files")
    unmapped = scan_table(spark, path, schemas.BRONZE_GDP).filter("state_code is null")
    return Bronze(path, count, unmapped.count())


def load_places(spark: SparkSession, codes_path: str, names_path: str, out: str) -> tuple[int, int]:
    """Code lines and place names to the dimension file; returns the codes with and without a name."""
    codes = scan_code_list(spark, codes_path)
    places = build_dimension(codes, scan_place_names(spark, names_path), state_names(spark))
    write_csv(places.select("fips_code", "state_code", "state_name", "county_name", "county_code"), f"{out}/places")
    written = scan_dimension(spark, f"{out}/places")
    return written.count(), unmapped_keys(codes, written).count()


def load_population(spark: SparkSession, csv_path: str, out: str) -> tuple[Bronze, Bronze]:
    """The wide population CSV to the county and state bronze tables."""
    coded = population.with_place_codes(scan_csv(spark, csv_path, schemas.POPULATION_RAW))
    tables = {"population_county": population.bronze_county(coded), "population_state": population.bronze_state(coded)}
    county, state = (
        Bronze(path, write_partitioned(df, path, "state_code"))
        for path, df in ((f"{out}/bronze/{name}", df) for name, df in tables.items())
    )
    return county, state


def build_gdp(spark: SparkSession, out: str) -> dict[str, int]:
    """The five GDP gold tables from bronze; returns the rows written to each."""
    bronze = scan_table(spark, f"{out}/bronze/gdp_data", schemas.BRONZE_GDP)
    by_year = gdp.by_year(gdp.clean(require_rows(bronze, "bronze gdp_data")))
    counts = {"gdp_by_year": write_table(by_year, f"{out}/gold/gdp_by_year", COUNTY_ORDER)}
    by_year = scan_table(spark, f"{out}/gold/gdp_by_year", schemas.GDP_BY_YEAR)
    return counts | _derived(by_year, out, "gdp", gdp)


def build_population(spark: SparkSession, out: str, dimension_path: str) -> dict[str, int]:
    """The five population gold tables and the published bands from bronze; returns the rows written to each."""
    bronze = scan_table(spark, f"{out}/bronze/population_county", schemas.BRONZE_POPULATION_COUNTY)
    known = population.clean(require_rows(bronze, "bronze population_county"), _dimension(spark, dimension_path))
    path = f"{out}/gold/population_by_year"
    counts = {"population_by_year": write_table(population.by_year(known), path, COUNTY_ORDER)}
    by_year = scan_table(spark, path, schemas.POPULATION_BY_YEAR)
    counts |= {"population_data": write_table(population.broad_bands(bronze), f"{out}/gold/population_data")}
    return counts | _derived(by_year, out, "population", population)


def _derived(by_year: DataFrame, out: str, name: str, plans) -> dict[str, int]:
    """The four tables made of the by-year table.

    Rows are placed in ranges of (state, county, year), however many a county has.
    That is also the order of the written growth table.
    """
    rows = plans.sequence(by_year, sliced=True)
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        return {
            f"{name}_with_growth": write_table(
                plans.with_growth(rows), f"{out}/gold/{name}_with_growth", COUNTY_ORDER
            ),
            f"{name}_county_summary": write_table(
                plans.county_summary(rows), f"{out}/gold/{name}_county_summary", ["state_code", "fips_code"]
            ),
            f"{name}_state_summary": write_table(
                plans.state_summary(rows), f"{out}/gold/{name}_state_summary", ["state_code"]
            ),
            f"{name}_by_state_by_year": write_table(
                plans.by_state_by_year(by_year), f"{out}/gold/{name}_by_state_by_year", ["state_code", "year"]
            ),
        }
    finally:
        rows.unpersist()


def consolidate_epa(spark: SparkSession, json_glob: str, out: str) -> int:
    """The per-city JSON files, lists or objects with a list under ``Data``, to one curated table; returns its rows."""
    records = scan_records(spark, json_glob, schemas.EPA_RECORD)
    return write_table(airquality.consolidate(records), f"{out}/curated/all_epa_data")


def build_epa(spark: SparkSession, out: str) -> dict[str, int]:
    """The yearly means per city and pollutant and the rows of the main cities, from the curated table."""
    records = spark.read.parquet(f"{out}/curated/all_epa_data")
    means = airquality.yearly_mean(records, ["city", "pollutant"])
    return {
        "epa_yearly_mean": write_table(means, f"{out}/curated/epa_yearly_mean", ["city", "pollutant", "year"]),
        "epa_cities": write_table(airquality.tidy(records), f"{out}/curated/epa_cities", ["City", "Pollutant", "Year"]),
    }


def gold_names(prefix: str) -> list[str]:
    """Names of the gold tables of a flow."""
    return [name for name in schemas.GOLD if name.startswith(prefix)]


def gold_tables(spark: SparkSession, out: str, prefix: str) -> dict[str, DataFrame]:
    """The written gold tables of a flow; a missing one has no rows."""

    def read(name: str) -> DataFrame:
        ddl = schemas.GOLD[name]
        return scan_or_empty(spark, lambda: scan_table(spark, f"{out}/gold/{name}", ddl), ddl)

    return {name: read(name) for name in gold_names(prefix)}


def check_gold(
    spark: SparkSession, out: str, prefix: str, expectations: Mapping[str, Expectation] | None = None
) -> DataFrame:
    """The quality report over the gold tables of a flow; a missing table fails as an empty one does."""
    return quality_report(gold_tables(spark, out, prefix), expectations or {})


def export_paths(out: str, prefix: str) -> dict[str, str]:
    """Declared table and folder of what a flow publishes."""
    names = [n for n in gold_names(prefix) if n != "population_by_year"]
    names += ["population_data"] * (prefix == "population")
    return {n.upper(): f"{out}/gold/{n}" for n in names}


def check_published(
    spark: SparkSession, prefix: str, expectations: Mapping[str, Expectation] | None = None, database: str = "default"
) -> DataFrame:
    """The quality report over the catalog tables of a flow; a missing table fails as an empty one does."""

    def read(name: str) -> DataFrame:
        table = f"{database}.{name}"
        return spark.table(table) if spark.catalog.tableExists(table) else spark.createDataFrame([], WAREHOUSE[name.upper()])

    names = [path.rsplit("/", 1)[1] for path in export_paths("", prefix).values()]
    return quality_report({name: read(name) for name in names}, expectations or {})


def publish_observations(spark: SparkSession, out: str, database: str = "default") -> list[Load]:
    """What the stream has stored since the last publish: new batches are added to the history table, and the snapshot
    table is replaced by the rows of the snapshot that counts. Without new batches both stay as they are."""
    history, table = f"{out}/air_quality/history", f"{database}.AIR_QUALITY_13_CITIES"
    read = lambda batches: ledger.read_batches(spark, history, schemas.AQI_HISTORY, batches)
    added = ledger.load_new(spark, table, ledger.finished_batches(spark, history), read)
    if not added:
        return [Load(name, False, "nothing new") for name in (table, f"{database}.AQI_REALTIME")]
    current = read_snapshot(spark, f"{out}/air_quality/current")
    return [Load(table, True, rows=added), load(current, f"{database}.AQI_REALTIME")]
