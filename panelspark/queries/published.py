"""Queries that publish tables made of the test tables to a catalog of their own and read them from there."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import pipeline, schemas
from panelspark.operators import project, quality
from panelspark.plans import population
from panelspark.queries.gdp import _bronze
from panelspark.queries.people import _county
from panelspark.queries.registry import query
from panelspark.session import scratch_path, written
from panelspark.sinks import files as sinks
from panelspark.sinks import tables
from panelspark.sources.files import read_table, scan_entity_csv
from panelspark.testtables import _state_code, dim_fips, gdp_raw, table


def _in_database(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """What the work gives with a new database, which is gone afterwards."""
    database = f"published_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    try:
        return written(work(database))
    finally:
        spark.sql(f"drop database {database} cascade")


@query("""
    select lpad(cast(c_nationkey + 1 as varchar), 2, '0') || '001' as fips_code,
           cast(year(o_orderdate) as varchar) || '-01-01' as observation_date, cast(count(*) as integer) as gdp_value
    from orders join customer on o_custkey = c_custkey group by all""")
def scan_entity_files(spark, sf):
    """The orders of each nation and year from one CSV file for each nation, the nation taken from the file's name."""
    orders = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    rows = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.groupBy(F.concat(_state_code(), F.lit("001")).alias("code"), "year").agg(F.sum("n").alias("value"))
    date = F.concat(F.col("year").cast("string"), F.lit("-01-01")).alias("observation_date")
    path = scratch_path(spark, "entities")
    rows = rows.select("code", date, "value").repartition("code")
    rows.write.partitionBy("code").option("header", True).csv(f"{path}/written")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    written_files = hadoop(f"{path}/written/code=*/part-*.csv")
    fs = written_files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(f"{path}/named"))
    for file in fs.globStatus(written_files):  # one for each nation
        code = file.getPath().getParent().getName().removeprefix("code=")
        fs.rename(file.getPath(), hadoop(f"{path}/named/gdpall{code}.csv"))
    return scan_entity_csv(spark, f"{path}/named/gdpall*.csv")


@query("select *, cast(1 as bigint) as files from dim_fips")
def write_single_file_roundtrip(spark, sf):
    """The dimension as one file."""
    path = scratch_path(spark, "single")
    sinks.write_single_file(dim_fips(spark, sf), path)
    files = spark.read.format("binaryFile").load(path).select("path").count()
    return spark.read.parquet(path).withColumn("files", F.lit(files).cast("long"))


@query("select fips_code, gdp_value from gdp_raw where observation_date >= '1995-01-01'")
def replaced_table(spark, sf):
    """A catalog table that was replaced, its columns included, and then read."""

    def work(database):
        rows = gdp_raw(spark, sf)
        tables.replace_table(rows, f"{database}.series")
        tables.replace_table(rows.filter("observation_date >= '1995-01-01'").select("fips_code", "gdp_value"), f"{database}.series")
        return read_table(spark, f"{database}.series")

    return _in_database(spark, work)


@query("""
    select fips_code as FIPS_CODE, year as YEAR, cast(total_population as bigint) as TOTAL_POPULATION,
           cast(male_population as bigint) as MALE_POPULATION, cast(female_population as bigint) as FEMALE_POPULATION,
           cast(pop_0_4 as bigint) as POPULATION_0_4, cast(pop_5_17 as bigint) as POPULATION_5_17,
           cast(pop_18_24 + pop_25_44 + pop_45_64 as bigint) as POPULATION_18_64,
           cast(pop_65_plus as bigint) as POPULATION_65_PLUS, 'kept, kept, kept' as after
    from pop_county""")
def reloaded_table(spark, sf):
    """A declared table loaded with its key checked, which an empty input, a repeated key and a value that it cannot hold
    leave as it was."""
    rows = written(population.broad_bands(_county(spark, sf)))

    def work(database):
        name, key = f"{database}.POPULATION_DATA", tables.PRIMARY_KEYS["POPULATION_DATA"]
        tables.declare_table(spark, name, schemas.POPULATION_DATA)
        count = tables.load(rows, name, key).rows
        after = []
        for spoiled in (rows.limit(0), rows.unionAll(rows), rows.withColumn("YEAR", F.lit("no year"))):
            try:
                loaded = tables.load(spoiled, name, key).loaded
            except quality.QualityError:
                loaded = False
            after.append("kept" if not loaded and spark.table(name).count() == count else "lost")
        return spark.table(name).withColumn("after", F.lit(", ".join(after)))

    return _in_database(spark, work)


@query("""
    select 'GDP_WITH_GROWTH' as table_name, true as loaded, '' as reason, count(*) as row_count, 'PASSED' as verdict from gdp_panel
    union all select 'GDP_BY_YEAR', true, '', count(*), 'PASSED' from gdp_panel
    union all select 'GDP_COUNTY_SUMMARY', true, '', count(distinct fips_code), 'PASSED' from gdp_panel
    union all select 'GDP_STATE_SUMMARY', true, '', count(distinct coalesce(state_code, '')), 'PASSED' from gdp_panel
    union all select 'GDP_BY_STATE_BY_YEAR', true, '', count(distinct (coalesce(state_code, ''), year)), 'PASSED' from gdp_panel
    union all select 'POPULATION_DATA', false, 'not found', 0, null""")
def exported_tables(spark, sf):
    """The GDP tables built by the flow and exported to their declared tables, with the verdicts of the gate over those; a
    table that was not built is told."""
    out = scratch_path(spark, "flow")
    rows = _bronze(spark, sf).withColumn("gdp_value", F.col("gdp_value").cast("int"))
    sinks.write_partitioned(rows, f"{out}/bronze/gdp_data", "state_code")
    pipeline.build_gdp(spark, out)

    def work(database):
        tables.declare_warehouse(spark, database)
        paths = pipeline.export_paths(out, "gdp") | {"POPULATION_DATA": f"{out}/gold/population_data"}
        loads = tables.export_tables(spark, paths, database)
        rows = [(load.table.split(".")[1], load.loaded, load.reason, load.rows) for load in loads]
        told = spark.createDataFrame(rows, "table_name string, loaded boolean, reason string, row_count bigint")
        verdicts = quality.verdicts(pipeline.check_published(spark, "gdp", database=database))
        return told.join(verdicts.withColumn("table_name", F.upper("table_name")), "table_name", "left")

    return _in_database(spark, work)


@query("select fips_code, observation_date, gdp_value, 'batch 7' as batch, true as stamped from gdp_raw")
def tagged_batch(spark, sf):
    """The series with the name of its batch and the time of its load, behind the gate that it has rows."""
    rows = project.tag(quality.require_rows(gdp_raw(spark, sf), "the series"), "batch", "batch 7")
    stamped = project.stamp_load_time(rows)
    now = F.current_timestamp()
    fresh = F.col("processed_at").between(now - F.expr("interval 1 hour"), now)
    return stamped.withColumn("stamped", fresh).drop("processed_at")


@query("""
    select fips_code, state_name, county_code, county_name, date, cast(gdp_value as integer) as gdp_value, state_code
    from gdp_bronze""")
def partitions_written_one_by_one(spark, sf):
    """The bronze table written state by state: each write replaces the partitions it has rows for and no other."""
    rows, path = written(_bronze(spark, sf).withColumn("gdp_value", F.col("gdp_value").cast("int"))), scratch_path(spark, "bronze")
    sinks.write_partitioned(rows.limit(5), path, "state_code")
    first = F.coalesce(F.col("state_code"), F.lit("")) < "13"
    for part in (first, ~first):
        sinks.write_partitioned(rows.filter(part), path, "state_code", given_only=True)
    return spark.read.schema(schemas.BRONZE_GDP).parquet(path)
