"""Queries that write files from the test tables and read them back with the library's sources."""

from pyspark.sql import functions as F

from panelspark import schemas
from panelspark.queries.registry import query
from panelspark.session import scratch_path
from panelspark.sinks import files as sinks
from panelspark.sources import files as sources
from panelspark.testtables import _county_code, _state_code, dim_fips, gdp_raw, population_raw, table


@query("""
    select lpad(cast(c_nationkey + 1 as varchar), 2, '0') || lpad(cast(c_custkey + 1 as varchar), 11, '0') as fips_code,
           lpad(cast(c_nationkey + 1 as varchar), 2, '0') as state_code, n_name as state_name, c_name as county_name,
           lpad(cast(c_custkey + 1 as varchar), 11, '0') as county_code
    from customer join nation on c_nationkey = n_nationkey""")
def scan_dimension(spark, sf):
    """Every customer as a place, from CSV whose columns stand in another order and case."""
    nation = table(spark, sf, "nation")
    places = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    path = scratch_path(spark, "dimension")
    places.select(
        F.col("c_name").alias("County_Name"),
        F.concat(_state_code(), _county_code()).alias("FIPS_Code"),
        F.lit("left out").alias("note"),
        F.col("n_name").alias("State_Name"),
        _county_code().alias("County_Code"),
        _state_code().alias("State_Code"),
    ).write.option("header", True).csv(path)
    return sources.scan_dimension(spark, path)


@query("select *, cast(null as varchar) as Statefips, cast(null as varchar) as Countyfips from population_raw")
def scan_wide_csv(spark, sf):
    """The wide population table written as CSV in its declared order and scanned with its schema."""
    rows, path = population_raw(spark, sf), scratch_path(spark, "people")
    rows = rows.withColumns({"Statefips": F.lit(""), "Countyfips": F.lit("")})
    names = [part.split()[0] for part in schemas.POPULATION_RAW.split(", ")]
    rows.select(names).write.option("header", True).csv(path)
    longs = {c: F.col(c).cast("long") for c in names if c.endswith(("n", "4", "7", "8", "plus")) and c != "Description"}
    return sources.scan_csv(spark, path, schemas.POPULATION_RAW).withColumns(longs)


@query("select * from gdp_raw")
def write_json_roundtrip(spark, sf):
    """The GDP series written by the JSON sink and read with its schema."""
    rows, path = gdp_raw(spark, sf), scratch_path(spark, "json")
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("select *, (select count(*) from dim_fips) as found from dim_fips")
def write_table_roundtrip(spark, sf):
    """The dimension written in order and scanned, with the rows counted while writing and after."""
    rows, path = dim_fips(spark, sf), scratch_path(spark, "table")
    written = sinks.write_table(rows, path, ["state_code", "fips_code"])
    found = sinks.read_back_count(spark, path)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return sources.scan_table(spark, path, ddl).withColumn("found", F.lit(found if found == written else -1).cast("long"))
