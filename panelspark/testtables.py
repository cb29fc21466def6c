"""The star-schema test tables read as panels, for Spark and as SQL text for the check.

State = nation, county = customer, year = order year. A place code has 2 digits for
the state and 11 for the county, wide enough for the customer numbers of any scale.
Customers whose number is 7 modulo 50 are left out of the dimension: they are the
unmapped codes.

On the Spark side facts are aggregated on their own key before they meet the
customer table, so that a customer or order with a large share of all rows has been
reduced to one row per year by then.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.plans.airquality import MAIN_CITIES

STATE_WIDTH = 2
COUNTY_WIDTH = 11
COUNTY_BASE = 10**COUNTY_WIDTH

# The cities that observations belong to.
CITIES = [
    "New York City",
    "Washington D.C.",
    "San Francisco",
    "Los Angeles",
    "Chicago",
    "Houston",
    "Miami",
    "Minneapolis",
    "Denver",
    "Seattle",
    "Atlanta",
    "Boston",
    "St. Louis",
]


#: Cities of the yearly records: those that are kept, and one that is not.
EPA_CITIES = [*MAIN_CITIES, "Elsewhere"]

# Declared, so that reading a table starts no job to look into its files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _state_code() -> Column:
    return F.lpad((F.col("c_nationkey") + 1).cast("string"), STATE_WIDTH, "0")


def _county_code() -> Column:
    return F.lpad((F.col("c_custkey") + 1).cast("string"), COUNTY_WIDTH, "0")


def _city_name(number: Column, names: list[str] = CITIES) -> Column:
    """The name of a city by its position in the list."""
    return F.element_at(F.array(*[F.lit(c) for c in names]), (number % len(names) + 1).cast("int"))


def dim_fips(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 50 != 7)
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(_state_code(), _county_code()).alias("fips_code"),
        _state_code().alias("state_code"),
        F.col("n_name").alias("state_name"),
        _county_code().alias("county_code"),
        F.col("c_name").alias("county_name"),
    )


def gdp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate").alias("order_year")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")  # whole numbers: exact in any order
    spent = F.round(F.sum(cents) / 100).cast("long")
    yearly = table(spark, sf_dir, "orders").groupBy("o_custkey", year).agg(spent.alias("gdp_value"))
    return yearly.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(_state_code(), _county_code()).alias("fips_code"),
        F.concat(F.col("order_year").cast("string"), F.lit("-01-01")).alias("observation_date"),
        "gdp_value",
    )


def population_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int").cast("long")

    def where(condition: Column) -> Column:
        return F.sum(F.when(condition, quantity).otherwise(0))

    line = F.col("l_linenumber")
    bands = {f"b{n}": where(line == n) for n in range(1, 6)} | {"b6": where(line >= 6)}
    sums = {"tot": F.sum(quantity)} | bands | {"male": where(F.col("l_linestatus") == "O")}
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[s.alias(n) for n, s in sums.items()])
    per_year = (
        per_order.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", F.year("o_orderdate").alias("yr"))
        .agg(*[F.sum(n).alias(n) for n in sums])
    )
    return per_year.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("nk"), F.col("c_custkey").alias("ck"), F.col("c_name").alias("location"), "yr", *sums
    )


def population_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counties, states and the nation from one pass over the base: each of its rows counts at three levels."""
    base = population_base(spark, sf_dir)
    counted = base.columns[4:]
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("state"))
    state_id = (F.col("nk").cast("long") + 1) * COUNTY_BASE

    def place(code: Column, name: Column) -> Column:
        return F.struct(code.cast("string").alias("id"), name.alias("location"))

    levels = F.array(
        place(state_id + F.col("ck") + 1, F.col("location")),
        place(state_id, F.col("state")),
        place(F.lit(0), F.lit("U.S.")),
    )
    placed = base.join(nation, "nk").select(F.explode(levels).alias("place"), "yr", *counted)
    rows = placed.groupBy("place.id", "place.location", "yr").agg(*[F.sum(c).alias(c) for c in counted])

    def wide(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("id").alias("IBRC_Geo_ID"),
            F.col("location").alias("Description"),
            F.col("yr").alias("Year"),
            F.col("tot").alias("Total_Population"),
            F.col("b1").alias("Population_0_4"),
            F.col("b2").alias("Population_5_17"),
            F.col("b3").alias("Population_18_24"),
            F.col("b4").alias("Population_25_44"),
            F.col("b5").alias("Population_45_64"),
            F.col("b6").alias("Population_65_plus"),
            (F.col("b1") + F.col("b2")).alias("Population_Under_18"),
            (F.col("b3") + F.col("b4")).alias("Population_18_54"),
            (F.col("b5") + F.col("b6")).alias("Population_55_plus"),
            F.col("male").alias("Male_Population"),
            (F.col("tot") - F.col("male")).alias("Female_Population"),
        )

    return wide(rows)


def aqi_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(table(spark, sf_dir, "events"))


def observations(events: DataFrame) -> DataFrame:
    """Events as air-quality observations; used on a batch and on a stream."""
    return events.select(
        "event_id",
        "ts",
        F.col("ts").cast("date").cast("string").alias("DateObserved"),
        F.hour("ts").alias("HourObserved"),
        F.col("event_type").alias("ParameterName"),
        F.floor("value").cast("int").alias("AQI"),
        F.col("props").alias("Category"),
        _city_name(F.col("user_id")).alias("TargetCity"),
    )


def observation_records(rows: DataFrame) -> DataFrame:
    """Observations with their category as a struct, as the service delivers it."""
    level = F.from_json("Category", "k int")["k"]
    return rows.withColumn("Category", F.struct(level.alias("Number"), level.cast("string").alias("Name")))


def epa_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("o_orderkey") % 3
    pollutant = F.when(third == 0, "PM2.5").when(third == 1, "Ozone").otherwise("NO2")
    city = F.col("o_custkey") % len(EPA_CITIES)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("obs_id"),
        F.concat(F.lit("data/raw/"), _city_name(F.col("o_custkey"), EPA_CITIES), F.lit("_"), pollutant, F.lit(".json")).alias(
            "source_file"
        ),
        (city + 1).cast("string").alias("state_code"),
        (F.col("o_custkey") + 1).cast("string").alias("county_code"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("arithmetic_mean"),
    )


def code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(_state_code(), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("  "), code, F.lit("    "), "c_name").alias("value")
    )


# ---------------------------------------------------------------------------
# The same views as SQL text.

_STATE = "lpad(cast(c_nationkey + 1 as varchar), 2, '0')"
_COUNTY = f"lpad(cast(c_custkey + 1 as varchar), {COUNTY_WIDTH}, '0')"
_POPULATION_SUMS = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in ["tot", "b1", "b2", "b3", "b4", "b5", "b6", "male"])
_BAND_SQL = ", ".join(
    f"cast(sum(case when l_linenumber {test} then cast(l_quantity as integer) else 0 end) as bigint) as {name}"
    for name, test in [("b1", "= 1"), ("b2", "= 2"), ("b3", "= 3"), ("b4", "= 4"), ("b5", "= 5"), ("b6", ">= 6")]
)
_WIDE_SQL = """tot as Total_Population, b1 as Population_0_4, b2 as Population_5_17, b3 as Population_18_24,
  b4 as Population_25_44, b5 as Population_45_64, b6 as Population_65_plus, b1 + b2 as Population_Under_18,
  b3 + b4 as Population_18_54, b5 + b6 as Population_55_plus, male as Male_Population,
  tot - male as Female_Population"""
_CITY_ROWS, _EPA_CITY_ROWS = (", ".join(f"({n}, '{c}')" for n, c in enumerate(names)) for names in (CITIES, EPA_CITIES))

VIEWS = {
    "dim_fips": f"""
      select {_STATE} || {_COUNTY} as fips_code, {_STATE} as state_code, n_name as state_name,
             {_COUNTY} as county_code, c_name as county_name
      from customer join nation on c_nationkey = n_nationkey where c_custkey % 50 <> 7""",
    "gdp_raw": f"""
      select {_STATE} || {_COUNTY} as fips_code, cast(year(o_orderdate) as varchar) || '-01-01' as observation_date,
             cast(round(sum(cast(o_totalprice as decimal(18, 2)))) as bigint) as gdp_value
      from orders join customer on o_custkey = c_custkey
      group by c_nationkey, c_custkey, year(o_orderdate)""",
    "population_base": f"""
      select c_nationkey as nk, c_custkey as ck, c_name as location, cast(year(o_orderdate) as integer) as yr,
             cast(sum(cast(l_quantity as integer)) as bigint) as tot, {_BAND_SQL},
             cast(sum(case when l_linestatus = 'O' then cast(l_quantity as integer) else 0 end) as bigint) as male
      from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
      group by c_nationkey, c_custkey, c_name, year(o_orderdate)""",
    "population_rows": f"""
      select cast((cast(nk as bigint) + 1) * {COUNTY_BASE} + ck + 1 as varchar) as id, location, yr,
             tot, b1, b2, b3, b4, b5, b6, male from population_base
      union all
      select cast((cast(nk as bigint) + 1) * {COUNTY_BASE} as varchar), n_name, yr, {_POPULATION_SUMS}
      from population_base join nation on nk = n_nationkey group by nk, n_name, yr
      union all
      select '0', 'U.S.', yr, {_POPULATION_SUMS} from population_base group by yr""",
    "population_raw": f"""
      select id as IBRC_Geo_ID, location as Description, yr as Year, {_WIDE_SQL} from population_rows""",
    "cities": f"select * from (values {_CITY_ROWS}) as t(city_id, city_name)",
    "epa_cities": f"select * from (values {_EPA_CITY_ROWS}) as t(city_id, city_name)",
    "aqi_obs": """
      select event_id, ts, cast(cast(ts as date) as varchar) as DateObserved, cast(hour(ts) as integer) as HourObserved,
             event_type as ParameterName, cast(floor(value) as integer) as AQI, props as Category,
             city_name as TargetCity
      from events join cities on user_id % 13 = city_id""",
    "epa_obs": f"""
      select o_orderkey as obs_id, 'data/raw/' || city_name || '_' ||
             case when o_orderkey % 3 = 0 then 'PM2.5' when o_orderkey % 3 = 1 then 'Ozone' else 'NO2' end || '.json'
             as source_file,
             cast(city_id + 1 as varchar) as state_code, cast(o_custkey + 1 as varchar) as county_code,
             cast(year(o_orderdate) as integer) as year, o_totalprice as arithmetic_mean
      from orders join epa_cities on o_custkey % {len(EPA_CITIES)} = city_id""",
    "code_lines": f"""
      select '  ' || {_STATE} || lpad(cast(c_custkey % 1000 as varchar), 3, '0') || '    ' || c_name as value
      from customer""",
}
