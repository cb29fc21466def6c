"""GDP tables: bronze from per-county series, gold from bronze."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.filters import exclude_values, require_not_null
from panelspark.operators.joins import join_dimension
from panelspark.plans import panel

# Fixed value: the code left out of the GDP tables.
EXCLUDED_CODES = ("02261",)

PANEL = panel.Panel(measure="gdp_value")


def bronze(raw: DataFrame, dimension: DataFrame, excluded: Iterable[str] = EXCLUDED_CODES) -> DataFrame:
    """Series rows (fips_code, observation_date, gdp_value) with the names of their county."""
    keyed = exclude_values(raw, "fips_code", ["", *excluded])
    return join_dimension(keyed, dimension).select(
        "fips_code",
        "state_code",
        "state_name",
        "county_code",
        "county_name",
        F.col("observation_date").alias("date"),
        "gdp_value",
    )


def clean(bronze_gdp: DataFrame, excluded: Iterable[str] = EXCLUDED_CODES) -> DataFrame:
    """Bronze rows with a date, its year and a value."""
    dated = (
        exclude_values(bronze_gdp, "fips_code", excluded)
        .withColumn("date", F.col("date").try_cast("date"))
        .withColumn("year", F.year("date"))
        .withColumn("gdp_value", F.col("gdp_value").cast("long"))
    )
    return require_not_null(dated, ["fips_code", "date", "gdp_value"])


def by_year(gdp: DataFrame) -> DataFrame:
    return gdp.select(*PANEL.keys, "year", "date", "gdp_value")


def sequence(gdp: DataFrame, sliced: bool = False) -> DataFrame:
    """By-year rows with the previous value, growth and drawdown: what the next tables are made of."""
    rows = gdp.select(*PANEL.keys, "year", "gdp_value")
    return panel.sequence(rows, PANEL, "prev_year_gdp", sliced=sliced)


def with_growth(rows: DataFrame) -> DataFrame:
    """The growth table, from ``sequence`` rows."""
    return rows.select(*PANEL.keys, "year", "gdp_value", "prev_year_gdp", "yoy_growth_rate")


def county_summary(rows: DataFrame) -> DataFrame:
    """One row per county, from ``sequence`` rows."""
    extra = {"first_year": F.min("year"), "last_year": F.max("year"), "years_of_data": F.count("*")}
    return panel.entity_summary(rows, PANEL, extra).select(
        *PANEL.keys,
        "first_year",
        "last_year",
        "years_of_data",
        F.col("mean_growth").alias("average_yoy"),
        F.col("highest.yoy_growth_rate").alias("max_yoy"),
        F.col("highest.year").alias("max_yoy_year"),
        F.col("lowest.yoy_growth_rate").alias("min_yoy"),
        F.col("lowest.year").alias("min_yoy_year"),
        F.col("deepest.drawdown_pct").alias("maximum_draw_down"),
        F.col("deepest.year").alias("maximum_draw_down_year"),
    )


def state_summary(growth: DataFrame) -> DataFrame:
    """One row per state, from the growth table."""
    return panel.group_summary(growth, PANEL).select(
        *PANEL.groups,
        F.col("entities").alias("num_counties"),
        F.col("first_period").alias("first_year"),
        F.col("last_period").alias("last_year"),
        F.col("mean_growth").alias("avg_county_yoy"),
        F.col("top_growth").alias("max_county_yoy"),
        F.col("low_growth").alias("min_county_yoy"),
        F.col("best.county_name").alias("best_perform_county"),
        F.col("best.avg_growth").alias("best_perform_avg_yoy"),
        F.col("worst.county_name").alias("least_perform_county"),
        F.col("worst.avg_growth").alias("least_perform_avg_yoy"),
    )


def by_state_by_year(gdp: DataFrame) -> DataFrame:
    """One row per state and year, from the by-year table."""
    return panel.group_period_extremes(gdp, PANEL, {"total_gdp": F.sum("gdp_value")}).select(
        "state_name",
        "state_code",
        "year",
        F.col("entities").alias("number_of_county"),
        "total_gdp",
        F.col("best.county_name").alias("best_perform_county"),
        F.col("best.gdp_value").alias("best_perform_county_gdp"),
        F.col("worst.county_name").alias("least_perform_county"),
        F.col("worst.gdp_value").alias("least_perform_county_gdp"),
    )
