"""Population tables: bronze from one wide file, gold from bronze."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import growth_percent, padded_key, percent_of
from panelspark.functions.keys import COUNTY_WIDTH, STATE_WIDTH
from panelspark.operators.aggregates import first_value, last_value, mean_percent
from panelspark.operators.filters import exclude_values, require_not_null, split_by_flag
from panelspark.operators.joins import join_dimension
from panelspark.operators.project import rename, select_renamed
from panelspark.plans import panel

PANEL = panel.Panel(measure="total_population")

# Fixed value: the identifier of the nation row.
NATION_ID = "0"

BANDS = ["pop_0_4", "pop_5_17", "pop_18_24", "pop_25_44", "pop_45_64", "pop_65_plus"]
SEXES = ["male_population", "female_population"]

# Measure columns of the wide file under their bronze names.
MEASURES = {
    "Year": "year",
    "Total_Population": "total_population",
    "Population_0_4": "pop_0_4",
    "Population_5_17": "pop_5_17",
    "Population_18_24": "pop_18_24",
    "Population_25_44": "pop_25_44",
    "Population_45_64": "pop_45_64",
    "Population_65_plus": "pop_65_plus",
    "Population_Under_18": "pop_under_18",
    "Population_18_54": "pop_18_54",
    "Population_55_plus": "pop_55_plus",
    "Male_Population": "male_population",
    "Female_Population": "female_population",
}

RATIOS = ["dependency_ratio", "elderly_ratio", "youth_ratio", "pct_male", "pct_female"]


def with_place_codes(
    raw: DataFrame, state_width: int = STATE_WIDTH, county_width: int = COUNTY_WIDTH
) -> DataFrame:
    """Rows below the nation, with their padded code, its two parts and the level."""
    code = padded_key(F.col("IBRC_Geo_ID"), state_width + county_width)
    county = F.substring("fips_code", state_width + 1, county_width)
    return (
        exclude_values(raw, "IBRC_Geo_ID", [NATION_ID])
        .withColumn("fips_code", code)
        .withColumns(
            {
                "is_state_level": F.coalesce(county == "0" * county_width, F.lit(False)),
                "state_code": F.substring("fips_code", 1, state_width),
                "county_code": county,
            }
        )
    )


def bronze_county(coded: DataFrame) -> DataFrame:
    _, counties = split_by_flag(coded, "is_state_level")
    keys = {"fips_code": "fips_code", "state_code": "state_code", "county_code": "county_code"}
    return select_renamed(counties, keys | {"Description": "location_name"} | MEASURES)


def bronze_state(coded: DataFrame) -> DataFrame:
    states, _ = split_by_flag(coded, "is_state_level")
    return select_renamed(states, {"state_code": "state_code", "Description": "state_name"} | MEASURES)


def clean(bronze: DataFrame, dimension: DataFrame) -> DataFrame:
    """County rows with a key, a year and a total, and the names of their county."""
    known = require_not_null(bronze, ["fips_code", "year", "total_population"])
    counts = ["total_population", *BANDS, *SEXES]
    widened = known.select("fips_code", "state_code", "year", *[F.col(c).cast("long").alias(c) for c in counts])
    return join_dimension(widened, dimension.select("fips_code", "state_name", "county_name"))


def by_year(population: DataFrame) -> DataFrame:
    return population.select(*PANEL.keys, "year", "total_population", *SEXES, *BANDS)


def _total(*columns: str) -> Column:
    total = F.col(columns[0])
    for column in columns[1:]:
        total = total + F.col(column)
    return total


def shares(total: str = "total_population") -> dict[str, Column]:
    """Share of each age band and sex in the total."""
    parts = {band.replace("pop_", "pct_"): band for band in BANDS}
    parts |= {"pct_male": "male_population", "pct_female": "female_population"}
    return {name: percent_of(F.col(part), F.col(total)) for name, part in parts.items()}


def ratios() -> dict[str, Column]:
    """Working-age population and the dependency, elderly and youth ratios."""
    working_age = _total("pop_18_24", "pop_25_44", "pop_45_64")
    return {
        "working_age_population": working_age,
        "dependency_ratio": percent_of(_total("pop_0_4", "pop_5_17", "pop_65_plus"), working_age),
        "elderly_ratio": percent_of(F.col("pop_65_plus"), F.col("total_population")),
        "youth_ratio": percent_of(_total("pop_0_4", "pop_5_17"), F.col("total_population")),
    }


def sequence(population: DataFrame, sliced: bool = False) -> DataFrame:
    """By-year rows with growth, decline, shares and ratios: what the next tables are made of."""
    growth = panel.sequence(population, PANEL, "prev_year_population", "decline_pct", sliced)
    change = (F.col("total_population") - F.col("prev_year_population")).cast("int")
    return growth.withColumns({"yoy_growth_absolute": change} | shares() | ratios())


def with_growth(rows: DataFrame) -> DataFrame:
    """The growth table, from ``sequence`` rows."""
    return rows.select(
        *PANEL.keys,
        "year",
        "total_population",
        *SEXES,
        "working_age_population",
        "prev_year_population",
        "yoy_growth_rate",
        "yoy_growth_absolute",
        *shares(),
        "dependency_ratio",
        "elderly_ratio",
        "youth_ratio",
    )


def county_summary(rows: DataFrame) -> DataFrame:
    """One row per county, from ``sequence`` rows."""
    extra = {
        "first": first_value("year", "total_population"),
        "last": last_value("year", "total_population"),
    } | {f"avg_{ratio}": mean_percent(ratio) for ratio in RATIOS}
    first, last = F.col("first.total_population"), F.col("last.total_population")
    return panel.entity_summary(rows, PANEL, extra, "decline_pct").select(
        *PANEL.keys,
        F.col("first.year").alias("first_year"),
        first.alias("first_year_population"),
        F.col("last.year").alias("last_year"),
        last.alias("last_year_population"),
        growth_percent(last, first).alias("total_growth_pct"),
        F.col("mean_growth").alias("average_yoy_growth"),
        F.col("highest.yoy_growth_rate").alias("max_yoy_growth"),
        F.col("highest.year").alias("max_yoy_year"),
        F.col("lowest.yoy_growth_rate").alias("min_yoy_growth"),
        F.col("lowest.year").alias("min_yoy_year"),
        F.col("deepest.decline_pct").alias("maximum_decline"),
        F.col("deepest.year").alias("maximum_decline_year"),
        *[f"avg_{ratio}" for ratio in RATIOS],
    )


def state_summary(growth: DataFrame) -> DataFrame:
    """One row per state, from the growth table."""
    return panel.group_summary(growth, PANEL).select(
        *PANEL.groups,
        F.col("entities").alias("num_counties"),
        F.col("first_period").alias("first_year"),
        F.col("last_period").alias("last_year"),
        F.col("mean_growth").alias("avg_county_yoy_growth"),
        F.col("top_growth").alias("max_county_yoy_growth"),
        F.col("low_growth").alias("min_county_yoy_growth"),
        F.col("best.county_name").alias("fastest_growing_county"),
        F.col("best.avg_growth").alias("fastest_growth_rate"),
        F.col("worst.county_name").alias("slowest_growing_county"),
        F.col("worst.avg_growth").alias("slowest_growth_rate"),
    )


def state_totals() -> dict[str, Column]:
    """Sums over the counties of a state and year, named as the county columns."""
    return {f"sum_{c}": F.sum(c) for c in ["total_population", *SEXES, *BANDS]}


def rollup_shares() -> dict[str, Column]:
    """Shares of the summed population."""
    total = F.col("sum_total_population")
    working_age = _total("sum_pop_18_24", "sum_pop_25_44", "sum_pop_45_64")
    return {
        "pct_male": percent_of(F.col("sum_male_population"), total),
        "pct_female": percent_of(F.col("sum_female_population"), total),
        "pct_elderly": percent_of(F.col("sum_pop_65_plus"), total),
        "pct_working_age": percent_of(working_age, total),
    }


def by_state_by_year(population: DataFrame) -> DataFrame:
    """One row per state and year, from the by-year table."""
    return panel.group_period_extremes(population, PANEL, state_totals()).select(
        "state_name",
        "state_code",
        "year",
        F.col("entities").alias("number_of_counties"),
        F.col("sum_total_population").alias("total_population"),
        *[share.alias(name) for name, share in rollup_shares().items()],
        F.col("best.county_name").alias("largest_county"),
        F.col("best.total_population").alias("largest_county_population"),
        F.col("worst.county_name").alias("smallest_county"),
        F.col("worst.total_population").alias("smallest_county_population"),
    )


def broad_bands(bronze: DataFrame) -> DataFrame:
    """The published table with four age bands."""
    wide = bronze.withColumn("population_18_64", _total("pop_18_24", "pop_25_44", "pop_45_64"))
    published = rename(
        wide,
        {"pop_0_4": "population_0_4", "pop_5_17": "population_5_17", "pop_65_plus": "population_65_plus"},
    )
    order = ["fips_code", "year", "total_population", *SEXES, "population_0_4", "population_5_17"]
    order += ["population_18_64", "population_65_plus"]
    return published.select([F.col(c).alias(c.upper()) for c in order])
