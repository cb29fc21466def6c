"""Table contracts: column names and types, fixed so that no scan infers a schema.

Each contract is a DDL text, which readers and table definitions take as it is.
"""


# Raw inputs.
GDP_RAW = "observation_date string, gdp_value int"
DIMENSION = "fips_code string, state_code string, state_name string, county_name string, county_code string"
POPULATION_RAW = (
    "IBRC_Geo_ID string, Statefips string, Countyfips string, Description string, Year int, Total_Population int, "
    "Population_0_4 int, Population_5_17 int, Population_18_24 int, Population_25_44 int, Population_45_64 int, "
    "Population_65_plus int, Population_Under_18 int, Population_18_54 int, Population_55_plus int, "
    "Male_Population int, Female_Population int"
)
AQI_OBSERVATION = (
    "DateObserved string, HourObserved int, LocalTimeZone string, ReportingArea string, StateCode string, "
    "Latitude double, Longitude double, ParameterName string, AQI int, "
    "Category struct<Number: int, Name: string>, TargetCity string"
)
EPA_RECORD = (
    "state_code string, county_code string, year int, arithmetic_mean double, city string, parameter string, "
    "state string, county string"
)

# Bronze.
BRONZE_GDP = (
    "fips_code string, state_name string, county_code string, county_name string, date string, gdp_value int, "
    "state_code string"
)
_BANDS = (
    "pop_0_4 int, pop_5_17 int, pop_18_24 int, pop_25_44 int, pop_45_64 int, pop_65_plus int, pop_under_18 int, "
    "pop_18_54 int, pop_55_plus int, male_population int, female_population int"
)
BRONZE_POPULATION_COUNTY = (
    f"fips_code string, county_code string, location_name string, year int, total_population int, {_BANDS}, "
    "state_code string"
)
BRONZE_POPULATION_STATE = f"state_name string, year int, total_population int, {_BANDS}, state_code string"

# Gold and warehouse.
GDP_BY_YEAR = (
    "state_code string, state_name string, fips_code string, county_name string, year int, date date, gdp_value bigint"
)
GDP_WITH_GROWTH = (
    "state_code string, state_name string, fips_code string, county_name string, year int, gdp_value bigint, "
    "prev_year_gdp bigint, yoy_growth_rate double"
)
GDP_COUNTY_SUMMARY = (
    "state_code string, state_name string, fips_code string, county_name string, first_year int, last_year int, "
    "years_of_data bigint, average_yoy double, max_yoy double, max_yoy_year int, min_yoy double, min_yoy_year int, "
    "maximum_draw_down double, maximum_draw_down_year int"
)
GDP_STATE_SUMMARY = (
    "state_code string, state_name string, num_counties bigint, first_year int, last_year int, "
    "avg_county_yoy double, max_county_yoy double, min_county_yoy double, best_perform_county string, "
    "best_perform_avg_yoy double, least_perform_county string, least_perform_avg_yoy double"
)
GDP_BY_STATE_BY_YEAR = (
    "state_name string, state_code string, year int, number_of_county bigint, total_gdp bigint, "
    "best_perform_county string, best_perform_county_gdp bigint, least_perform_county string, "
    "least_perform_county_gdp bigint"
)
POPULATION_BY_YEAR = (
    "state_code string, state_name string, fips_code string, county_name string, year int, total_population bigint, "
    "male_population bigint, female_population bigint, pop_0_4 bigint, pop_5_17 bigint, pop_18_24 bigint, "
    "pop_25_44 bigint, pop_45_64 bigint, pop_65_plus bigint"
)
POPULATION_WITH_GROWTH = (
    "state_code string, state_name string, fips_code string, county_name string, year int, total_population bigint, "
    "male_population bigint, female_population bigint, working_age_population bigint, prev_year_population bigint, "
    "yoy_growth_rate double, yoy_growth_absolute int, pct_0_4 double, pct_5_17 double, pct_18_24 double, "
    "pct_25_44 double, pct_45_64 double, pct_65_plus double, pct_male double, pct_female double, "
    "dependency_ratio double, elderly_ratio double, youth_ratio double"
)
POPULATION_COUNTY_SUMMARY = (
    "state_code string, state_name string, fips_code string, county_name string, first_year int, "
    "first_year_population bigint, last_year int, last_year_population bigint, total_growth_pct double, "
    "average_yoy_growth double, max_yoy_growth double, max_yoy_year int, min_yoy_growth double, min_yoy_year int, "
    "maximum_decline double, maximum_decline_year int, avg_dependency_ratio double, avg_elderly_ratio double, "
    "avg_youth_ratio double, avg_pct_male double, avg_pct_female double"
)
POPULATION_STATE_SUMMARY = (
    "state_code string, state_name string, num_counties bigint, first_year int, last_year int, "
    "avg_county_yoy_growth double, max_county_yoy_growth double, min_county_yoy_growth double, "
    "fastest_growing_county string, fastest_growth_rate double, slowest_growing_county string, "
    "slowest_growth_rate double"
)
POPULATION_BY_STATE_BY_YEAR = (
    "state_name string, state_code string, year int, number_of_counties bigint, total_population bigint, "
    "pct_male double, pct_female double, pct_elderly double, pct_working_age double, largest_county string, "
    "largest_county_population bigint, smallest_county string, smallest_county_population bigint"
)
POPULATION_DATA = (
    "FIPS_CODE string, YEAR int, TOTAL_POPULATION bigint, MALE_POPULATION bigint, FEMALE_POPULATION bigint, "
    "POPULATION_0_4 bigint, POPULATION_5_17 bigint, POPULATION_18_64 bigint, POPULATION_65_PLUS bigint"
)
AQI_HISTORY = (
    "DATEOBSERVED string, HOUROBSERVED int, LOCALTIMEZONE string, REPORTINGAREA string, STATECODE string, "
    "LATITUDE double, LONGITUDE double, PARAMETERNAME string, AQI int, CATEGORY_NAME string, CATEGORY_NUM int, "
    "TARGETCITY string"
)
AQI_SNAPSHOT = "CITY string, POLLUTANT_TYPE string, VALUE int"

#: Gold tables by name, as published.
GOLD = {
    "gdp_by_year": GDP_BY_YEAR,
    "gdp_with_growth": GDP_WITH_GROWTH,
    "gdp_county_summary": GDP_COUNTY_SUMMARY,
    "gdp_state_summary": GDP_STATE_SUMMARY,
    "gdp_by_state_by_year": GDP_BY_STATE_BY_YEAR,
    "population_by_year": POPULATION_BY_YEAR,
    "population_with_growth": POPULATION_WITH_GROWTH,
    "population_county_summary": POPULATION_COUNTY_SUMMARY,
    "population_state_summary": POPULATION_STATE_SUMMARY,
    "population_by_state_by_year": POPULATION_BY_STATE_BY_YEAR,
}
