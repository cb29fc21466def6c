"""Air-quality tables: consolidated history, yearly means, observation history and snapshot."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark import schemas
from panelspark.functions import city_and_pollutant, decoded_file_name, geo_key
from panelspark.functions.keys import COUNTY_WIDTH, STATE_WIDTH
from panelspark.operators.aggregates import exact_mean
from panelspark.operators.filters import coerce_numeric, keep_values, require_not_null
from panelspark.operators.project import flatten_struct, normalize_names, normalize_to_schema, select_renamed
from panelspark.session import written

# The cities whose history is kept, as their names stand in the records.
MAIN_CITIES = [
    "New York",
    "Washington",
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

TIDY_COLUMNS = {
    "city": "City",
    "year": "Year",
    "parameter": "Pollutant",
    "arithmetic_mean": "Value",
    "state": "state",
    "county": "county",
}

SNAPSHOT_COLUMNS = {"TARGETCITY": "CITY", "PARAMETERNAME": "POLLUTANT_TYPE", "AQI": "VALUE"}
BATCH_COLUMNS = ["DATEOBSERVED", "HOUROBSERVED"]


def consolidate(
    records: DataFrame, source: str = "source_file", state_width: int = STATE_WIDTH, county_width: int = COUNTY_WIDTH
) -> DataFrame:
    """Records with the city and pollutant of their file name and a place code."""
    city, pollutant = city_and_pollutant(decoded_file_name(F.col(source)))
    place = geo_key(F.col("state_code"), F.col("county_code"), state_width, county_width)
    return records.withColumns({"city": city, "pollutant": pollutant, "GeoFips": place}).drop(source)


def tidy(records: DataFrame, cities: Sequence[str] = MAIN_CITIES) -> DataFrame:
    """City, year, pollutant and value of the listed cities, incomplete rows dropped."""
    named = require_not_null(select_renamed(records, TIDY_COLUMNS), ["City", "Value"])
    return keep_values(named, "City", cities)


def yearly_mean(records: DataFrame, keys: Sequence[str], value: str = "arithmetic_mean") -> DataFrame:
    """Mean per keys over the rows whose year and value are numbers."""
    numeric = coerce_numeric(records, [value, "year"])
    return numeric.groupBy(*keys, F.col("year").cast("int").alias("year")).agg(exact_mean(value).alias(value))


def flatten_observations(raw: DataFrame) -> DataFrame:
    """Observation rows under the names of the history table; batch and stream alike."""
    upper = normalize_names(raw)
    return flatten_struct(upper, "CATEGORY", {"Name": "CATEGORY_NAME", "Number": "CATEGORY_NUM"})


def history_rows(raw: DataFrame) -> DataFrame:
    """Observation rows with exactly the columns of the history table."""
    return normalize_to_schema(flatten_observations(raw), schemas.AQI_HISTORY)


def snapshot_rows(history: DataFrame) -> DataFrame:
    """City, pollutant and value of every row."""
    return select_renamed(history, SNAPSHOT_COLUMNS)


def last_batch(history: DataFrame) -> DataFrame:
    """The rows of the latest (date, hour)."""
    latest = history.agg(F.max(F.struct(*BATCH_COLUMNS)).alias("latest")).select("latest.*")
    return history.join(F.broadcast(latest), BATCH_COLUMNS, "left_semi")  # one row


def latest_value(order: Sequence[str]) -> Column:
    """The value of the latest row by the order columns; of rows that are equal in them, the highest."""
    return F.max_by("AQI", F.struct(*order, "AQI"))


def latest_per_key(history: DataFrame, order: Sequence[str]) -> DataFrame:
    """The latest value of every city and pollutant, by the order columns.

    Rows pass a hash aggregation of the first order column; its result, one row per
    city and pollutant, is written, and only the rows at that point are compared further.
    """
    keys = ["TARGETCITY", "PARAMETERNAME"]
    rows = history.select(*keys, *order, "AQI")
    newest = written(rows.groupBy(*keys).agg(F.max(order[0]).alias("newest")))
    same = [F.col(f"rows.{k}").eqNullSafe(F.col(f"newest.{k}")) for k in keys]
    same.append(F.col(f"rows.{order[0]}").eqNullSafe(F.col("newest.newest")))
    return (
        rows.alias("rows")
        .join(newest.alias("newest"), same)
        .groupBy(*[F.col(f"rows.{k}").alias(k) for k in keys])
        .agg(latest_value(order[1:]).alias("AQI"))
    )
