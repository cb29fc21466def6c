"""Keys cut out of identifiers and file names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Widths of the two parts of a place code, and the file name patterns.
STATE_WIDTH = 2
COUNTY_WIDTH = 3
ENTITY_FILE_PATTERN = r"gdpall(\d{5})\.csv"
CITY_FILE_PATTERN = r"^(.*?)_([^_]+)\.json$"
CODE_LINE_PATTERN = r"^\s*(\d{5})\s+(.+)$"


def file_base_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.substring_index(path, "/", -1)


def decoded_file_name(path: Column) -> Column:
    """Base name with %XX escapes resolved; a plus sign and a name without escapes stay as they are."""
    name = file_base_name(path)
    decoded = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), F.coalesce(decoded, name)).otherwise(name)


def entity_key_from_file(path: Column, pattern: str = ENTITY_FILE_PATTERN) -> Column:
    """First group of the pattern in the file name, "" where it does not match."""
    return F.regexp_extract(path, pattern, 1)


def city_and_pollutant(file_name: Column) -> tuple[Column, Column]:
    """The two parts of ``<city>_<pollutant>.json``, split at the last underscore."""
    return (
        F.regexp_extract(file_name, CITY_FILE_PATTERN, 1),
        F.regexp_extract(file_name, CITY_FILE_PATTERN, 2),
    )


def padded_key(identifier: Column, width: int) -> Column:
    """Left pad with zeros; a longer identifier is cut to the width."""
    return F.lpad(identifier, width, "0")


def geo_key(
    state: Column, county: Column, state_width: int = STATE_WIDTH, county_width: int = COUNTY_WIDTH
) -> Column:
    """Place code made of a padded state and a padded county part."""
    return F.concat(padded_key(state, state_width), padded_key(county, county_width))


def before_comma(text: Column) -> Column:
    """Text up to the first comma, blanks trimmed."""
    return F.trim(F.substring_index(text, ",", 1))
