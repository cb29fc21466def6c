from panelspark.functions.keys import (
    before_comma,
    city_and_pollutant,
    decoded_file_name,
    entity_key_from_file,
    file_base_name,
    geo_key,
    padded_key,
)
from panelspark.functions.rounding import growth_percent, hundredths, mean_of_hundredths, percent_of

__all__ = [
    "before_comma",
    "city_and_pollutant",
    "decoded_file_name",
    "entity_key_from_file",
    "file_base_name",
    "geo_key",
    "growth_percent",
    "hundredths",
    "mean_of_hundredths",
    "padded_key",
    "percent_of",
]
