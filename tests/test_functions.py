from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark import functions as P


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row[0] if len(columns) == 1 else row


def test_growth_of_a_zero_base_is_null(spark):
    assert one(spark, g=P.growth_percent(F.lit(5).cast("long"), F.lit(0).cast("long"))) is None


@pytest.mark.parametrize(
    "value, base, expected",
    [(110, 100, 10.0), (801, 800, 0.13), (799, 800, -0.13), (1, 3, -66.67), (-50, -100, -50.0), (7, 7, 0.0)],
)
def test_growth_rounds_half_up(spark, value, base, expected):
    assert one(spark, g=P.growth_percent(F.lit(value).cast("long"), F.lit(base).cast("long"))) == expected


def test_mean_is_exact_for_any_split_of_the_rows(spark):
    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.integers(-100_000, 100_000), min_size=1, max_size=40))
    def check(numbers):
        df = spark.createDataFrame([(n / 100,) for n in numbers], "g double").repartition(3)
        found = df.agg(P.mean_of_hundredths(F.sum(P.hundredths(F.col("g"))), F.count("g"))).first()[0]
        exact = Decimal(sum(numbers)) / len(numbers) / 100
        assert found == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))

    check()


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "g double")
    assert df.agg(P.mean_of_hundredths(F.sum(P.hundredths(F.col("g"))), F.count("g"))).first()[0] is None


def test_entity_key_from_file(spark):
    found = one(
        spark,
        a=P.entity_key_from_file(F.lit("file:///data/gdpall01001.csv")),
        b=P.entity_key_from_file(F.lit("file:///data/gdpall1001.csv")),
    )
    assert tuple(found) == ("01001", "")


def test_city_and_pollutant_split_at_the_last_underscore(spark):
    city, pollutant = P.city_and_pollutant(F.lit("Salt_Lake_PM2.5.json"))
    assert tuple(one(spark, a=city, b=pollutant)) == ("Salt_Lake", "PM2.5")


def test_decoded_file_name_keeps_plus_and_blank(spark):
    found = one(
        spark,
        a=P.decoded_file_name(F.lit("file:/raw/Washington%20D.C._NO2.json")),
        b=P.decoded_file_name(F.lit("file:/raw/A+B_NO2.json")),
        c=P.decoded_file_name(F.lit("file:/raw/Washington D.C._NO2.json")),
    )
    assert tuple(found) == ("Washington D.C._NO2.json", "A+B_NO2.json", "Washington D.C._NO2.json")


def test_keys_are_padded_and_cut(spark):
    found = one(spark, a=P.padded_key(F.lit("1001"), 5), b=P.padded_key(F.lit("1234567"), 5))
    assert tuple(found) == ("01001", "12345")


def test_geo_key_and_name_before_comma(spark):
    found = one(spark, a=P.geo_key(F.lit("6"), F.lit("37")), b=P.before_comma(F.lit(" Autauga County , Alabama, US")))
    assert tuple(found) == ("06037", "Autauga County")
