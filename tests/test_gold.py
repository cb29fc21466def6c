"""Gold tables on hand-made rows: gaps, ties, zero bases, unmapped keys, rounding."""

import pytest
from pyspark.sql import functions as F

from panelspark.plans import gdp, population

DIM = [
    ("01001", "01", "Alabama", "Autauga County", "001"),
    ("01003", "01", "Alabama", "Baldwin County", "003"),
    ("02020", "02", "Alaska", "Anchorage", "020"),
]
DIM_DDL = "fips_code string, state_code string, state_name string, county_name string, county_code string"


def series(code, values):
    return [(code, f"{year}-01-01", value) for year, value in values.items()]


@pytest.fixture()
def by_year(spark):
    raw = (
        series("01001", {2001: 100, 2002: 110, 2004: 55, 2005: 110})  # gap year, 100 % twice over
        + series("01003", {2001: 100, 2002: 200, 2003: 400})  # growth only, tied at 100 %
        + series("02020", {2001: 0, 2002: 50, 2003: None, 2004: 49})  # zero base, missing value
        + series("99999", {2001: 10, 2002: 20, 2003: 15})  # unmapped
        + series("02261", {2001: 1, 2002: 2})  # left out
        + series("", {2001: 1})
        + [("01001", ".", 5), ("01001", None, 6)]  # no date
    )
    facts = spark.createDataFrame(raw, "fips_code string, observation_date string, gdp_value int")
    return gdp.clean(gdp.bronze(facts, spark.createDataFrame(DIM, DIM_DDL)))


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_by_year_drops_incomplete_and_excluded_rows(by_year):
    codes = {r.fips_code: r["n"] for r in gdp.by_year(by_year).groupBy("fips_code").agg(F.count("*").alias("n")).collect()}
    assert codes == {"01001": 4, "01003": 3, "02020": 3, "99999": 3}


def test_growth_spans_gap_years_and_zero_bases(by_year):
    growth = by_key(gdp.with_growth(gdp.sequence(by_year)), "fips_code", "year")
    assert growth["01001", 2004]["prev_year_gdp"] == 110
    assert growth["01001", 2004]["yoy_growth_rate"] == -50.0
    assert growth["02020", 2002]["yoy_growth_rate"] is None
    assert growth["02020", 2004]["prev_year_gdp"] == 50
    assert growth["02020", 2004]["yoy_growth_rate"] == -2.0


def test_county_summary(by_year):
    county = by_key(gdp.county_summary(gdp.sequence(by_year)), "fips_code")
    a = county[("01001",)]
    assert (a["first_year"], a["last_year"], a["years_of_data"]) == (2001, 2005, 4)
    assert (a["average_yoy"], a["max_yoy"], a["max_yoy_year"]) == (20.0, 100.0, 2005)
    assert (a["min_yoy"], a["min_yoy_year"]) == (-50.0, 2004)
    assert (a["maximum_draw_down"], a["maximum_draw_down_year"]) == (-50.0, 2004)
    b = county[("01003",)]
    assert (b["max_yoy"], b["max_yoy_year"], b["min_yoy_year"]) == (100.0, 2003, 2002)  # ties: latest, earliest
    assert b["maximum_draw_down"] is None and b["maximum_draw_down_year"] is None


def test_unmapped_county_keeps_its_metrics(by_year):
    county = by_key(gdp.county_summary(gdp.sequence(by_year)), "fips_code")[("99999",)]
    assert county["state_code"] is None and county["county_name"] is None
    assert (county["average_yoy"], county["maximum_draw_down"]) == (37.5, -25.0)


def test_small_dips_vanish_with_rounding(spark):
    rows = [("01001", "2001-01-01", 1_000_000), ("01001", "2002-01-01", 999_960), ("01001", "2003-01-01", 999_940)]
    facts = spark.createDataFrame(rows, "fips_code string, observation_date string, gdp_value int")
    panel = gdp.clean(gdp.bronze(facts, spark.createDataFrame(DIM, DIM_DDL)))
    row = gdp.county_summary(gdp.sequence(panel)).first()
    assert (row.maximum_draw_down, row.maximum_draw_down_year) == (-0.01, 2003)


def test_state_summary(by_year):
    state = by_key(gdp.state_summary(gdp.sequence(by_year)), "state_code")
    s = state[("01",)]
    assert (s["num_counties"], s["first_year"], s["last_year"]) == (2, 2001, 2005)
    # five county-years of growth: 10, -50, 100, 100, 100
    assert (s["avg_county_yoy"], s["max_county_yoy"], s["min_county_yoy"]) == (52.0, 100.0, -50.0)
    assert (s["best_perform_county"], s["best_perform_avg_yoy"]) == ("Baldwin County", 100.0)
    assert (s["least_perform_county"], s["least_perform_avg_yoy"]) == ("Autauga County", 20.0)
    unknown = state[(None,)]
    assert unknown["num_counties"] == 1 and unknown["best_perform_county"] is None


def test_by_state_by_year(by_year):
    table = by_key(gdp.by_state_by_year(gdp.by_year(by_year)), "state_code", "year")
    row = table["01", 2001]  # both counties at 100: the smaller code wins both ways
    assert (row["number_of_county"], row["total_gdp"]) == (2, 200)
    assert (row["best_perform_county"], row["least_perform_county"]) == ("Autauga County", "Autauga County")
    assert table["01", 2002]["best_perform_county"] == "Baldwin County"
    assert table["01", 2002]["least_perform_county_gdp"] == 110
    assert table[None, 2001]["total_gdp"] == 10 and table[None, 2001]["best_perform_county"] is None


def test_extremes_when_nothing_can_be_broadcast(spark, by_year, rows):
    expected = rows(gdp.by_state_by_year(gdp.by_year(by_year)))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows(gdp.by_state_by_year(gdp.by_year(by_year))) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_county_split_gives_the_same_tables(spark, by_year, rows):
    plain = gdp.sequence(by_year)
    split = gdp.sequence(by_year, sliced=True)
    assert rows(gdp.county_summary(split)) == rows(gdp.county_summary(plain))
    assert rows(gdp.with_growth(split)) == rows(gdp.with_growth(plain))


# --- population ------------------------------------------------------------


def person_row(identifier, year, bands, male):
    total = sum(bands)
    under, mid, over = bands[0] + bands[1], bands[2] + bands[3], bands[4] + bands[5]
    return (identifier, None, None, f"Place {identifier}", year, total, *bands, under, mid, over, male, total - male)


@pytest.fixture()
def coded(spark):
    from panelspark import schemas

    raw = [
        person_row("0", 2001, [9, 9, 9, 9, 9, 9], 20),
        person_row("1000", 2001, [8, 8, 8, 8, 8, 8], 20),
        person_row("1001", 2001, [10, 20, 10, 30, 20, 10], 40),
        person_row("1001", 2002, [10, 20, 10, 30, 20, 20], 50),
        person_row("1001", 2004, [10, 20, 10, 30, 20, 9], 50),
        person_row("1003", 2001, [1, 1, 0, 0, 0, 1], 2),  # nobody of working age
        (None, None, None, "no id", 2001, *[1] * 12),
        ("1005", None, None, "no total", 2001, None, *[1] * 11),
    ]
    return population.with_place_codes(spark.createDataFrame(raw, schemas.POPULATION_RAW))


def test_levels_and_keys(coded, rows):
    counties = population.bronze_county(coded)
    assert {r.fips_code for r in counties.collect()} == {"01001", "01003", "01005"}
    assert [(r.state_code, r.state_name) for r in population.bronze_state(coded).collect()] == [("01", "Place 1000")]


def test_population_growth_and_ratios(spark, coded):
    panel = population.clean(population.bronze_county(coded), spark.createDataFrame(DIM, DIM_DDL))
    growth = by_key(population.with_growth(population.sequence(panel)), "fips_code", "year")
    row = growth["01001", 2002]
    assert (row["yoy_growth_rate"], row["yoy_growth_absolute"], row["working_age_population"]) == (10.0, 10, 60)
    assert (row["pct_0_4"], row["pct_male"], row["youth_ratio"]) == (9.09, 45.45, 27.27)
    assert row["dependency_ratio"] == 83.33 and row["elderly_ratio"] == row["pct_65_plus"] == 18.18
    assert growth["01003", 2001]["dependency_ratio"] is None
    assert ("01005", 2001) not in growth


def test_population_summaries(spark, coded):
    panel = population.clean(population.bronze_county(coded), spark.createDataFrame(DIM, DIM_DDL))
    sequenced = population.sequence(panel)
    county = by_key(population.county_summary(sequenced), "fips_code")[("01001",)]
    assert (county["first_year_population"], county["last_year_population"], county["total_growth_pct"]) == (100, 99, -1.0)
    assert (county["average_yoy_growth"], county["maximum_decline"], county["maximum_decline_year"]) == (0.0, -10.0, 2004)
    assert county["avg_pct_male"] == 45.32  # 40.00, 45.45, 50.51
    state = population.state_summary(sequenced).first()
    assert (state.num_counties, state.fastest_growing_county, state.slowest_growing_county) == (
        2,
        "Autauga County",
        "Autauga County",
    )
    yearly = by_key(population.by_state_by_year(population.by_year(panel)), "year")[(2001,)]
    assert (yearly["total_population"], yearly["largest_county"], yearly["smallest_county"]) == (
        103,
        "Autauga County",
        "Baldwin County",
    )
    assert (yearly["pct_working_age"], yearly["pct_elderly"]) == (58.25, 10.68)


def test_broad_bands(coded):
    row = population.broad_bands(population.bronze_county(coded)).filter("FIPS_CODE = '01001' and YEAR = 2001").first()
    assert (row.POPULATION_18_64, row.POPULATION_65_PLUS, row.POPULATION_5_17) == (60, 10, 20)
    assert row.asDict().keys() == {
        "FIPS_CODE",
        "YEAR",
        "TOTAL_POPULATION",
        "MALE_POPULATION",
        "FEMALE_POPULATION",
        "POPULATION_0_4",
        "POPULATION_5_17",
        "POPULATION_18_64",
        "POPULATION_65_PLUS",
    }


def test_panel_invariants(spark):
    """On the whole test panel: shares, drawdowns, totals and keys hang together."""
    from panelspark.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    people = QUERIES["population_with_growth"](spark, sf)
    assert people.filter("male_population + female_population <> total_population").isEmpty()
    county = QUERIES["gdp_county_summary"](spark, sf)
    assert county.filter("maximum_draw_down >= 0 or first_year > last_year or max_yoy < min_yoy").isEmpty()
    assert county.groupBy("fips_code").count().filter("count > 1").isEmpty()
    by_state = QUERIES["gdp_by_state_by_year"](spark, sf).agg(F.sum("total_gdp")).first()[0]
    assert by_state == QUERIES["gdp_by_year"](spark, sf).agg(F.sum("gdp_value")).first()[0]
