"""Queries over the population panel."""

from pyspark.sql import functions as F

from panelspark.operators import aggregates as A
from panelspark.operators import quality
from panelspark.operators.filters import split_by_flag
from panelspark.functions import growth_percent
from panelspark.plans import population
from panelspark.queries.gdp import sql_pick
from panelspark.queries.registry import SQL_VIEWS, query, sql_mean, sql_percent
from panelspark.session import written
from panelspark.testtables import COUNTY_WIDTH, STATE_WIDTH, dim_fips, population_raw

KEYS = population.PANEL.keys
K = "state_code, state_name, fips_code, county_name"
WIDTH = STATE_WIDTH + COUNTY_WIDTH
SEXES = "male_population, female_population"
BANDS = ", ".join(population.BANDS)
WORKING = "pop_18_24 + pop_25_44 + pop_45_64"
MEASURES = ", ".join(f"{raw} as {name}" for raw, name in population.MEASURES.items())

SQL_VIEWS["pop_coded"] = f"""
    select *, lpad(IBRC_Geo_ID, {WIDTH}, '0') as fips_code,
           substr(lpad(IBRC_Geo_ID, {WIDTH}, '0'), {STATE_WIDTH + 1}, {COUNTY_WIDTH}) = '{"0" * COUNTY_WIDTH}'
             as is_state_level,
           substr(lpad(IBRC_Geo_ID, {WIDTH}, '0'), 1, {STATE_WIDTH}) as state_code,
           substr(lpad(IBRC_Geo_ID, {WIDTH}, '0'), {STATE_WIDTH + 1}, {COUNTY_WIDTH}) as county_code
    from population_raw where IBRC_Geo_ID <> '0'"""
SQL_VIEWS["pop_county"] = f"""
    select fips_code, state_code, county_code, Description as location_name, {MEASURES}
    from pop_coded where not is_state_level"""
SQL_VIEWS["pop_panel"] = f"""
    select p.state_code, d.state_name, p.fips_code, d.county_name, year, total_population, {SEXES}, {BANDS}
    from pop_county as p left join dim_fips as d on p.fips_code = d.fips_code
    where p.fips_code is not null and year is not null and total_population is not null"""
SQL_VIEWS["pop_sequence"] = """
    select *, lag(total_population) over (partition by fips_code order by year) as prev_year_population,
           max(total_population) over (partition by fips_code order by year rows unbounded preceding) as peak_population
    from pop_panel"""

_SHARES = {b.replace("pop_", "pct_"): b for b in population.BANDS} | {
    "pct_male": "male_population",
    "pct_female": "female_population",
}
SHARES_SQL = ", ".join(f"{sql_percent(part, 'total_population')} as {name}" for name, part in _SHARES.items())
RATIOS_SQL = f"""
    {WORKING} as working_age_population,
    {sql_percent("(pop_0_4 + pop_5_17 + pop_65_plus)", f"({WORKING})")} as dependency_ratio,
    {sql_percent("pop_65_plus", "total_population")} as elderly_ratio,
    {sql_percent("(pop_0_4 + pop_5_17)", "total_population")} as youth_ratio"""
SQL_VIEWS["pop_growth"] = f"""
    select {K}, year, total_population, {SEXES}, prev_year_population,
           {sql_percent("(total_population - prev_year_population)", "prev_year_population")} as yoy_growth_rate,
           cast(total_population - prev_year_population as integer) as yoy_growth_absolute,
           {SHARES_SQL}, {RATIOS_SQL},
           {sql_percent("(total_population - peak_population)", "peak_population")} as decline_pct
    from pop_sequence"""
SQL_VIEWS["pop_ranked"] = """
    select *,
      row_number() over (partition by fips_code order by yoy_growth_rate desc nulls last, year desc) as hi,
      row_number() over (partition by fips_code order by yoy_growth_rate asc nulls last, year asc) as lo,
      row_number() over (partition by fips_code
                         order by case when decline_pct < 0 then decline_pct end asc nulls last, year asc) as dd,
      row_number() over (partition by fips_code order by year) as oldest,
      row_number() over (partition by fips_code order by year desc) as newest
    from pop_growth"""
SQL_VIEWS["pop_mean"] = f"""
    select {K}, {sql_mean("yoy_growth_rate")} as avg_growth
    from pop_growth where yoy_growth_rate is not null group by {K}"""
SQL_VIEWS["pop_summary"] = f"""
    select {K}, min(year) as first_year, max(case when oldest = 1 then total_population end) as first_year_population,
      max(year) as last_year, max(case when newest = 1 then total_population end) as last_year_population,
      {sql_mean("yoy_growth_rate")} as average_yoy_growth,
      max(case when hi = 1 then yoy_growth_rate end) as max_yoy_growth,
      max(case when hi = 1 and yoy_growth_rate is not null then year end) as max_yoy_year,
      max(case when lo = 1 then yoy_growth_rate end) as min_yoy_growth,
      max(case when lo = 1 and yoy_growth_rate is not null then year end) as min_yoy_year,
      max(case when dd = 1 and decline_pct < 0 then decline_pct end) as maximum_decline,
      max(case when dd = 1 and decline_pct < 0 then year end) as maximum_decline_year,
      {", ".join(f"{sql_mean(r)} as avg_{r}" for r in population.RATIOS)}
    from pop_ranked group by {K}"""
SQL_VIEWS["pop_totals"] = f"""
    select state_name, state_code, year, count(distinct fips_code) as number_of_counties,
      {", ".join(f"cast(sum({c}) as bigint) as {c}" for c in ["total_population", *population.SEXES, *population.BANDS])}
    from pop_panel group by state_name, state_code, year"""
SQL_VIEWS["pop_totals_shares"] = f"""
    select state_name, state_code, year, number_of_counties, total_population,
      {sql_percent("male_population", "total_population")} as pct_male,
      {sql_percent("female_population", "total_population")} as pct_female,
      {sql_percent("pop_65_plus", "total_population")} as pct_elderly,
      {sql_percent(f"({WORKING})", "total_population")} as pct_working_age
    from pop_totals"""
TOTAL_GROWTH_SQL = sql_percent("(last_year_population - first_year_population)", "first_year_population")


def _coded(spark, sf):
    return population.with_place_codes(population_raw(spark, sf), STATE_WIDTH, COUNTY_WIDTH)


def _county(spark, sf):
    return population.bronze_county(_coded(spark, sf))


def _panel(spark, sf):
    return population.clean(_county(spark, sf), dim_fips(spark, sf))


def _rows(spark, sf):
    return population.sequence(_panel(spark, sf))


# --- tables ----------------------------------------------------------------


@query("select * from pop_county")
def bronze_population_county(spark, sf):
    return _county(spark, sf)


@query(f"select state_code, Description as state_name, {MEASURES} from pop_coded where is_state_level")
def bronze_population_state(spark, sf):
    return population.bronze_state(_coded(spark, sf))


@query("select * from pop_panel")
def population_by_year(spark, sf):
    return population.by_year(_panel(spark, sf))


@query(f"""
    select {K}, year, total_population, {SEXES}, working_age_population, prev_year_population, yoy_growth_rate,
           yoy_growth_absolute, {", ".join(_SHARES)}, dependency_ratio, elderly_ratio, youth_ratio from pop_growth""")
def population_with_growth(spark, sf):
    return population.with_growth(_rows(spark, sf))


@query(f"select *, {TOTAL_GROWTH_SQL} as total_growth_pct from pop_summary")
def population_county_summary(spark, sf):
    return population.county_summary(_rows(spark, sf))


@query(f"""
    select s.state_code, s.state_name, s.num_counties, s.first_year, s.last_year, s.avg_county_yoy_growth,
           s.max_county_yoy_growth, s.min_county_yoy_growth,
           b.county_name as fastest_growing_county, b.avg_growth as fastest_growth_rate,
           w.county_name as slowest_growing_county, w.avg_growth as slowest_growth_rate
    from (select state_code, state_name, count(distinct fips_code) as num_counties, min(year) as first_year,
                 max(year) as last_year, {sql_mean("yoy_growth_rate")} as avg_county_yoy_growth,
                 max(yoy_growth_rate) as max_county_yoy_growth, min(yoy_growth_rate) as min_county_yoy_growth
          from pop_growth group by state_code, state_name) as s
    left join ({sql_pick("pop_mean", "state_code", "avg_growth", "desc")}) as b on s.state_code = b.state_code
    left join ({sql_pick("pop_mean", "state_code", "avg_growth", "asc")}) as w on s.state_code = w.state_code""")
def population_state_summary(spark, sf):
    return population.state_summary(_rows(spark, sf))


@query(f"""
    select s.*, b.county_name as largest_county, b.total_population as largest_county_population,
           w.county_name as smallest_county, w.total_population as smallest_county_population
    from pop_totals_shares as s
    left join ({sql_pick("pop_panel", "state_code, year", "total_population", "desc")}) as b
      on s.state_code = b.state_code and s.year = b.year
    left join ({sql_pick("pop_panel", "state_code, year", "total_population", "asc")}) as w
      on s.state_code = w.state_code and s.year = w.year""")
def population_by_state_by_year(spark, sf):
    return population.by_state_by_year(written(_panel(spark, sf)))


@query(f"""
    select fips_code as FIPS_CODE, year as YEAR, total_population as TOTAL_POPULATION,
           male_population as MALE_POPULATION, female_population as FEMALE_POPULATION, pop_0_4 as POPULATION_0_4,
           pop_5_17 as POPULATION_5_17, {WORKING} as POPULATION_18_64, pop_65_plus as POPULATION_65_PLUS
    from pop_county""")
def population_data(spark, sf):
    return population.broad_bands(_county(spark, sf))


# --- single operators ------------------------------------------------------


@query("""
    select 'county' as level, count(*) as row_count, cast(sum(Total_Population) as bigint) as total
    from pop_coded where not is_state_level
    union all
    select 'state', count(*), cast(sum(Total_Population) as bigint) from pop_coded where is_state_level""")
def split_levels(spark, sf):
    states, counties = split_by_flag(written(_coded(spark, sf)), "is_state_level")

    def sized(df, level):
        return df.agg(F.count("*").alias("row_count"), F.sum("Total_Population").alias("total")).select(
            F.lit(level).alias("level"), "row_count", "total"
        )

    return sized(counties, "county").unionByName(sized(states, "state"))


@query("select IBRC_Geo_ID, Year, fips_code, state_code, county_code, is_state_level from pop_coded")
def str_fips_key(spark, sf):
    return _coded(spark, sf).select("IBRC_Geo_ID", "Year", "fips_code", "state_code", "county_code", "is_state_level")


@query(f"select fips_code, year, {SHARES_SQL} from pop_panel")
def demographic_shares(spark, sf):
    return _panel(spark, sf).select("fips_code", "year", *[s.alias(n) for n, s in population.shares().items()])


@query(f"select fips_code, year, {RATIOS_SQL} from pop_panel")
def demographic_ratios(spark, sf):
    return _panel(spark, sf).select("fips_code", "year", *[r.alias(n) for n, r in population.ratios().items()])


@query(f"""
    select {K}, first_year, first_year_population, last_year, last_year_population,
           {TOTAL_GROWTH_SQL} as total_growth_pct from pop_summary""")
def agg_first_last_growth(spark, sf):
    ends = _panel(spark, sf).groupBy(*KEYS).agg(
        A.first_value("year", "total_population").alias("first"),
        A.last_value("year", "total_population").alias("last"),
    )
    first, last = F.col("first.total_population"), F.col("last.total_population")
    return ends.select(
        *KEYS,
        F.col("first.year").alias("first_year"),
        first.alias("first_year_population"),
        F.col("last.year").alias("last_year"),
        last.alias("last_year_population"),
        growth_percent(last, first).alias("total_growth_pct"),
    )


@query(f"select {K}, {', '.join(f'avg_{r}' for r in population.RATIOS)} from pop_summary")
def agg_avg_ratios(spark, sf):
    rows = _panel(spark, sf).withColumns(population.shares() | population.ratios())
    return rows.groupBy(*KEYS).agg(*[A.mean_percent(r).alias(f"avg_{r}") for r in population.RATIOS])


@query("select * from pop_totals_shares")
def rollup_shares(spark, sf):
    totals = _panel(spark, sf).groupBy("state_name", "state_code", "year").agg(
        F.countDistinct("fips_code").alias("number_of_counties"),
        *[total.alias(name) for name, total in population.state_totals().items()],
    )
    return totals.select(
        "state_name",
        "state_code",
        "year",
        "number_of_counties",
        F.col("sum_total_population").alias("total_population"),
        *[share.alias(name) for name, share in population.rollup_shares().items()],
    )


@query("""
    select count(*) as row_count, count(distinct fips_code) as entity_count, count(distinct year) as period_count
    from pop_county""")
def profile_table(spark, sf):
    return quality.profile(_county(spark, sf), "fips_code", "year")


@query("""
    select count(*) as row_count, count(distinct fips_code) as entity_count, count(distinct year) as period_count
    from pop_county""")
def profile_by_bitmaps(spark, sf):
    """The profile from bitmaps of the county codes and years."""
    return quality.profile_codes(_county(spark, sf), "fips_code", "year")


@query("""
    select state_code, cast(null as integer) as year, count(distinct fips_code) as counties from pop_county group by state_code
    union all select null, year, count(distinct fips_code) from pop_county group by year
    union all select state_code, year, count(distinct fips_code) from pop_county group by state_code, year""")
def distinct_counts_by_level(spark, sf):
    """Counties of every state and year, of states and of years, all from the bitmaps of the first."""
    fine = written(quality.distinct_bitmaps(_county(spark, sf), ["state_code", "year"], "fips_code"))
    out = quality.distinct_counts(fine, ["state_code", "year"], "counties")
    for level in ("state_code", "year"):
        counts = quality.distinct_counts(quality.merged_bitmaps(fine, [level]), [level], "counties")
        out = out.unionByName(counts, allowMissingColumns=True)
    return out
