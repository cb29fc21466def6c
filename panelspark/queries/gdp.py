"""Queries over the GDP panel."""

from pyspark.sql import functions as F

from panelspark import schemas
from panelspark.functions import growth_percent
from panelspark.operators import aggregates as A
from panelspark.operators import filters, joins, project, quality, ranking, sequence
from panelspark.plans import gdp
from panelspark.queries.registry import SQL_VIEWS, query, sql_mean, sql_percent
from panelspark.session import scratch_path, written
from panelspark.sinks.files import write_partitioned
from panelspark.sources.files import scan_table
from panelspark.testtables import dim_fips, gdp_raw, table

KEYS = gdp.PANEL.keys
K = "state_code, state_name, fips_code, county_name"

SQL_VIEWS["gdp_bronze"] = """
    select fips_code, state_code, state_name, county_code, county_name, observation_date as date, gdp_value
    from gdp_raw left join dim_fips using (fips_code) where fips_code not in ('', '02261')"""
SQL_VIEWS["gdp_panel"] = f"""
    select {K}, cast(year(cast(date as date)) as integer) as year, cast(date as date) as date, gdp_value
    from gdp_bronze where fips_code is not null and date is not null and gdp_value is not null"""
SQL_VIEWS["gdp_sequence"] = f"""
    select {K}, year, gdp_value,
           lag(gdp_value) over (partition by fips_code order by year) as prev_year_gdp,
           max(gdp_value) over (partition by fips_code order by year rows unbounded preceding) as peak_gdp
    from gdp_panel"""
SQL_VIEWS["gdp_growth"] = f"""
    select {K}, year, gdp_value, prev_year_gdp, peak_gdp,
           {sql_percent("gdp_value - prev_year_gdp", "prev_year_gdp")} as yoy_growth_rate,
           {sql_percent("gdp_value - peak_gdp", "peak_gdp")} as drawdown_pct
    from gdp_sequence"""
SQL_VIEWS["gdp_ranked"] = f"""
    select *,
      row_number() over (partition by fips_code order by yoy_growth_rate desc nulls last, year desc) as hi,
      row_number() over (partition by fips_code order by yoy_growth_rate asc nulls last, year asc) as lo,
      row_number() over (partition by fips_code
                         order by case when drawdown_pct < 0 then drawdown_pct end asc nulls last, year asc) as dd
    from gdp_growth"""
SQL_VIEWS["gdp_mean"] = f"""
    select {K}, {sql_mean("yoy_growth_rate")} as avg_growth
    from gdp_growth where yoy_growth_rate is not null group by {K}"""


def sql_pick(source: str, group: str, value: str, direction: str) -> str:
    """The row with the extreme value of each group, ties by the smallest key."""
    return f"""select * from (select *, row_number() over (partition by {group}
               order by {value} {direction}, fips_code) as place from {source}) as numbered where place = 1"""


def _bronze(spark, sf):
    return gdp.bronze(gdp_raw(spark, sf), dim_fips(spark, sf))


def _panel(spark, sf):
    return gdp.clean(_bronze(spark, sf))


def _rows(spark, sf):
    return gdp.sequence(_panel(spark, sf))


def _growth(spark, sf):
    return gdp.with_growth(_rows(spark, sf))


# --- tables ----------------------------------------------------------------


@query("select * from gdp_bronze")
def bronze_gdp(spark, sf):
    return _bronze(spark, sf)


@query("select * from gdp_panel")
def gdp_by_year(spark, sf):
    return gdp.by_year(_panel(spark, sf))


@query(f"select {K}, year, gdp_value, prev_year_gdp, yoy_growth_rate from gdp_growth")
def gdp_with_growth(spark, sf):
    return _growth(spark, sf)


@query(f"""
    select {K}, min(year) as first_year, max(year) as last_year, count(*) as years_of_data,
      {sql_mean("yoy_growth_rate")} as average_yoy,
      max(case when hi = 1 then yoy_growth_rate end) as max_yoy,
      max(case when hi = 1 and yoy_growth_rate is not null then year end) as max_yoy_year,
      max(case when lo = 1 then yoy_growth_rate end) as min_yoy,
      max(case when lo = 1 and yoy_growth_rate is not null then year end) as min_yoy_year,
      max(case when dd = 1 and drawdown_pct < 0 then drawdown_pct end) as maximum_draw_down,
      max(case when dd = 1 and drawdown_pct < 0 then year end) as maximum_draw_down_year
    from gdp_ranked group by {K}""")
def gdp_county_summary(spark, sf):
    return gdp.county_summary(_rows(spark, sf))


@query(f"""
    select s.state_code, s.state_name, s.num_counties, s.first_year, s.last_year, s.avg_county_yoy,
           s.max_county_yoy, s.min_county_yoy,
           b.county_name as best_perform_county, b.avg_growth as best_perform_avg_yoy,
           w.county_name as least_perform_county, w.avg_growth as least_perform_avg_yoy
    from (select state_code, state_name, count(distinct fips_code) as num_counties, min(year) as first_year,
                 max(year) as last_year, {sql_mean("yoy_growth_rate")} as avg_county_yoy,
                 max(yoy_growth_rate) as max_county_yoy, min(yoy_growth_rate) as min_county_yoy
          from gdp_growth group by state_code, state_name) as s
    left join ({sql_pick("gdp_mean", "state_code", "avg_growth", "desc")}) as b on s.state_code = b.state_code
    left join ({sql_pick("gdp_mean", "state_code", "avg_growth", "asc")}) as w on s.state_code = w.state_code""")
def gdp_state_summary(spark, sf):
    return gdp.state_summary(_growth(spark, sf))


@query(f"""
    select s.state_name, s.state_code, s.year, s.number_of_county, s.total_gdp,
           b.county_name as best_perform_county, b.gdp_value as best_perform_county_gdp,
           w.county_name as least_perform_county, w.gdp_value as least_perform_county_gdp
    from (select state_name, state_code, year, count(distinct fips_code) as number_of_county,
                 cast(sum(gdp_value) as bigint) as total_gdp
          from gdp_panel group by state_name, state_code, year) as s
    left join ({sql_pick("gdp_panel", "state_code, year", "gdp_value", "desc")}) as b
      on s.state_code = b.state_code and s.year = b.year
    left join ({sql_pick("gdp_panel", "state_code, year", "gdp_value", "asc")}) as w
      on s.state_code = w.state_code and s.year = w.year""")
def gdp_by_state_by_year(spark, sf):
    return gdp.by_state_by_year(written(_panel(spark, sf)))


# --- scans, projections, filters -------------------------------------------


@query("select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice >= 100000")
def scan_filter_project(spark, sf):
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 100000)
    return table(spark, sf, "orders").filter(wanted).select("o_orderkey", "o_custkey", "o_totalprice")


@query("select fips_code as place, observation_date as date, gdp_value as amount from gdp_raw")
def project_rename(spark, sf):
    names = {"fips_code": "place", "observation_date": "date", "gdp_value": "amount"}
    return project.select_renamed(gdp_raw(spark, sf), names)


@query("select fips_code as FIPS, observation_date, gdp_value as GDP from gdp_raw")
def rename_map(spark, sf):
    return project.rename(gdp_raw(spark, sf), {"fips_code": "FIPS", "gdp_value": "GDP"})


@query(f"select {K}, date, gdp_value from gdp_bronze where state_code is not null and gdp_value is not null")
def filter_not_null(spark, sf):
    kept = filters.require_not_null(_bronze(spark, sf), ["state_code", "gdp_value"])
    return kept.select(*KEYS, "date", "gdp_value")


@query("select fips_code, state_code, gdp_value from gdp_bronze where state_code not in ('01', '25')")
def filter_exclude(spark, sf):
    kept = filters.exclude_values(_bronze(spark, sf), "state_code", ["01", "25"])
    return kept.select("fips_code", "state_code", "gdp_value")


@query("""
    select fips_code, cast(observation_date as date) as date,
           cast(year(cast(observation_date as date)) as integer) as year from gdp_raw""")
def date_year(spark, sf):
    dated = gdp_raw(spark, sf).select("fips_code", F.col("observation_date").try_cast("date").alias("date"))
    return dated.withColumn("year", F.year("date"))


@query("select fips_code, date, gdp_value, county_name, state_name, state_code, county_code from gdp_bronze")
def partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "bronze_gdp")
    write_partitioned(_bronze(spark, sf), path, "state_code")
    return scan_table(spark, path, schemas.BRONZE_GDP.replace("gdp_value int", "gdp_value bigint"))


@query(f"select {K}, year, gdp_value from gdp_panel order by fips_code, year limit 20")
def preview_topn(spark, sf):
    return filters.preview(_panel(spark, sf).select(*KEYS, "year", "gdp_value"), ["fips_code", "year"], 20)


# --- joins -----------------------------------------------------------------


@query("""
    select fips_code, observation_date, gdp_value, state_code, state_name, county_code, county_name
    from gdp_raw left join dim_fips using (fips_code)""")
def join_dimension_left(spark, sf):
    return joins.join_dimension(gdp_raw(spark, sf), dim_fips(spark, sf))


@query(f"""
    select b.state_code, b.state_name, b.fips_code, b.county_name, b.years_of_data, m.avg_growth
    from (select {K}, count(*) as years_of_data from gdp_panel group by {K}) as b
    left join gdp_mean as m on b.state_code = m.state_code and b.state_name = m.state_name
      and b.fips_code = m.fips_code and b.county_name = m.county_name""")
def left_join_null_keys(spark, sf):
    growth = _growth(spark, sf)
    counts = growth.groupBy(*KEYS).agg(F.count("*").alias("years_of_data"))
    return joins.join_metrics(counts, [ranking.mean_growth(growth, KEYS)], KEYS)


@query("select count(*) as unmapped from gdp_bronze where state_code is null")
def unmapped_count(spark, sf):
    return A.count_where_null(_bronze(spark, sf), "state_code", "unmapped")


# --- aggregations ----------------------------------------------------------


@query(f"select {K}, min(year) as first_year, max(year) as last_year, count(*) as years_of_data from gdp_panel group by {K}")
def agg_basic(spark, sf):
    return A.period_span(_panel(spark, sf), KEYS, "year")


@query("select state_code, count(distinct fips_code) as num_counties from gdp_panel group by state_code")
def agg_count_distinct(spark, sf):
    return _panel(spark, sf).groupBy("state_code").agg(F.countDistinct("fips_code").alias("num_counties"))


@query("select state_code, year, cast(sum(gdp_value) as bigint) as total_gdp from gdp_panel group by state_code, year")
def agg_sum_by_period(spark, sf):
    return _panel(spark, sf).groupBy("state_code", "year").agg(F.sum("gdp_value").alias("total_gdp"))


@query("select * from gdp_mean")
def agg_avg_growth(spark, sf):
    return ranking.mean_growth(_growth(spark, sf), KEYS)


@query("select fips_code, yoy_growth_rate as max_yoy, year as max_yoy_year from gdp_ranked "
       "where hi = 1 and yoy_growth_rate is not null")
def agg_argmax_growth(spark, sf):
    best = _growth(spark, sf).groupBy("fips_code").agg(A.highest("yoy_growth_rate", "year").alias("top"))
    top = best.filter("top is not null")
    return top.select("fips_code", F.col("top.yoy_growth_rate").alias("max_yoy"), F.col("top.year").alias("max_yoy_year"))


@query("select fips_code, yoy_growth_rate as min_yoy, year as min_yoy_year from gdp_ranked "
       "where lo = 1 and yoy_growth_rate is not null")
def agg_argmin_growth(spark, sf):
    worst = _growth(spark, sf).groupBy("fips_code").agg(A.lowest("yoy_growth_rate", "year").alias("low"))
    low = worst.filter("low is not null")
    return low.select("fips_code", F.col("low.yoy_growth_rate").alias("min_yoy"), F.col("low.year").alias("min_yoy_year"))


@query(f"""
    select state_code, state_name, {sql_mean("yoy_growth_rate")} as avg_county_yoy,
           max(yoy_growth_rate) as max_county_yoy, min(yoy_growth_rate) as min_county_yoy
    from gdp_growth where yoy_growth_rate is not null group by state_code, state_name""")
def agg_state_growth(spark, sf):
    known = filters.require_not_null(_growth(spark, sf), ["yoy_growth_rate"])
    return known.groupBy("state_code", "state_name").agg(
        A.mean_percent("yoy_growth_rate").alias("avg_county_yoy"),
        F.max("yoy_growth_rate").alias("max_county_yoy"),
        F.min("yoy_growth_rate").alias("min_county_yoy"),
    )


# --- windows and ranks -----------------------------------------------------


@query("select fips_code, year, gdp_value, prev_year_gdp from gdp_sequence")
def window_lag(spark, sf):
    rows = _panel(spark, sf).select("fips_code", "year", "gdp_value")
    return rows.withColumn("prev_year_gdp", sequence.previous_value("gdp_value", ["fips_code"], "year"))


@query("""
    select fips_code, year, gdp_value, prev_year_gdp, yoy_growth_rate,
           gdp_value - prev_year_gdp as yoy_growth_absolute from gdp_growth""")
def window_yoy_growth(spark, sf):
    change = (F.col("gdp_value") - F.col("prev_year_gdp")).alias("yoy_growth_absolute")
    return _rows(spark, sf).select("fips_code", "year", "gdp_value", "prev_year_gdp", "yoy_growth_rate", change)


@query("select fips_code, year, gdp_value, peak_gdp, drawdown_pct from gdp_growth")
def window_running_peak(spark, sf):
    peak = sequence.running_peak("gdp_value", ["fips_code"], "year")
    rows = _panel(spark, sf).select("fips_code", "year", "gdp_value").withColumn("peak_gdp", peak)
    return rows.withColumn("drawdown_pct", growth_percent(F.col("gdp_value"), F.col("peak_gdp")))


@query("""
    select fips_code, drawdown_pct as maximum_draw_down, year as maximum_draw_down_year
    from gdp_ranked where dd = 1 and drawdown_pct < 0""")
def window_max_drawdown(spark, sf):
    fallen = _rows(spark, sf).groupBy("fips_code").agg(A.deepest("drawdown_pct", "year").alias("dd")).filter("dd is not null")
    return fallen.select(
        "fips_code",
        F.col("dd.drawdown_pct").alias("maximum_draw_down"),
        F.col("dd.year").alias("maximum_draw_down_year"),
    )


@query("""
    select o_orderkey, o_orderstatus, o_totalprice,
           lag(o_totalprice) over (partition by o_orderstatus order by o_orderkey) as previous_price,
           max(o_totalprice) over (partition by o_orderstatus order by o_orderkey rows unbounded preceding) as peak_price
    from orders""")
def window_hot_entities(spark, sf):
    """Previous value and peak where each of three entities holds a third of all rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sequence.with_previous_and_peak_split(
        orders, ["o_orderstatus"], "o_orderkey", "o_totalprice", "previous_price", "peak_price"
    )


@query(f"select state_code, county_name, avg_growth from ({sql_pick('gdp_mean', 'state_code', 'avg_growth', 'desc')}) as t")
def rank_best_by_growth(spark, sf):
    means = ranking.mean_growth(_growth(spark, sf), KEYS)
    return ranking.best_in_group(means, ["state_code"], "avg_growth", "fips_code", "county_name")


@query(f"select state_code, county_name, avg_growth from ({sql_pick('gdp_mean', 'state_code', 'avg_growth', 'asc')}) as t")
def rank_worst_by_growth(spark, sf):
    means = ranking.mean_growth(_growth(spark, sf), KEYS)
    return ranking.worst_in_group(means, ["state_code"], "avg_growth", "fips_code", "county_name")


@query("select state_code, year, county_name, gdp_value from "
       f"({sql_pick('gdp_panel', 'state_code, year', 'gdp_value', 'desc')}) as t")
def rank_largest_by_period(spark, sf):
    found = ranking.extremes(written(_panel(spark, sf)), ["state_code", "year"], "gdp_value", "fips_code", "county_name", ["best"])
    return found.select("state_code", "year", "best.county_name", "best.gdp_value")


@query("select state_code, year, county_name, gdp_value from "
       f"({sql_pick('gdp_panel', 'state_code, year', 'gdp_value', 'asc')}) as t")
def rank_smallest_by_period(spark, sf):
    found = ranking.extremes(written(_panel(spark, sf)), ["state_code", "year"], "gdp_value", "fips_code", "county_name", ["worst"])
    return found.select("state_code", "year", "worst.county_name", "worst.gdp_value")


# --- quality ---------------------------------------------------------------

# Row floors and key columns of the published tables; the floors are those of the test data.
EXPECTATIONS = {
    "GDP_BY_YEAR": quality.Expectation(5000, ("fips_code", "year", "gdp_value")),
    "GDP_WITH_GROWTH": quality.Expectation(5000, ("fips_code", "year", "gdp_value")),
    "GDP_COUNTY_SUMMARY": quality.Expectation(3000, ("fips_code", "county_name", "years_of_data")),
    "GDP_STATE_SUMMARY": quality.Expectation(25, ("state_code", "state_name", "num_counties")),
    "GDP_BY_STATE_BY_YEAR": quality.Expectation(100, ("state_code", "year", "total_gdp")),
}

_GROUPED = {
    "GDP_BY_YEAR": "select * from gdp_panel",
    "GDP_WITH_GROWTH": "select * from gdp_growth",
    "GDP_COUNTY_SUMMARY": f"select {K}, count(*) as years_of_data from gdp_panel group by {K}",
    "GDP_STATE_SUMMARY": "select state_code, state_name, count(distinct fips_code) as num_counties "
    "from gdp_panel group by state_code, state_name",
    "GDP_BY_STATE_BY_YEAR": "select state_code, state_name, year, sum(gdp_value) as total_gdp "
    "from gdp_panel group by state_code, state_name, year",
}


def _sql_checks(name: str, expected: quality.Expectation) -> str:
    source = f"({_GROUPED[name]}) as t"
    checks = [
        f"select '{name}' as table_name, 'min_rows' as check_name, count(*) as observed, "
        f"cast({expected.min_rows} as bigint) as expected, count(*) >= {expected.min_rows} as passed from {source}"
    ]
    checks += [
        f"select '{name}', 'no_nulls_{c}', count(*) - count({c}), cast(0 as bigint), count(*) = count({c}) from {source}"
        for c in expected.key_columns
    ]
    return " union all ".join(checks)


@query(" union all ".join(_sql_checks(name, expected) for name, expected in EXPECTATIONS.items()))
def quality_report(spark, sf):
    rows = written(_panel(spark, sf))
    sequenced = written(gdp.sequence(rows))
    tables = {
        "GDP_BY_YEAR": gdp.by_year(rows),
        "GDP_WITH_GROWTH": gdp.with_growth(sequenced),
        "GDP_COUNTY_SUMMARY": gdp.county_summary(sequenced),
        "GDP_STATE_SUMMARY": gdp.state_summary(sequenced),
        "GDP_BY_STATE_BY_YEAR": gdp.by_state_by_year(rows),
    }
    return quality.quality_report(tables, EXPECTATIONS)


@query("""
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1""")
def quality_duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    select count(*) - count(fips_code) as fips_code, count(*) - count(state_code) as state_code,
           count(*) - count(county_name) as county_name, count(*) - count(gdp_value) as gdp_value from gdp_bronze""")
def null_profile(spark, sf):
    return quality.null_profile(_bronze(spark, sf), ["fips_code", "state_code", "county_name", "gdp_value"])
