"""Queries over place codes, names and plain scalar operators."""

from pyspark.sql import functions as F

from panelspark.functions import before_comma, entity_key_from_file, file_base_name
from panelspark.operators import joins
from panelspark.operators.aggregates import category_stats
from panelspark.operators.project import flag
from panelspark.queries.registry import SQL_VIEWS, query
from panelspark.sources.files import parse_code_list as parsed_codes
from panelspark.testtables import _county_code, _state_code, code_lines, dim_fips, gdp_raw, table

SQL_VIEWS["all_codes"] = """
    select lpad(cast(c_nationkey + 1 as varchar), 2, '0') || lpad(cast(c_custkey + 1 as varchar), 11, '0') as fips_code
    from customer"""
SQL_VIEWS["known_states"] = """
    select lpad(cast(n_nationkey + 1 as varchar), 2, '0') as state_code, n_name as state_name
    from nation where n_regionkey <> 4"""


def _all_codes(spark, sf):
    return table(spark, sf, "customer").select(F.concat(_state_code(), _county_code()).alias("fips_code"))


@query("""
    select substr(trim(value), 1, 5) as fips_code from code_lines where substr(trim(value), 3, 3) <> '000'""")
def parse_code_list(spark, sf):
    return parsed_codes(code_lines(spark, sf))


@query("""
    select d.fips_code, d.state_code, coalesce(s.state_name, 'State ' || d.state_code) as state_name,
           d.county_name, d.county_code
    from dim_fips as d left join known_states as s on d.state_code = s.state_code""")
def build_dimension(spark, sf):
    full_name = F.concat("county_name", F.lit(", "), "state_name").alias("full_name")
    names = dim_fips(spark, sf).select("fips_code", full_name)
    nation = table(spark, sf, "nation").filter("n_regionkey <> 4")
    states = nation.select(
        F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0").alias("state_code"),
        F.col("n_name").alias("state_name"),
    )
    return joins.build_dimension(_all_codes(spark, sf), names, states)


@query("select distinct fips_code from gdp_raw where fips_code not in (select fips_code from dim_fips)")
def unmapped_keys(spark, sf):
    return joins.unmapped_keys(gdp_raw(spark, sf), dim_fips(spark, sf))


@query("select fips_code from all_codes where fips_code in (select fips_code from gdp_raw)")
def prune_codes(spark, sf):
    return joins.prune_codes(_all_codes(spark, sf), gdp_raw(spark, sf))


@query("select c_custkey, c_name || ' County' as county_name from customer")
def str_before_comma(spark, sf):
    full = F.concat("c_name", F.lit(" County , Nation, "), F.col("c_nationkey").cast("string"))
    return table(spark, sf, "customer").select("c_custkey", before_comma(full).alias("county_name"))


@query("""
    select c_custkey, case when c_nationkey % 5 = 0 then ''
           else lpad(cast(c_custkey % 100000 as varchar), 5, '0') end as entity from customer""")
def str_key_from_filename(spark, sf):
    digits = F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0")
    suffix = F.when(F.col("c_nationkey") % 5 == 0, ".txt").otherwise(".csv")
    path = F.concat(F.lit("data/gdp/gdpall"), digits, suffix)
    return table(spark, sf, "customer").select("c_custkey", entity_key_from_file(path).alias("entity"))


@query("select page_id, list_extract(string_split(url, '/'), -1) as base_name from pages")
def str_basename(spark, sf):
    return table(spark, sf, "pages").select("page_id", file_base_name(F.col("url")).alias("base_name"))


@query("select c_custkey, case when c_acctbal >= 3000 then 'Yes' else 'No' end as senior from customer")
def case_flag(spark, sf):
    return flag(table(spark, sf, "customer"), F.col("c_acctbal") >= 3000, "senior").select("c_custkey", "senior")


@query("""
    select l_returnflag, count(*) as row_count, avg(l_linenumber) as avg_l_linenumber,
           max(l_linenumber) as max_l_linenumber, min(l_linenumber) as min_l_linenumber
    from lineitem group by l_returnflag order by row_count desc, l_returnflag""")
def agg_category_stats(spark, sf):
    return category_stats(table(spark, sf, "lineitem"), "l_returnflag", "l_linenumber")
