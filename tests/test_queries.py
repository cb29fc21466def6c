"""Every registered query against its SQL, over the smallest test tables."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from panelspark.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = [tuple(r[c] for c in columns) for r in df.collect()]
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert {c: types[c] for c in columns} == {c: TYPES[t] for c, t in df.dtypes}
    assert found, "a query over the test tables has rows"
    assert not any(isinstance(v, float) and math.isnan(v) for r in found for v in r)
    assert ordered(found) == ordered(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and QUERIES.items() <= entry.queries().items()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["state_code", "state_name", "fips_code", "county_name"]
    assert df.count() > 0


#: Queries over the population tables, which are made of line items.
POPULATION = """bronze_population_county bronze_population_state population_by_year population_with_growth
population_county_summary population_state_summary population_data demographic_shares demographic_ratios
agg_first_last_growth agg_avg_ratios rollup_shares profile_table join_panels str_fips_key""".split()


@pytest.mark.parametrize("name", POPULATION)
def test_population_reads_line_items_once(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_quantity") and sum("Relation [" in line and "l_orderkey" in line for line in plan.splitlines()) == 1
