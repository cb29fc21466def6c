import json

import pytest
from pyspark.sql import functions as F

from panelspark import schemas
from panelspark.operators import filters, joins, project, setops
from panelspark.plans import airquality
from panelspark.sources import files as S


def test_entity_csv_binds_by_position_and_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "gdpall01001.csv").write_text("observation_date,GDPALL01001\n2001-01-01,100\n2002-01-01,.\n")
    (tmp_path / "gdpall02020.csv").write_text("DATE,VALUE\n2001-01-01,12.5\n2002-01-01,7\n")
    (tmp_path / "gdpall1.csv").write_text("DATE,VALUE\n2001-01-01,1\n")
    df = S.scan_entity_csv(spark, f"{tmp_path}/gdpall*.csv")
    assert sorted((r.fips_code, r.observation_date, r.gdp_value) for r in df.collect() if r.gdp_value) == [
        ("", "2001-01-01", 1),
        ("01001", "2001-01-01", 100),
        ("02020", "2002-01-01", 7),
    ]
    assert df.count() == 5 and df.filter("gdp_value is null").count() == 2


def test_dimension_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "d.csv").write_text(
        "FIPS_Code,State_Code,State_Name,County_Name,County_Code\n01001,01,Alabama,Autauga County,001\n"
    )
    assert tuple(S.scan_dimension(spark, str(tmp_path / "d.csv")).first()) == (
        "01001",
        "01",
        "Alabama",
        "Autauga County",
        "001",
    )


def test_dimension_binds_by_name(spark, tmp_path):
    (tmp_path / "d.csv").write_text("state_code,FIPS_CODE,x,county_name,state_name,county_code\n01,01001,y,Autauga,Alabama,001\n")
    assert tuple(S.scan_dimension(spark, str(tmp_path / "d.csv")).first()) == ("01001", "01", "Alabama", "Autauga", "001")
    (tmp_path / "bad.csv").write_text("state_code,fips\n01,01001\n")
    with pytest.raises(ValueError, match="fips_code"):
        S.scan_dimension(spark, str(tmp_path / "bad.csv"))


def test_indented_json_array_with_blank_in_file_name(spark, tmp_path):
    records = [{"state_code": "11", "county_code": "1", "year": 2001, "arithmetic_mean": 0.5}]
    (tmp_path / "Washington D.C._NO2.json").write_text(json.dumps(records * 2, indent=2))
    (tmp_path / "A+B_C%_PM2.5.json").write_text(json.dumps(records, indent=2))
    raw = S.scan_json_dir(spark, f"{tmp_path}/*.json")
    found = airquality.consolidate(raw).select("city", "pollutant", "GeoFips", "year").distinct()
    assert sorted(tuple(r) for r in found.collect()) == [
        ("A+B_C%", "PM2.5", "11001", 2001),
        ("Washington D.C.", "NO2", "11001", 2001),
    ]
    declared = S.scan_json_dir(spark, f"{tmp_path}/*.json", schemas.EPA_RECORD)
    assert declared.count() == 3 and "city" in declared.columns


def test_observation_batch(spark, tmp_path):
    one = {"DateObserved": "2024-01-01", "HourObserved": 3, "AQI": 41, "Category": {"Number": 1, "Name": "Good"}}
    (tmp_path / "list.json").write_text(json.dumps([one, {"AQI": 5}]))
    (tmp_path / "object.json").write_text(json.dumps(one))
    (tmp_path / "broken.json").write_text('[{"AQI": 1},')
    (tmp_path / "empty.json").write_text("[]")
    read = lambda name: S.scan_observations(spark, str(tmp_path / name))
    assert [r.AQI for r in read("list.json").collect()] == [41, 5]
    assert read("object.json").first().Category.Name == "Good"
    assert read("broken.json").count() == 0
    assert read("empty.json").count() == 0
    assert read("missing.json").count() == 0
    assert read("missing.json").columns == read("list.json").columns


def test_wrapped_records(spark, tmp_path):
    record = {"city": "Boston", "year": 2001, "parameter": "NO2", "arithmetic_mean": 1.5}
    (tmp_path / "a.json").write_text(json.dumps([record, record], indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"Header": [], "Data": [record]}))
    (tmp_path / "c.json").write_text(json.dumps({"Header": []}))
    df = S.scan_wrapped_records(spark, f"{tmp_path}/*.json")
    assert [(r.city, r.arithmetic_mean) for r in df.collect()] == [("Boston", 1.5)] * 3
    assert airquality.tidy(df).columns == ["City", "Year", "Pollutant", "Value", "state", "county"]


def test_code_list(spark, tmp_path):
    (tmp_path / "codes.txt").write_text(
        "header\n\n 01003    Baldwin County\n01000  ALABAMA\n01001 Autauga County\n0100 short\n01005\n 010011 long\n"
    )
    assert [r.fips_code for r in S.scan_code_list(spark, str(tmp_path / "codes.txt")).collect()] == ["01001", "01003"]


def test_read_table(spark):
    spark.sql("create or replace temp view codes as select '01' as c")
    assert S.read_table(spark, "codes").first().c == "01"


# --- small operators -------------------------------------------------------


def test_normalize_to_schema_fills_and_casts(spark):
    df = spark.createDataFrame([("x", "7"), ("y", "bad")], "TargetCity string, aqi string")
    found = project.normalize_to_schema(df, schemas.AQI_HISTORY)
    assert found.columns[0] == "DATEOBSERVED" and dict(found.dtypes)["CATEGORY_NUM"] == "int"
    assert [(r.TARGETCITY, r.AQI, r.STATECODE) for r in found.collect()] == [("x", 7, None), ("y", None, None)]


def test_flatten_without_the_struct_is_a_no_op(spark):
    df = spark.range(2)
    assert airquality.flatten_observations(df).columns == ["ID"]


def test_tag(spark):
    assert [tuple(r) for r in project.tag(spark.range(1), "TargetCity", "Boston").collect()] == [(0, "Boston")]


def test_flag_and_stamp(spark):
    df = spark.createDataFrame([(30,), (29,), (None,)], "age int")
    flagged = project.stamp_load_time(project.flag(df, F.col("age") >= 30, "senior"))
    assert [r.senior for r in flagged.collect()] == ["Yes", "No", "No"]
    assert dict(flagged.dtypes)["processed_at"] == "timestamp"


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5", "2001"), (".", "2001"), ("2", None)], "v string, y string")
    assert [tuple(r) for r in filters.coerce_numeric(df, ["v", "y"]).collect()] == [(1.5, 2001.0)]


def test_exclude_drops_null_too(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r.k for r in filters.exclude_values(df, "k", ["a"]).collect()] == ["b"]


def test_union_batches_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2,)], "n int")
    assert [tuple(r) for r in setops.union_batches([a, b]).orderBy("n").collect()] == [(1, "x"), (2, None)]


def test_build_dimension_default_state_and_skipped_codes(spark):
    codes = spark.createDataFrame([("01001",), ("03005",), ("99999",)], "fips_code string")
    names = spark.createDataFrame(
        [("01001", "Autauga County, Alabama"), ("03005", "Somewhere , Nowhere")], "fips_code string, full_name string"
    )
    states = spark.createDataFrame([("01", "Alabama")], "state_code string, state_name string")
    found = joins.build_dimension(codes, names, states).orderBy("fips_code")
    assert [tuple(r) for r in found.collect()] == [
        ("01001", "01", "Alabama", "Autauga County", "001"),
        ("03005", "03", "State 03", "Somewhere", "005"),
    ]
    assert [r.fips_code for r in joins.unmapped_keys(codes, found).collect()] == ["99999"]


@pytest.mark.parametrize("order, expected", [(["DATEOBSERVED", "HOUROBSERVED", "AQI"], 9)])
def test_latest_per_key(spark, order, expected):
    df = spark.createDataFrame(
        [("2024-01-01", 23, "NO2", 50, "Boston"), ("2024-01-02", 1, "NO2", 9, "Boston"), ("2024-01-01", 1, "O3", 3, "Miami")],
        "DATEOBSERVED string, HOUROBSERVED int, PARAMETERNAME string, AQI int, TARGETCITY string",
    )
    latest = {(r.TARGETCITY, r.PARAMETERNAME): r.AQI for r in airquality.latest_per_key(df, order).collect()}
    assert latest == {("Boston", "NO2"): expected, ("Miami", "O3"): 3}
    assert [r.VALUE for r in airquality.snapshot_rows(airquality.last_batch(df)).collect()] == [9]
