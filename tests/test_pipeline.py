"""Files to gold tables, twice, with a hot county and with the quality gate."""

import json
import random

import pytest

from panelspark import pipeline, schemas
from panelspark.operators.quality import Expectation, QualityError, require_passed, verdicts
from panelspark.plans import gdp
from panelspark.sinks import ledger
from panelspark.sinks.tables import declare_warehouse, export_tables
from panelspark.sources.files import scan_dimension


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    rng = random.Random(5)
    codes = [f"{s:02d}{c:03d}" for s in (1, 2, 4) for c in range(1, 8, 2)]
    (root / "gdp").mkdir()
    for code in [*codes, "02261"]:
        lines = [f"{y}-01-01,{rng.randint(50, 5000)}" for y in range(2001, 2013) if rng.random() > 0.2]
        (root / "gdp" / f"gdpall{code}.csv").write_text("\n".join(["observation_date,VALUE", *lines, ""]))
    mapped = codes[:-1]
    (root / "dim.csv").write_text(
        "\n".join(
            ["fips_code,state_code,state_name,county_name,county_code"]
            + [f"{c},{c[:2]},State {c[:2]},County {c},{c[2:]}" for c in mapped]
        )
    )
    lines = ["IBRC_Geo_ID,Statefips,Countyfips,Description,Year," + ",".join(["x"] * 12)]
    for code in [*codes, "01000", "00000"]:
        for year in range(2001, 2006):
            bands = [rng.randint(1, 900) for _ in range(6)]
            numbers = [sum(bands), *bands, bands[0], bands[1], bands[2], bands[3], sum(bands) - bands[3]]
            lines.append(f"{int(code)},{code[:2]},{code[2:]},\"Place {code}, X\",{year}," + ",".join(map(str, numbers)))
    (root / "people.csv").write_text("\n".join(lines))
    return root


def test_gdp_flow(spark, inputs, tmp_path, rows):
    out = str(tmp_path)
    bronze = pipeline.load_gdp(spark, f"{inputs}/gdp/gdpall*.csv", f"{inputs}/dim.csv", out)
    assert bronze.rows > 100 and 0 < bronze.unmapped <= 12
    counts = pipeline.build_gdp(spark, out)
    assert counts["gdp_by_year"] == counts["gdp_with_growth"] == bronze.rows
    assert counts["gdp_county_summary"] == 12 and counts["gdp_state_summary"] == 4
    tables = pipeline.gold_tables(spark, out, "gdp")
    for name, df in tables.items():
        assert df.count() == counts[name]
    by_year = tables["gdp_by_year"]
    assert rows(tables["gdp_county_summary"]) == rows(gdp.county_summary(gdp.sequence(by_year)))
    assert {r.state_code for r in by_year.collect()} == {"01", "02", "04", None}

    small = {name: Expectation(1, e.key_columns) for name, e in pipeline.GDP_EXPECTATIONS.items()}
    report = pipeline.check_gold(spark, out, "gdp", small)
    # The unmapped county has no name and no state: the gate reports exactly that.
    assert {(r.table_name, r.check_name) for r in report.filter("not passed").collect()} == {
        ("gdp_county_summary", "no_nulls_county_name"),
        ("gdp_state_summary", "no_nulls_state_code"),
        ("gdp_state_summary", "no_nulls_state_name"),
        ("gdp_by_state_by_year", "no_nulls_state_code"),
    }
    with pytest.raises(QualityError):
        require_passed(pipeline.check_gold(spark, out, "gdp", pipeline.GDP_EXPECTATIONS))
    assert {r.verdict for r in verdicts(report).collect()} == {"PASSED", "FAILED"}

    missing = pipeline.check_gold(spark, out, "population")
    assert {(r.observed, r.passed) for r in missing.collect()} == {(0, False)}

    declare_warehouse(spark)
    loads = export_tables(spark, {n.upper(): f"{out}/gold/{n}" for n in counts})
    assert all(load.loaded for load in loads)
    assert rows(spark.table("GDP_STATE_SUMMARY")) == rows(tables["gdp_state_summary"])

    # The same flow again replaces every table.
    first = {name: rows(df) for name, df in tables.items()}
    assert pipeline.build_gdp(spark, out) == counts
    assert {name: rows(df) for name, df in pipeline.gold_tables(spark, out, "gdp").items()} == first


def parts_of(folder):
    """For each sub-folder of the partitioned table its data files."""
    return {p.name: {f.name for f in p.glob("*.parquet")} for p in folder.iterdir() if p.is_dir()}


def test_only_states_with_changed_files_are_loaded(spark, inputs, tmp_path, rows, monkeypatch):
    import shutil

    files, dimension, out = tmp_path / "gdp", tmp_path / "dim.csv", str(tmp_path / "out")
    shutil.copytree(inputs / "gdp", files)
    shutil.copy(inputs / "dim.csv", dimension)
    opened, scan = [], pipeline.scan_entity_csv
    monkeypatch.setattr(pipeline, "scan_entity_csv", lambda s, paths: opened.append(len(paths)) or scan(s, paths))

    def run():
        before = parts_of(bronze) if bronze.exists() else {}
        loaded = pipeline.load_gdp_changes(spark, f"{files}/gdpall*.csv", str(dimension), out)
        after = parts_of(bronze)
        assert rows(spark.read.schema(schemas.BRONZE_GDP).parquet(str(bronze))) == whole()
        return loaded.rows, {k.removeprefix("state_code=") for k in {**before, **after} if before.get(k) != after.get(k)}

    def whole():
        pipeline.load_gdp(spark, f"{files}/gdpall*.csv", str(dimension), f"{tmp_path}/all")
        return rows(spark.read.schema(schemas.BRONZE_GDP).parquet(f"{tmp_path}/all/bronze/gdp_data"))

    bronze = tmp_path / "out/bronze/gdp_data"
    none = "__HIVE_DEFAULT_PARTITION__"
    first, states = run()
    assert first > 100 and states == {"01", "02", "04", none}
    opened.clear()
    assert run() == (0, set()) and not [n for n in opened if n < 13]
    (files / "gdpall02003.csv").write_text("observation_date,VALUE\n2001-01-01,7\n")
    opened.clear()
    assert run()[1] == {"02"} and min(opened) == 4  # the counties of the state
    (files / "gdpall01009.csv").write_text("observation_date,VALUE\n2001-01-01,8\n")  # a county without a place
    assert run()[1] == {none}
    dimension.write_text(dimension.read_text() + "\n01009,01,State 01,County 01009,009\n")  # now it has one
    assert run()[1] == {none, "01"}
    for code in ("04001", "04003", "04005"):
        (files / f"gdpall{code}.csv").unlink()
    assert run() == (0, {"04"}) and "state_code=04" not in parts_of(bronze)


def test_population_flow(spark, inputs, tmp_path):
    out = str(tmp_path)
    county, state = pipeline.load_population(spark, f"{inputs}/people.csv", out)
    assert (county.rows, state.rows) == (60, 5)
    counts = pipeline.build_population(spark, out, f"{inputs}/dim.csv")
    assert counts["population_with_growth"] == 60 and counts["population_county_summary"] == 12
    tables = pipeline.gold_tables(spark, out, "population")
    total = tables["population_by_state_by_year"].groupBy().sum("total_population").first()[0]
    assert total == tables["population_by_year"].groupBy().sum("total_population").first()[0]
    bands = "pop_0_4 + pop_5_17 + pop_18_24 + pop_25_44 + pop_45_64 + pop_65_plus"
    assert tables["population_by_year"].filter(f"{bands} <> total_population").isEmpty()


def test_published_tables_are_checked(spark, inputs, tmp_path):
    out = str(tmp_path)
    spark.sql("create database if not exists published")
    pipeline.load_population(spark, f"{inputs}/people.csv", out)
    pipeline.build_population(spark, out, f"{inputs}/dim.csv")
    declare_warehouse(spark, "published")
    loads = export_tables(spark, pipeline.export_paths(out, "population"), "published")
    assert {load.table: load.rows for load in loads}["published.POPULATION_DATA"] == 60
    report = pipeline.check_published(spark, "population", {"population_data": Expectation(60, ("FIPS_CODE",))}, "published")
    assert {r.verdict for r in verdicts(report).collect()} == {"PASSED"}
    spark.sql("drop table published.POPULATION_COUNTY_SUMMARY")
    spark.sql("insert into published.POPULATION_DATA (YEAR) values (1)")
    wanted = {"population_data": Expectation(99, ("FIPS_CODE",)), "population_with_growth": Expectation(10, ("nowhere",))}
    report = pipeline.check_published(spark, "population", wanted, "published")
    assert {(r.table_name, r.check_name) for r in report.filter("not passed").collect()} == {
        ("population_data", "min_rows"),
        ("population_data", "no_nulls_FIPS_CODE"),
        ("population_county_summary", "min_rows"),
        ("population_with_growth", "no_nulls_nowhere"),
    }


def test_a_repeated_dimension_key_stops_the_flow(spark, inputs, tmp_path):
    (tmp_path / "dim.csv").write_text((inputs / "dim.csv").read_text() + "\n01001,01,State 01,Another name,001\n")
    with pytest.raises(QualityError, match="repeats a key"):
        pipeline.load_gdp(spark, f"{inputs}/gdp/gdpall*.csv", f"{tmp_path}/dim.csv", str(tmp_path))


def observed(spark, city, aqi, n=1):
    row = ("2024-01-01", 1, None, None, None, None, None, "NO2", aqi, (1, "Good"), city)
    return spark.createDataFrame([row] * n, schemas.AQI_OBSERVATION)


@pytest.fixture()
def air(spark, tmp_path):
    """A database of its own, the stream's folders, and a store that takes (city, value, rows) as the next batch."""
    from panelspark.streaming import observations as stream

    database = f"published_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"create database {database}")
    declare_warehouse(spark, database)
    root, batches = f"{tmp_path}/air_quality", iter(range(99))

    def store(*batch):
        stream.store_batch(observed(spark, *batch), next(batches), f"{root}/history", f"{root}/current", "r1")

    yield database, store
    spark.sql(f"drop database {database} cascade")


def published(spark, database):
    return sorted((r.TARGETCITY, r.AQI) for r in spark.table(f"{database}.AIR_QUALITY_13_CITIES").collect())


def test_only_new_batches_are_published(spark, tmp_path, air, monkeypatch):
    database, store = air
    opened, read = [], ledger.read_batches
    monkeypatch.setattr(ledger, "read_batches", lambda *a: opened.append(df := read(*a)) or df)
    store("Boston", 7)
    store("Miami", 8, 2)
    loads = pipeline.publish_observations(spark, str(tmp_path), database)
    assert [load.rows for load in loads] == [3, 2]
    store("Denver", 9)
    loads = pipeline.publish_observations(spark, str(tmp_path), database)
    assert [load.rows for load in loads] == [1, 1]
    files = [{f.split("batch_id=")[1].split("/")[0] for f in df.inputFiles()} for df in opened]
    assert files == [{"0", "1"}, {"2"}]
    assert published(spark, database) == [("Boston", 7), ("Denver", 9), ("Miami", 8), ("Miami", 8)]
    assert [r.CITY for r in spark.table(f"{database}.AQI_REALTIME").collect()] == ["Denver"]

    again = pipeline.publish_observations(spark, str(tmp_path), database)
    assert [(load.loaded, load.reason) for load in again] == [(False, "nothing new")] * 2 and len(opened) == 2
    assert len(published(spark, database)) == 4
    kept = spark.table(f"{database}.AIR_QUALITY_13_CITIES_LOADS").filter("state = 'done'").orderBy("load_id").collect()
    assert [(r.load_id, r.row_count) for r in kept] == [(1, 3), (2, 1)]


@pytest.mark.parametrize("where", ["_write_partition", "_close"])
def test_a_failed_publish_neither_loses_nor_doubles(spark, tmp_path, air, monkeypatch, where):
    database, store = air
    store("Boston", 7)
    pipeline.publish_observations(spark, str(tmp_path), database)
    store("Miami", 8)
    monkeypatch.setattr(ledger, where, lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipeline.publish_observations(spark, str(tmp_path), database)
    monkeypatch.undo()
    store("Denver", 9)  # stored meanwhile
    pipeline.publish_observations(spark, str(tmp_path), database)
    assert published(spark, database) == [("Boston", 7), ("Denver", 9), ("Miami", 8)]
    pipeline.publish_observations(spark, str(tmp_path), database)
    assert len(published(spark, database)) == 3


def test_a_batch_that_is_being_written_is_left_for_the_next_publish(spark, tmp_path, air):
    database, store = air
    store("Boston", 7)
    half = tmp_path / "air_quality/history/run=r1/batch_id=1"
    observed(spark, "Miami", 8).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert ledger.finished_batches(spark, f"{tmp_path}/air_quality/history") == [("r1", 0)]
    pipeline.publish_observations(spark, str(tmp_path), database)
    assert published(spark, database) == [("Boston", 7)]


def test_nothing_stored_and_tables_of_another_kind(spark, tmp_path, air):
    database, _ = air
    assert {load.reason for load in pipeline.publish_observations(spark, str(tmp_path), database)} == {"nothing new"}
    spark.sql(f"create table {database}.plain (TARGETCITY string) using parquet")
    with pytest.raises(QualityError, match="not kept by loads"):
        ledger.declare_loads(spark, f"{database}.plain", "TARGETCITY string")


def test_epa_flow(spark, tmp_path):
    def item(value, year=2001):
        return {"state_code": "36", "county_code": "061", "year": year, "parameter": "Ozone", "arithmetic_mean": value,
                "state": "New York", "county": "New York"}

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "Boston_Ozone.json").write_text(json.dumps([item(1.0), item(2.0), item(None), item(5.0, 2002)]))
    (tmp_path / "raw" / "Elsewhere_NO2.json").write_text(json.dumps([item(4.0)], indent=1))
    assert pipeline.consolidate_epa(spark, f"{tmp_path}/raw/*.json", str(tmp_path)) == 5
    assert pipeline.build_epa(spark, str(tmp_path)) == {"epa_yearly_mean": 3, "epa_cities": 3}
    means = spark.read.parquet(f"{tmp_path}/curated/epa_yearly_mean")
    assert {(r.city, r.pollutant, r.year, r.arithmetic_mean) for r in means.collect()} == {
        ("Boston", "Ozone", 2001, 1.5), ("Boston", "Ozone", 2002, 5.0), ("Elsewhere", "NO2", 2001, 4.0)
    }


def test_places_flow(spark, tmp_path):
    (tmp_path / "codes.txt").write_text("01000  ALABAMA\n01001  Autauga\n03001  Nowhere\n72001  Adjuntas\n")
    names = [["NAME", "state", "county"], ["Autauga County, Alabama", "01", "001"], ["Nowhere, X", "03", "001"]]
    (tmp_path / "names.json").write_text(json.dumps(names, indent=1))
    out = str(tmp_path / "out")
    assert pipeline.load_places(spark, f"{tmp_path}/codes.txt", f"{tmp_path}/names.json", out) == (2, 1)
    places = scan_dimension(spark, f"{out}/places").orderBy("fips_code")
    assert [tuple(r) for r in places.collect()] == [
        ("01001", "01", "Alabama", "Autauga County", "001"),
        ("03001", "03", "State 03", "Nowhere", "001"),
    ]


def test_empty_bronze_stops_the_flow(spark, tmp_path):
    spark.createDataFrame([], schemas.BRONZE_GDP).write.parquet(f"{tmp_path}/bronze/gdp_data")
    with pytest.raises(QualityError, match="no rows"):
        pipeline.build_gdp(spark, str(tmp_path))


def test_growth_needs_one_shuffle(spark):
    """Window, county summary and written order share the placement by range."""
    df = spark.createDataFrame([], schemas.GDP_BY_YEAR)
    placed = gdp.county_summary(gdp.sequence(df.repartitionByRange("state_code", "fips_code")))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
