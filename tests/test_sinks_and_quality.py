import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelspark import schemas
from panelspark.operators import quality as Q
from panelspark.sinks import files as K
from panelspark.sinks import tables as T
from panelspark.sources.files import scan_table


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(
        [("01001", 2001, 10), ("01003", 2001, 20), ("02020", 2002, 30)], "FIPS_CODE string, YEAR int, TOTAL_POPULATION int"
    )


def test_partitioned_write_keeps_leading_zeros_and_nulls(spark, tmp_path):
    rows = [("01001", "01", 1), ("02020", "02", 2), ("99999", None, 3)]
    df = spark.createDataFrame(rows, "fips_code string, state_code string, gdp_value int")
    path = str(tmp_path / "bronze")
    assert K.write_partitioned(df, path, "state_code") == 3
    back = scan_table(spark, path, "fips_code string, gdp_value int, state_code string")
    assert sorted((r.fips_code, r.state_code) for r in back.collect())[0] == ("01001", "01")
    assert back.filter("state_code is null").count() == 1
    pruned = back.filter("state_code = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state_code" in pruned
    assert K.write_partitioned(df.limit(1), path, "state_code") == 1 and K.read_back_count(spark, path) == 1


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(200_000).repartition(8).selectExpr(
            "if(id % 3 = 0, 'hot', cast(id % 40 as string)) as k", "id", "md5(cast(id as string)) as filler"
        )
        path = str(tmp_path / "skewed")
        assert K.write_partitioned(df, path, "k") == 200_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len([f for f in os.listdir(f"{path}/k=hot") if f.endswith(".parquet")]) > 1


def test_table_in_global_order(spark, tmp_path):
    df = spark.range(5000).selectExpr("cast(id * 7919 % 5000 as int) as k").repartition(4)
    path = str(tmp_path / "sorted")
    assert K.write_table(df, path, ["k"]) == 5000
    parts = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    values = [r.k for f in parts for r in spark.read.parquet(f"{path}/{f}").collect()]
    assert values == list(range(5000))


def test_single_file_and_json(spark, tmp_path):
    df = spark.range(100).repartition(4)
    K.write_single_file(df, str(tmp_path / "one"))
    assert len([f for f in os.listdir(tmp_path / "one") if f.endswith(".parquet")]) == 1
    K.write_json(df, str(tmp_path / "json"))
    assert spark.read.schema("id bigint").json(str(tmp_path / "json")).count() == 100


def wide(people):
    """The rows with all columns of the declared table."""
    return people.withColumns({f.name: F.lit(1) for f in StructType.fromDDL(schemas.POPULATION_DATA) if f.name not in people.columns})


def test_append_replace_and_reload(spark, people):
    people = wide(people)
    T.append_rows(people, "sink_demo")
    T.append_rows(people, "sink_demo")
    assert spark.table("sink_demo").count() == 6
    T.replace_table(people.limit(2), "sink_demo")
    assert spark.table("sink_demo").count() == 2
    T.declare_table(spark, "POPULATION_DATA", schemas.POPULATION_DATA)
    assert T.reload_table(people, "POPULATION_DATA")
    assert T.reload_table(people, "POPULATION_DATA")
    table = spark.table("POPULATION_DATA")
    assert table.count() == 3 and dict(table.dtypes)["TOTAL_POPULATION"] == "bigint"
    assert not T.reload_table(people.limit(0), "POPULATION_DATA")
    assert spark.table("POPULATION_DATA").count() == 3


def test_reload_refuses_lost_values_and_missing_columns(spark, people):
    T.declare_table(spark, "strict_demo", "FIPS_CODE string, YEAR int, TOTAL_POPULATION bigint")
    spoiled = spark.createDataFrame([("1", "x", "1e30")], "FIPS_CODE string, YEAR string, TOTAL_POPULATION string")
    with pytest.raises(Q.QualityError, match=r"YEAR \(1\), TOTAL_POPULATION \(1\)"):
        T.reload_table(spoiled, "strict_demo")
    with pytest.raises(Q.QualityError, match="lack TOTAL_POPULATION"):
        T.reload_table(people.select("FIPS_CODE", "YEAR"), "strict_demo")
    assert spark.table("strict_demo").count() == 0


def test_reload_reads_its_input_once_and_moves_after_the_audit(spark, people, tmp_path):
    name = "audited_demo"
    T.declare_table(spark, name, "FIPS_CODE string, YEAR int, TOTAL_POPULATION bigint")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def rows_of(df):
        return df.mapInArrow(count, df.schema)

    assert T.reload_table(rows_of(people), name, ["FIPS_CODE", "YEAR"]) == 3 and read.value == 3
    first = T._location(spark, name)
    with pytest.raises(Q.QualityError, match="repeats a key"):
        T.reload_table(people.union(people), name, ["FIPS_CODE", "YEAR"])
    assert T._location(spark, name) == first and spark.table(name).count() == 3
    spoiled = spark.createDataFrame([("1", "x", 5)], "FIPS_CODE string, YEAR string, TOTAL_POPULATION int")
    with pytest.raises(Q.QualityError, match="cannot hold"):
        T.reload_table(spoiled, name)
    folders = lambda: {f for f in os.listdir(os.path.dirname(first.removeprefix("file:"))) if f.startswith(name)}
    assert len(folders()) == 2 and spark.table(name).count() == 3  # the folder now and the one before
    old = spark.table(name)
    assert T.reload_table(people.limit(1), name) == 1 and spark.table(name).count() == 1
    assert old.count() == 3  # a reader at work keeps the rows it began with
    assert T.reload_table(people, name) == 3 and len(folders()) == 2 and spark.table(name).count() == 3


def test_an_absent_key_column_fails_its_check(people):
    report = Q.table_report(people, "t", Q.Expectation(1, ("year", "gone")))
    assert {(r.check_name, r.passed) for r in report.collect()} == {("min_rows", True), ("no_nulls_year", True), ("no_nulls_gone", False)}


def test_export(spark, people, tmp_path):
    T.declare_warehouse(spark)
    people = wide(people)
    people.write.mode("overwrite").parquet(str(tmp_path / "people"))
    people.limit(0).write.parquet(str(tmp_path / "none"))
    loads = T.export_tables(
        spark,
        {
            "POPULATION_DATA": str(tmp_path / "people"),
            "GDP_BY_YEAR": str(tmp_path / "missing"),
            "AQI_REALTIME": str(tmp_path / "none"),
        },
    )
    assert [(x.loaded, x.reason) for x in loads] == [(True, ""), (False, "not found"), (False, "empty")]
    people.unionByName(people).write.parquet(str(tmp_path / "twice"))
    with pytest.raises(Q.QualityError, match="repeats a key"):
        T.export_tables(spark, {"POPULATION_DATA": str(tmp_path / "twice")})


# --- gates -----------------------------------------------------------------


def test_gates_pass_and_fail(spark, people):
    assert Q.require_rows(people, "people") is people
    assert Q.require_unique(people, ["FIPS_CODE", "YEAR"], "people") is people
    with pytest.raises(Q.QualityError, match="no rows"):
        Q.require_rows(people.limit(0), "people")
    with pytest.raises(Q.QualityError, match="YEAR"):
        Q.require_unique(people, ["YEAR"], "people")


def test_report_finds_planted_faults(spark, people):
    with_null = people.unionByName(spark.createDataFrame([(None, 2001, 1)], people.schema))
    expected = {"a": Q.Expectation(3, ("FIPS_CODE", "YEAR")), "b": Q.Expectation(5, ("FIPS_CODE",)), "c": Q.Expectation()}
    report = Q.quality_report({"a": people, "b": with_null, "c": people.limit(0)}, expected)
    failed = {(r.table_name, r.check_name): r.observed for r in report.filter("not passed").collect()}
    assert failed == {("b", "min_rows"): 4, ("b", "no_nulls_FIPS_CODE"): 1, ("c", "min_rows"): 0}
    assert {r.table_name: r.verdict for r in Q.verdicts(report).collect()} == {"a": "PASSED", "b": "FAILED", "c": "FAILED"}
    with pytest.raises(Q.QualityError, match="b.min_rows=4"):
        Q.require_passed(report)
    Q.require_passed(report.filter(F.col("table_name") == "a"))


def test_profiles(people):
    assert tuple(Q.profile(people, "FIPS_CODE", "YEAR").first()) == (3, 3, 2)
    assert tuple(Q.null_profile(people, ["FIPS_CODE", "YEAR"]).first()) == (0, 0)
    assert [tuple(r) for r in Q.duplicate_keys(people, ["YEAR"]).collect()] == [(2001, 2)]


def test_counts_from_bitmaps(spark, rows):
    data = [("001", 2001, "a"), ("001", 2001, "a"), ("001", 2002, "a"), ("002", 2002, "a"), ("002", 2001, "b"), ("40000", None, "b"), (None, 2001, "b"), ("99999999999", 2001, None)]
    df = spark.createDataFrame(data, "code string, year int, state string")
    assert Q.profile_codes(df, "code", "year").collect() == Q.profile(df, "code", "year").collect()
    assert Q.profile_codes(df.limit(0), "code", "year").first()[:] == (0, 0, 0)
    plan = Q.profile_codes(df, "code", "year")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    fine = Q.distinct_bitmaps(df, ["state", "year"], "code")
    assert rows(Q.distinct_counts(fine, ["state"], "n")) != rows(df.groupBy("state").agg(F.countDistinct("code")))
    merged = Q.merged_bitmaps(fine, ["state"])
    assert rows(Q.distinct_counts(merged, ["state"], "n")) == rows(df.filter("code is not null").groupBy("state").agg(F.countDistinct("code")))
