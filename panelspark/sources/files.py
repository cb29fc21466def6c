"""Typed scans of CSV, JSON, Parquet and text."""

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelspark import schemas
from panelspark.functions.keys import CODE_LINE_PATTERN, entity_key_from_file
from panelspark.sources.records import scan_records


def scan_csv(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """CSV with a header line; columns bind by position, a bad value reads as null."""
    return spark.read.schema(ddl).option("header", True).option("enforceSchema", True).csv(path)


def scan_entity_csv(spark: SparkSession, path_glob: str | list[str], ddl: str = schemas.GDP_RAW) -> DataFrame:
    """One file per entity, with the entity key of the file name; other files give the key ""."""
    rows = scan_csv(spark, path_glob, ddl)
    return rows.withColumn("fips_code", entity_key_from_file(F.col("_metadata.file_name")))


def scan_dimension(spark: SparkSession, path: str, ddl: str = schemas.DIMENSION) -> DataFrame:
    """The columns of the dimension, found by their header names in any order and case; others are left out."""
    rows = spark.read.option("header", True).csv(path)  # text columns; reads the header lines
    given = {name.strip().lower(): name for name in rows.columns}
    wanted = StructType.fromDDL(ddl)
    if missing := [f.name for f in wanted if f.name.lower() not in given]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return rows.select([F.col(f"`{given[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in wanted])


def scan_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A Parquet folder read with its declared schema, so that partition values keep leading zeros."""
    return spark.read.schema(ddl).parquet(path)


def scan_json_dir(spark: SparkSession, path_glob: str, ddl: str | None = None) -> DataFrame:
    """JSON files (objects or indented arrays) with the name of their file as source_file.

    Without a schema the fields are inferred, which reads the files once more.
    """
    reader = spark.read.option("multiLine", True)
    if ddl:
        reader = reader.schema(ddl)
    return reader.json(path_glob).withColumn("source_file", F.col("_metadata.file_name"))


def scan_or_empty(spark: SparkSession, read: Callable[[], DataFrame], ddl: str) -> DataFrame:
    """What the read returns, or no rows of the schema if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def scan_observations(spark: SparkSession, path: str, ddl: str = schemas.AQI_OBSERVATION) -> DataFrame:
    """One batch of observations; a missing or malformed file gives no rows."""
    with_bad = f"{ddl}, _bad string"
    reader = spark.read.schema(with_bad).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad")
    return without_malformed(scan_or_empty(spark, lambda: reader.json(path), with_bad), ddl)


def without_malformed(rows: DataFrame, ddl: str) -> DataFrame:
    """The rows without their ``_bad`` column and without malformed files: those are one row with nothing but its text."""
    return rows.filter(~is_malformed([f.name for f in StructType.fromDDL(ddl)])).drop("_bad")


def is_malformed(fields: Sequence[str]) -> Column:
    """Whether a row is a malformed file: its text in ``_bad`` and no field."""
    return F.col("_bad").isNotNull() & F.coalesce(*[F.col(f).cast("string") for f in fields]).isNull()


def scan_wrapped_records(spark: SparkSession, path_glob: str, ddl: str = schemas.EPA_RECORD) -> DataFrame:
    """Records of files that hold a list, or an object with the list under ``Data``, however large a file is."""
    return scan_records(spark, path_glob, ddl).drop("source_file")


def parse_code_list(lines: DataFrame) -> DataFrame:
    """Codes of the lines ``<5 digits> <name>`` without the state rows, sorted."""
    code = F.regexp_extract("value", CODE_LINE_PATTERN, 1)
    return (
        lines.select(code.alias("fips_code"))
        .filter((F.col("fips_code") != "") & ~F.col("fips_code").endswith("000"))
        .orderBy("fips_code")
    )


def scan_code_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_code_list(spark.read.text(path))


def scan_place_names(spark: SparkSession, path: str) -> DataFrame:
    """fips_code and full_name of a JSON list of [name, state, county] rows below a header row."""
    rows = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.from_json("value", "array<array<string>>")).alias("line", "cells")
    )
    return rows.filter("line > 0").select(
        F.concat(F.col("cells")[1], F.col("cells")[2]).alias("fips_code"), F.col("cells")[0].alias("full_name")
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A published table of the catalog."""
    return spark.table(name)
