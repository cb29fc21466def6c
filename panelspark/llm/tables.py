"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelspark.session import remove, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with the SQL that gives the same rows where SQL can."""

    def add(build: Query) -> Query:
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str = "llm") -> DataFrame:
    """The rows written to the shared folder and read again: computed once, lineage cut, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Deletes the files of stored tables that are not read again."""
    for df in tables:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()[:1]}:
            remove(df.sparkSession, folder)
