"""Which input files have changed since they were last loaded."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.sources.files import scan_or_empty

MANIFEST = "path string, length bigint, modified timestamp"


def listed_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """(path, length, modified) of the files, without opening any."""
    files = spark.read.format("binaryFile").load(path_glob)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_manifest(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The files as they were when loaded last; none before the first load."""
    return scan_or_empty(spark, lambda: spark.read.schema(ddl).parquet(path), ddl)


def changed(now: DataFrame, before: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The distinct values, in some columns, of the rows that only one of two manifests has: files that came, went, were
    written anew, or belong elsewhere now."""
    seen = now.withColumn("_now", F.lit(1)).unionByName(before.withColumn("_now", F.lit(-1)))
    return seen.groupBy(*now.columns).agg(F.sum("_now").alias("_now")).filter("_now <> 0").select(*keep).distinct()
