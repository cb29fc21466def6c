"""Parquet and JSON folders."""

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows and an observation that counts them while they are written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_partitioned(df: DataFrame, path: str, partition: str, given_only: bool = False) -> int:
    """Replace a Parquet folder, one sub-folder per partition value; returns the rows written.

    With ``given_only`` the sub-folders of values without a row stay as they are. Rows are gathered by partition value. ``rebalance`` lets adaptive execution cut a
    value with many rows into several tasks and files, and merge the small ones.
    """
    rows, seen = _counted(df.hint("rebalance", F.col(partition)))
    writer = rows.write.mode("overwrite").partitionBy(partition)
    writer = writer.option("partitionOverwriteMode", "dynamic" if given_only else "static")
    writer.parquet(path, compression="snappy")
    return seen.get["rows"]


def write_table(df: DataFrame, path: str, order: Sequence[str] = (), placed: bool = False) -> int:
    """Replace a Parquet folder, rows in global order if one is given; returns the rows written.

    ``placed``: the rows already lie in ranges of the leading order columns and only
    need sorting inside their partition.
    """
    if order and not placed:
        df = df.repartitionByRange(*order)
    rows, seen = _counted(df.sortWithinPartitions(*order) if order else df)
    rows.write.mode("overwrite").parquet(path, compression="snappy")
    return seen.get["rows"]


def write_single_file(df: DataFrame, path: str) -> None:
    """Replace a Parquet folder by one file; for outputs that one task can write."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Replace a folder of CSV files with headers; ``single``: one file, for outputs that one task can write."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Replace a folder of JSON lines."""
    df.write.mode("overwrite").json(path)


def write_json_arrays(df: DataFrame, path: str, wrapped: bool = False) -> None:
    """Replace a folder of JSON documents, one for each partition that has rows: a list of objects, or with ``wrapped`` an
    object that holds it under ``Data``."""

    def run(batches):
        begun = False
        for batch in batches:
            lines = [f",{t}" for t in batch.column("value").to_pylist()]
            if lines and not begun:
                lines[0], begun = ('{"Data": [' if wrapped else "[") + lines[0][1:], True
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array(["]}" if wrapped else "]"])], ["value"])

    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    rows.mapInArrow(run, "value string").write.mode("overwrite").text(path)


def read_back_count(spark: SparkSession, path: str) -> int:
    """Rows found in a written Parquet folder."""
    return spark.read.parquet(path).count()
