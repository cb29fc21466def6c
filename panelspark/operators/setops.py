"""Concatenation and distinct."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of all batches, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
