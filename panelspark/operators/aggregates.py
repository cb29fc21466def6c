"""Aggregate expressions and group-bys shared by all panels.

Extremes carry their label in one struct, so that a table of summaries is one
aggregation with a partial step before the shuffle, whatever the size of a group.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import hundredths, mean_of_hundredths


def _known(value: str, *labels: str) -> Column:
    return F.when(F.col(value).isNotNull(), F.struct(value, *labels))


def highest(value: str, period: str) -> Column:
    """struct(value, period) of the highest value; among equals the latest period."""
    return F.max(_known(value, period))


def lowest(value: str, period: str) -> Column:
    """struct(value, period) of the lowest value; among equals the earliest period."""
    return F.min(_known(value, period))


def deepest(value: str, period: str) -> Column:
    """struct(value, period) of the lowest value under zero; null where there is none."""
    return F.min(F.when(F.col(value) < 0, F.struct(value, period)))


def first_value(period: str, value: str) -> Column:
    return F.min(F.struct(period, value))


def last_value(period: str, value: str) -> Column:
    return F.max(F.struct(period, value))


def mean_percent(percent: str | Column) -> Column:
    """Mean of two-place percentages, rounded half-up to two places."""
    percent = F.col(percent) if isinstance(percent, str) else percent
    return mean_of_hundredths(F.sum(hundredths(percent)), F.count(percent))


def exact_mean(value: str, scale: int = 6) -> Column:
    """Unrounded mean over decimals, so that it does not depend on the order of rows."""
    number = F.col(value).cast(f"decimal(28,{scale})")
    return F.sum(number).cast("double") / F.count(number)


def winner(value: str, key: str, *labels: str) -> Column:
    """struct(rank, key, value, labels) with the highest value; among equals the smallest key."""
    return F.min(
        F.when(F.col(value).isNotNull(), F.struct((-F.col(value)).alias("rank"), key, value, *labels))
    )


def loser(value: str, key: str, *labels: str) -> Column:
    """struct(rank, key, value, labels) with the lowest value; among equals the smallest key."""
    return F.min(F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("rank"), key, value, *labels)))


def category_stats(df: DataFrame, category: str, value: str) -> DataFrame:
    """Count, mean, highest and lowest value per category, largest category first."""
    return (
        df.groupBy(category)
        .agg(
            F.count("*").alias("row_count"),
            F.avg(value).alias(f"avg_{value}"),
            F.max(value).alias(f"max_{value}"),
            F.min(value).alias(f"min_{value}"),
        )
        .orderBy(F.desc("row_count"), category)
    )


def period_span(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """First period, last period and row count per group."""
    return df.groupBy(*keys).agg(
        F.min(period).alias(f"first_{period}"),
        F.max(period).alias(f"last_{period}"),
        F.count("*").alias(f"{period}s_of_data"),
    )


def count_where_null(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: how many rows have no value in the column."""
    return df.agg(F.count_if(F.col(column).isNull()).alias(name))
