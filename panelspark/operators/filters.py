"""Row filters on plain columns, so that they reach the file scan."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def exclude_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose value is not in the list; null is dropped too."""
    return df.filter(~F.col(column).isin(list(values)))


def keep_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def split_by_flag(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the flag set, rows with it unset)."""
    return df.filter(F.col(column)), df.filter(~F.col(column))


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns turned into numbers; rows where one of them is not a number are dropped."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns}).dropna(subset=list(columns))


def preview(df: DataFrame, order: Sequence[str], first: int) -> DataFrame:
    """The first n rows in the given order, to look at a table."""
    return df.orderBy(*order).limit(first)
