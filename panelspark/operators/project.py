"""Projections: renames, flattening, schema normalisation, load stamps."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Only the mapped columns, in mapping order, under their new names."""
    return df.select([F.col(old).alias(new) for old, new in mapping.items()])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """All columns, the mapped ones under their new names."""
    return df.withColumnsRenamed(dict(mapping))


def normalize_names(df: DataFrame) -> DataFrame:
    """Upper-case names with blanks turned into underscores."""
    return df.toDF(*[name.upper().replace(" ", "_") for name in df.columns])


def flatten_struct(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Struct fields as columns of their own (field -> new name), the struct dropped.

    A table without the column is returned as it is.
    """
    if column not in df.columns:
        return df
    return df.withColumns({new: F.col(f"{column}.{field}") for field, new in fields.items()}).drop(column)


def parse_json_column(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """JSON text replaced by a struct with the declared fields."""
    return df.withColumn(column, F.from_json(column, ddl))


def normalize_to_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of the schema: absent ones null, present ones cast or null."""
    present = {name.lower(): name for name in df.columns}

    def field(name: str, data_type) -> Column:
        if name.lower() not in present:
            return F.lit(None).cast(data_type).alias(name)
        return F.col(present[name.lower()]).try_cast(data_type).alias(name)

    return df.select([field(f.name, f.dataType) for f in StructType.fromDDL(ddl)])


def tag(df: DataFrame, column: str, value: str) -> DataFrame:
    """The same text on every row of a batch."""
    return df.withColumn(column, F.lit(value))


def stamp_load_time(df: DataFrame, column: str = "processed_at") -> DataFrame:
    """The start time of the query as a column."""
    return df.withColumn(column, F.current_timestamp())


def flag(df: DataFrame, condition: Column, column: str, yes: str = "Yes", no: str = "No") -> DataFrame:
    """A two-valued text column; an unknown condition counts as no."""
    return df.withColumn(column, F.when(condition, yes).otherwise(no))
