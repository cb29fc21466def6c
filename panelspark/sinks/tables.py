"""Catalog tables: declared targets, append, snapshot, truncate-and-reload, export."""

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelspark import schemas
from panelspark.operators.quality import QualityError, require_unique
from panelspark.session import remove
from panelspark.sinks.ledger import declare_loads

#: Declared warehouse tables and their columns.
WAREHOUSE = {
    **{name.upper(): ddl for name, ddl in schemas.GOLD.items() if name != "population_by_year"},
    "POPULATION_DATA": schemas.POPULATION_DATA,
    "AQI_REALTIME": schemas.AQI_SNAPSHOT,
}

#: Declared tables that only grow, by loads.
GROWING = {"AIR_QUALITY_13_CITIES": schemas.AQI_HISTORY}

#: Property of a table: the folder it read before the last reload.
BEFORE = "panelspark.before"

#: Declared keys, checked before a load.
PRIMARY_KEYS = {"POPULATION_DATA": ["FIPS_CODE", "YEAR"]}


@dataclass(frozen=True)
class Load:
    """Outcome of loading one table."""

    table: str
    loaded: bool
    reason: str = ""
    rows: int = 0


def declare_table(spark: SparkSession, name: str, ddl: str) -> None:
    """Create the table unless it exists."""
    spark.sql(f"create table if not exists {name} ({ddl}) using parquet")


def declare_warehouse(spark: SparkSession, database: str = "default") -> None:
    for name, ddl in WAREHOUSE.items():
        declare_table(spark, f"{database}.{name}", ddl)
    for name, ddl in GROWING.items():
        declare_loads(spark, f"{database}.{name}", ddl)


def append_rows(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace the table, its definition included."""
    df.write.mode("overwrite").saveAsTable(name)


def reload_table(df: DataFrame, name: str, key: Sequence[str] = ()) -> int:
    """Replace the rows, keep the definition, return the rows; an empty input leaves the table alone.

    The rows are written once, to a folder beside the table, and audited there: what is lost to the declared types is
    counted by the write itself, and a key is looked at in the written key columns. Only then does the table move to the
    new folder, in one step of the catalog. A column that the input lacks, a value that its declared type cannot hold or
    a repeated key is an error that leaves the table with its old rows. The folder before stays for readers at
    work until the next reload.
    """
    spark = df.sparkSession
    declared = spark.table(name).schema
    given = {c.lower() for c in df.columns}
    if missing := [f.name for f in declared if f.name.lower() not in given]:
        if df.isEmpty():
            return 0
        raise QualityError(f"rows for {name} lack {', '.join(missing)}")
    cast = [F.col(f.name).try_cast(f.dataType) for f in declared]
    lost = [F.count_if(F.col(f.name).isNotNull() & c.isNull()).alias(f"lost_{i}") for i, (f, c) in enumerate(zip(declared, cast))]
    seen, old = Observation(), _location(spark, name)
    new = f"{re.sub('-v[0-9a-f]{32}$', '', old)}-v{uuid.uuid4().hex}"
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *lost)
    observed.select([c.alias(f.name) for f, c in zip(declared, cast)]).write.parquet(new)
    try:
        if bad := [f"{f.name} ({seen.get[f'lost_{i}']})" for i, f in enumerate(declared) if seen.get[f"lost_{i}"]]:
            raise QualityError(f"values that {name} cannot hold: {', '.join(bad)}")
        if not seen.get["rows"]:
            remove(spark, new)
            return 0
        if key:
            require_unique(spark.read.schema(declared).parquet(new), list(key), name)
    except QualityError:
        remove(spark, new)
        raise
    _move(spark, name, old, new)
    return seen.get["rows"]


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").collect()
    return rows[-1].data_type.rstrip("/")


def _move(spark: SparkSession, name: str, old: str, new: str) -> None:
    """Let the table read the new folder; the one before the old goes."""
    gone = spark.sql(f"show tblproperties {name}").filter(F.col("key") == BEFORE).collect()
    spark.sql(f"alter table {name} set location '{new}'")
    spark.catalog.refreshTable(name)
    spark.sql(f"alter table {name} set tblproperties ('{BEFORE}' = '{old}')")
    for row in gone:
        remove(spark, row.value)


def export_tables(spark: SparkSession, paths: Mapping[str, str], database: str = "default") -> list[Load]:
    """Load Parquet folders into their declared tables; a missing folder is reported and skipped."""
    return [_export(spark, f"{database}.{name}", path, PRIMARY_KEYS.get(name)) for name, path in paths.items()]


def _export(spark: SparkSession, name: str, path: str, key: list[str] | None) -> Load:
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return Load(name, False, "not found")
    return load(rows, name, key)


def load(rows: DataFrame, name: str, key: list[str] | None = None) -> Load:
    """Reload one declared table, its key checked."""
    count = reload_table(rows, name, key or ())
    return Load(name, True, rows=count) if count else Load(name, False, "empty")
