"""Appends to a catalog table that count once, and read only what is new.

Rows arrive in numbered batches of runs. The table is partitioned by load: all batches that one publish finds new are
one load, one partition. Beside the table stands its ledger, to which a load first writes which batches it takes
(``planned``), and when its partition is written, that it is done. A load that was planned and never done, because the
job failed anywhere in between, is carried out again with the same batches over the same partition: nothing is lost and
nothing doubled, and its rows are not to be seen twice at any time. One job at a time publishes to a table.
"""

import re
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelspark.operators.project import normalize_to_schema
from panelspark.operators.quality import QualityError

LOAD_COLUMN = "LOAD_ID"
LEDGER = "load_id bigint, state string, run string, batch_id bigint, row_count bigint"
BATCH = "run string, batch_id bigint"
PLANNED, DONE = "planned", "done"

Batch = tuple[str, int]


def ledger_of(name: str) -> str:
    return f"{name}_LOADS"


def declare_loads(spark: SparkSession, name: str, ddl: str) -> None:
    """Create the table, partitioned by load, and its ledger, unless they exist."""
    spark.sql(f"create table if not exists {name} ({ddl}, {LOAD_COLUMN} bigint) using parquet partitioned by ({LOAD_COLUMN})")
    if LOAD_COLUMN not in spark.table(name).columns:
        raise QualityError(f"{name} is not kept by loads: move its rows away and drop it")
    spark.sql(f"create table if not exists {ledger_of(name)} ({LEDGER}) using parquet")


def finished_batches(spark: SparkSession, history_path: str) -> list[Batch]:
    """The batches whose folder ``run=<id>/batch_id=<n>`` is wholly written, by one listing of names."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{history_path}/run=*/batch_id=*/_SUCCESS")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [re.search(r"/run=([^/]*)/batch_id=(\d+)/_SUCCESS$", file.getPath().toString()) for file in files or ()]
    return sorted((m[1], int(m[2])) for m in names if m)


def read_batches(spark: SparkSession, history_path: str, ddl: str, batches: Iterable[Batch]) -> DataFrame:
    """The rows of some batches; no other file is opened."""
    return spark.read.schema(ddl).parquet(*(f"{history_path}/run={run}/batch_id={n}" for run, n in batches))


def load_new(spark: SparkSession, name: str, found: Sequence[Batch], read: Callable[[list[Batch]], DataFrame]) -> int:
    """Load the batches that the ledger does not have; returns the rows added, those of a load left open included."""
    ledger = spark.table(ledger_of(name))
    done = ledger.filter(F.col("state") == DONE).select("load_id")
    added = 0
    for row in ledger.filter(F.col("state") == PLANNED).select("load_id").distinct().join(done, "load_id", "left_anti").orderBy("load_id").collect():
        added += _carry_out(spark, name, row.load_id, read)
    given = spark.createDataFrame(list(found), BATCH) if found else spark.createDataFrame([], BATCH)
    known = spark.table(ledger_of(name)).filter(F.col("state") == PLANNED).select("run", "batch_id")
    new = given.join(known, ["run", "batch_id"], "left_anti")
    if new.isEmpty():
        return added
    load_id = (spark.table(ledger_of(name)).agg(F.max("load_id")).first()[0] or 0) + 1
    plan = new.select(F.lit(load_id).cast("bigint"), F.lit(PLANNED), "run", "batch_id", F.lit(None).cast("bigint"))
    plan.coalesce(1).write.insertInto(ledger_of(name))  # one file: all of the plan or none
    return added + _carry_out(spark, name, load_id, read)


def _carry_out(spark: SparkSession, name: str, load_id: int, read: Callable[[list[Batch]], DataFrame]) -> int:
    plan = spark.table(ledger_of(name)).filter((F.col("load_id") == load_id) & (F.col("state") == PLANNED))
    batches = sorted((r.run, r.batch_id) for r in plan.select("run", "batch_id").collect())
    rows = _write_partition(spark, name, load_id, read(batches))
    _close(spark, name, load_id, rows)
    return rows


def _write_partition(spark: SparkSession, name: str, load_id: int, rows: DataFrame) -> int:
    """Replace one partition of the table, and no other; returns its rows."""
    declared = StructType([f for f in spark.table(name).schema if f.name != LOAD_COLUMN])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in declared)
    seen, view = Observation(), f"load_{uuid.uuid4().hex}"
    normalize_to_schema(rows, ddl).observe(seen, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView(view)
    try:
        spark.sql(f"insert overwrite table {name} partition ({LOAD_COLUMN} = {load_id}) select * from {view}")
    finally:
        spark.catalog.dropTempView(view)
    return seen.get["rows"]


def _close(spark: SparkSession, name: str, load_id: int, rows: int) -> None:
    done = spark.createDataFrame([(load_id, DONE, None, None, rows)], LEDGER)
    done.coalesce(1).write.insertInto(ledger_of(name))
