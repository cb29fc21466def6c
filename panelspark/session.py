"""The shared folder for files that must outlive a lost executor."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_made: dict[str, list[str]] = {}  # by application, the scratch folders not yet removed
_named: dict[str, list[str]] = {}  # and the catalog tables over some of them


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local-mode session gets a fresh temporary folder; any
    other session is refused, since executors could not see such a folder.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="panelspark-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)  # so that the next call finds the same folder
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for ``remove_scratch`` to delete."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A fresh name for a catalog table and a path for its files, both for ``remove_scratch`` to take away."""
    path = scratch_path(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[1]}"
    _named.setdefault(spark.sparkContext.applicationId, []).append(table)
    return table, path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this application, drop its scratch tables, and return the number of folders.

    Call it when the results that read them are written, at the latest before the session stops.
    """
    for table in _named.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {table}")
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark can reach."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: lineage cut, computed once.

    The planner then knows their true size, and broadcasts them in a join only if
    they are small.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
