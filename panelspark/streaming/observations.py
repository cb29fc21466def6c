"""Air-quality observations as a stream: an append-only history and a current snapshot.

Landed files are read by a file stream, so many at a time as the caller admits; files that are done with can be moved
to an archive. A malformed file gives no rows and is set down by name beside the history.

Each micro-batch writes the folder ``run=<id>/batch_id=<n>`` of the history. The id belongs to the checkpoint, so a
batch that runs again after a failure replaces itself, and a store that starts
with a new checkpoint, whose numbers begin at 0 again, adds to the history.

A snapshot is a folder of its own; a row in a small pointer table says which one
counts. Readers see the old snapshot until that row is committed, and a snapshot
never shows rows the history lacks. One store at a time writes to a folder.
"""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelspark import schemas
from panelspark.plans.airquality import history_rows, latest_value, snapshot_rows
from panelspark.session import remove
from panelspark.sources.files import is_malformed, scan_or_empty, without_malformed

# The two cadences in use.
EVERY_20_MINUTES = "20 minutes"
EVERY_HOUR = "60 minutes"

HISTORY_READ = f"{schemas.AQI_HISTORY}, run string, batch_id bigint"
POINTER = "seq bigint, version string"
REJECTED = "file string, length bigint, run string, batch_id bigint"


def landed_observations(
    spark: SparkSession,
    path: str,
    ddl: str = schemas.AQI_OBSERVATION,
    files_per_batch: int | None = None,
    archive: str | None = None,
    keep_malformed: bool = False,
) -> DataFrame:
    """A stream over JSON files (objects or arrays) as they land under the path; malformed files give no rows.

    ``files_per_batch`` is the most that a batch takes in. ``archive``: a folder outside the path, to which files move
    once a later batch is done. With ``keep_malformed`` a malformed file is one row with its name, for the store to set down.
    """
    reader = spark.readStream.schema(f"{ddl}, _bad string").option("columnNameOfCorruptRecord", "_bad")
    reader = reader.option("multiLine", True).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.json(path)
    return rows.withColumn("_file", F.col("_metadata.file_path")) if keep_malformed else without_malformed(rows, ddl)


def store_batch(
    batch: DataFrame, batch_id: int, history_path: str, snapshot_path: str, run: str = "0", rejected_path: str | None = None
) -> None:
    """Append one batch to the history and make it the snapshot; a batch without rows changes neither.

    The write of the history is the only pass over the batch; malformed files in it are counted there, and only if there
    are some they are read once more for their names.
    """
    spark, place = batch.sparkSession, f"run={run}/batch_id={batch_id}"
    rows, seen = batch, Observation()
    if "_bad" in batch.columns:
        fields = [c for c in batch.columns if c not in ("_bad", "_file")]
        bad = is_malformed(fields)
        rows = batch.observe(seen, F.count_if(bad).alias("bad")).filter(~bad).select(fields)
    kept = Observation()
    folder = f"{history_path}/{place}"
    history_rows(rows).observe(kept, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
    if rejected_path and "_bad" in batch.columns and seen.get["bad"]:
        names = batch.filter(bad).select(F.col("_file").alias("file"), F.length("_bad").cast("bigint").alias("length"))
        names.coalesce(1).write.mode("overwrite").parquet(f"{rejected_path}/{place}")
    if not kept.get["rows"]:
        remove(spark, folder)
        return
    version = uuid.uuid4().hex
    stored = spark.read.schema(schemas.AQI_HISTORY).parquet(folder)
    snapshot_rows(stored).write.parquet(f"{snapshot_path}/versions/{version}")
    _count(spark, snapshot_path, version)


def _count(spark: SparkSession, snapshot_path: str, version: str) -> None:
    """From now on the version counts."""
    before = _pointers(spark, snapshot_path)
    last = before.agg(F.max("seq")).first()[0] or 0
    old = [r.version for r in before.filter(F.col("seq") == last - 1).collect()]
    row = spark.createDataFrame([(last + 1, version)], POINTER)
    row.coalesce(1).write.mode("append").parquet(f"{snapshot_path}/pointer")
    for gone in old:  # two back: readers of the one before may still be at work
        remove(spark, f"{snapshot_path}/versions/{gone}")


def _pointers(spark: SparkSession, snapshot_path: str) -> DataFrame:
    path = f"{snapshot_path}/pointer"
    return scan_or_empty(spark, lambda: spark.read.schema(POINTER).parquet(path), POINTER)


def run_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The id of the store that this checkpoint belongs to, made and kept beside it at its first start."""
    path = f"{checkpoint_path}/store"
    found = scan_or_empty(spark, lambda: spark.read.schema("value string").text(path), "value string").first()
    if found:
        return found.value
    own = uuid.uuid4().hex
    spark.createDataFrame([(own,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return own


def start_store(
    observations: DataFrame,
    history_path: str,
    snapshot_path: str,
    checkpoint_path: str,
    every: str | None = None,
    rejected_path: str | None = None,
) -> StreamingQuery:
    """Run the store: once over all landed files, or for good at the given interval.

    With ``rejected_path``, the malformed files of a stream that keeps them are set down there.
    """
    run = run_id(observations.sparkSession, checkpoint_path)
    writer = observations.writeStream.option("checkpointLocation", f"{checkpoint_path}/stream").foreachBatch(
        lambda batch, batch_id: store_batch(batch, batch_id, history_path, snapshot_path, run, rejected_path)
    )
    return writer.trigger(**_trigger(every)).start()


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def read_rejected(spark: SparkSession, rejected_path: str) -> DataFrame:
    """The malformed files set down so far, with the run and the batch that met them."""
    return scan_or_empty(spark, lambda: spark.read.schema(REJECTED).parquet(rejected_path), REJECTED)


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """All stored observations with the run and the batch they came in."""
    return spark.read.schema(HISTORY_READ).parquet(history_path)


def read_snapshot(spark: SparkSession, snapshot_path: str, ddl: str = schemas.AQI_SNAPSHOT) -> DataFrame:
    """The rows of the snapshot that counts; none before the first."""
    newest = _pointers(spark, snapshot_path).agg(F.max_by("version", "seq")).first()[0]
    if newest is None:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(f"{snapshot_path}/versions/{newest}")


def latest_stream(history: DataFrame) -> DataFrame:
    """The latest value per city and pollutant; on a stream, state is one row per pair.

    Unlike the snapshot it keeps a city that is missing from the last batch. The tie rule is that of ``latest_per_key``.
    """
    keys = [F.col("TARGETCITY").alias("CITY"), F.col("PARAMETERNAME").alias("POLLUTANT_TYPE")]
    return history.groupBy(*keys).agg(latest_value(["DATEOBSERVED", "HOUROBSERVED"]).alias("VALUE"))


def start_latest(history: DataFrame, latest_path: str, checkpoint_path: str, every: str | None = None) -> StreamingQuery:
    """Keep a table of the latest value per city and pollutant beside a stream of history rows.

    The state store holds one row for each pair and hands on the pairs that a batch has touched; they take
    the place of their old rows, all others stay. A batch that runs again puts the same rows in place.
    """
    rows = latest_stream(history)
    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint_path)
    return writer.foreachBatch(lambda batch, _: _put_latest(batch, latest_path)).trigger(**_trigger(every)).start()


def _put_latest(changed: DataFrame, latest_path: str) -> None:
    spark, version = changed.sparkSession, uuid.uuid4().hex
    now = read_snapshot(spark, latest_path)
    rows = now.withColumn("new", F.lit(0)).unionByName(changed.withColumn("new", F.lit(1)))
    latest = rows.groupBy("CITY", "POLLUTANT_TYPE").agg(F.max_by("VALUE", "new").alias("VALUE"))
    latest.write.parquet(f"{latest_path}/versions/{version}")
    _count(spark, latest_path, version)
