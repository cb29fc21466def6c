import statistics

import pytest
from pyspark.sql import functions as F

from panelspark.operators import ranking


@pytest.fixture()
def nothing_sent_or_split(spark):
    """Joins shuffle, and Spark does not split or merge their partitions."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_ties_do_not_meet_in_one_task(spark, nothing_sent_or_split):
    """Nine of ten rows tie at the lowest value of three groups, one of which has half of all rows."""
    df = spark.range(120_000).select(
        F.when(F.col("id") % 4 < 2, "hot").otherwise((F.col("id") % 4).cast("string")).alias("state"),
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(0).alias("value"),
        F.lpad(F.col("id").cast("string"), 8, "0").alias("code"),
        F.concat(F.lit("Place "), F.col("id").cast("string")).alias("name"),
    )
    tied = ranking._at_extremes(df, ["state"], "value", "code", "name", ["best", "worst"])
    tasks = [r["count"] for r in tied.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 108_001 + 2 + 30_000 and len(tasks) == 8  # the third group ties at both ends
    assert max(tasks) <= 3 * statistics.median(tasks)
    found = {r.state: (r.best[:], r.worst[:]) for r in ranking.extremes(df, ["state"], "value", "code", "name").collect()}
    assert found == {
        "hot": (("00119980", "Place 119980", 119980), ("00000000", "Place 0", 0)),
        "2": (("00119990", "Place 119990", 119990), ("00000002", "Place 2", 0)),
        "3": (("00000003", "Place 3", 0), ("00000003", "Place 3", 0)),
    }


def test_extremes_with_null_groups_values_and_one_side(spark, rows):
    data = [(None, 1, "b", "B"), (None, 1, "a", "A"), ("x", None, "c", "C"), ("y", 5, "d", None), ("y", 5, "d", "D"), ("y", 2, "e", "E")]
    df = spark.createDataFrame(data, "g string, v int, k string, l string")
    best = {r.g: r.best and r.best[:] for r in ranking.extremes(df, ["g"], "v", "k", "l", ["best"]).collect()}
    assert best == {None: ("a", "A", 1), "y": ("d", None, 5)}
    empty = ranking.extremes(df.limit(0), ["g"], "v", "k", "l")
    assert empty.isEmpty() and empty.columns == ["g", "best", "worst"]
