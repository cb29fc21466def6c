"""Scratch folders: where they are, and that none is left."""

import os

from panelspark import session


def test_scratch_folders_are_removed(spark):
    session.remove_scratch(spark)
    df = session.written(spark.range(5))
    path = session.scratch_path(spark, "free")
    spark.range(1).write.parquet(path)
    assert df.count() == 5 and os.path.isdir(path)
    assert session.remove_scratch(spark) == 2
    assert not os.path.exists(path) and not os.path.exists(df.inputFiles()[0].removeprefix("file://"))
    assert session.remove_scratch(spark) == 0
