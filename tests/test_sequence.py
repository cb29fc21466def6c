"""Previous value and running peak, plain and split, against a loop over sorted rows."""

import random

import pytest

from panelspark.operators import sequence as S

DDL = "e string, p int, v bigint"


def brute_force(rows):
    out, last, top = [], {}, {}
    for e, p, v in sorted(rows, key=lambda r: (str(r[0]), r[1], (r[2] is not None, r[2] or 0))):
        previous = last.get(e)
        if v is not None:
            top[e] = max(v, top.get(e, v))
        out.append((e, p, v, previous, top.get(e)))
        last[e] = v
    return out


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    rows = [("hot", rng.randint(1, 30), rng.randint(-5, 1000)) for _ in range(900)]
    rows += [(None, rng.randint(1, 30), rng.randint(1, 1000)) for _ in range(300)]
    rows += [("same", 2000, 7)] * 400
    rows += [("gaps", y, None if y % 3 == 0 else y * 2) for y in range(200)]
    rows += [(f"e{n % 90}", n, n * 37 % 101) for n in range(900)]
    rng.shuffle(rows)
    return rows


def test_plain(spark, skewed):
    df = spark.createDataFrame(skewed, DDL).repartition(5)
    found = [tuple(r) for r in S.with_previous_and_peak(df, ["e"], "p", "v").collect()]
    assert sorted(found, key=key) == sorted(brute_force(skewed), key=key)


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_split(spark, skewed, slices):
    df = spark.createDataFrame(skewed, DDL).repartition(5)
    split = S.with_previous_and_peak_split(df, ["e"], "p", "v", slices=slices)
    found = [tuple(r) for r in split.collect()]
    assert sorted(found, key=key) == sorted(brute_force(skewed), key=key)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_split_of_few_rows(spark, count):
    rows = [("a", n, 10 - n) for n in range(count)]
    found = S.with_previous_and_peak_split(spark.createDataFrame(rows, DDL), ["e"], "p", "v").collect()
    assert sorted(tuple(r) for r in found) == brute_force(rows)


def test_split_spreads_a_hot_entity(spark):
    """No slice of a table with a single entity holds much more than its share."""
    df = spark.range(40_000).selectExpr("'x' e", "cast(id % 7 as int) p", "cast(1 as bigint) v")
    split = S.with_previous_and_peak_split(df, ["e"], "p", "v", slices=8)
    assert split.count() == 40_000
    sizes = (
        df.selectExpr("*", "rand(7) t").repartitionByRange(8, "e", "p", "v", "t").selectExpr("spark_partition_id() s")
    ).groupBy("s").count()
    assert max(r["count"] for r in sizes.collect()) < 40_000 / 8 * 2
    assert split.filter("previous is null").count() == 1


def test_invariants(spark, skewed):
    df = S.with_previous_and_peak_split(spark.createDataFrame(skewed, DDL), ["e"], "p", "v")
    assert df.filter("peak < v").count() == 0
    assert df.count() == len(skewed)
