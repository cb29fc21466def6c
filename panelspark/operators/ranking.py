"""Best and worst entity of each group."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.aggregates import loser, mean_percent, winner
from panelspark.session import written


def mean_growth(growth: DataFrame, keys: Sequence[str], rate: str = "yoy_growth_rate") -> DataFrame:
    """Mean growth of each entity that has any."""
    return growth.filter(F.col(rate).isNotNull()).groupBy(*keys).agg(mean_percent(rate).alias("avg_growth"))


def best_in_group(df: DataFrame, group: Sequence[str], value: str, key: str, label: str) -> DataFrame:
    """Group, label and value of the row with the highest value, in one aggregation."""
    return _picked(df, group, winner(value, key, label), label, value)


def worst_in_group(df: DataFrame, group: Sequence[str], value: str, key: str, label: str) -> DataFrame:
    """Group, label and value of the row with the lowest value, in one aggregation."""
    return _picked(df, group, loser(value, key, label), label, value)


def _picked(df: DataFrame, group: Sequence[str], pick: Column, label: str, value: str) -> DataFrame:
    return (
        df.groupBy(*group)
        .agg(pick.alias("pick"))
        .filter(F.col("pick").isNotNull())
        .select(*group, F.col(f"pick.{label}").alias(label), F.col(f"pick.{value}").alias(value))
    )


#: Parts in which the rows that may tie at an extreme meet it.
PARTS = 16


def extremes(
    df: DataFrame, group: Sequence[str], value: str, key: str, label: str, sides: Sequence[str] = ("best", "worst")
) -> DataFrame:
    """Group, best and worst, or one of them: struct(key, label, value), ties by the smallest key; for large tables.

    An aggregate that carries text makes Spark sort all rows by group. Here the
    rows only pass a hash aggregation of numbers. Its result, one row per group, is
    written, and the rows that hold an extreme are joined back: by broadcast if the
    written table is small, else on (group, value, part). Rows that tie are dealt to
    the parts by their key, so however many there are, no task gets more than its
    share; there each part leaves its first row, and at last the first of those counts.
    """
    found = _at_extremes(df, group, value, key, label, sides)
    row = F.struct(key, label, value)
    first = found.groupBy(*group, "side", "part").agg(F.min(row).alias("row"))
    return first.groupBy(*group).agg(*[F.min(F.when(F.col("side") == side, F.col("row"))).alias(side) for side in sides])


def _at_extremes(
    df: DataFrame, group: Sequence[str], value: str, key: str, label: str, sides: Sequence[str]
) -> DataFrame:
    """The rows that hold an extreme of their group, with its side and their part."""
    pick = {"best": F.max(value), "worst": F.min(value)}
    bounds = df.groupBy(*group).agg(*[pick[side].alias(side) for side in sides])
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    bounds = written(bounds.unpivot(list(group), list(sides), "side", "bound").filter("bound is not null").select("*", parts))
    facts = df.select(*group, value, key, label, F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int").alias("part"))
    same = [F.col(f"facts.{c}").eqNullSafe(F.col(f"bounds.{c}")) for c in group]
    same += [F.col(f"facts.{value}") == F.col("bounds.bound"), F.col("facts.part") == F.col("bounds.part")]
    return facts.alias("facts").join(bounds.alias("bounds"), same).select("facts.*", "bounds.side")
