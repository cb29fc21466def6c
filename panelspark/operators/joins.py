"""Equi-joins with dimensions and between panels.

No broadcast hint is given anywhere: Spark broadcasts a side when its size, known
at planning or measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles both sides, where adaptive execution splits a hot key.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import before_comma


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str = "fips_code") -> DataFrame:
    """All facts, with the dimension columns of their key or nulls."""
    return facts.join(dimension, key, "left")


def join_metrics(base: DataFrame, metrics: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins of per-entity tables; a null in any key never matches."""
    for table in metrics:
        base = base.join(table, list(keys), "left")
    return base


def build_dimension(codes: DataFrame, names: DataFrame, states: DataFrame) -> DataFrame:
    """Dimension rows for the codes that have a name.

    codes: fips_code. names: fips_code, full_name ("County, State").
    states: state_code, state_name; a state missing there is called "State NN".
    """
    state_code = F.substring("fips_code", 1, 2)
    return (
        codes.join(names, "fips_code")
        .withColumn("state_code", state_code)
        .join(states, "state_code", "left")
        .select(
            "fips_code",
            "state_code",
            F.coalesce("state_name", F.concat(F.lit("State "), "state_code")).alias("state_name"),
            before_comma(F.col("full_name")).alias("county_name"),
            F.substring("fips_code", 3, 100).alias("county_code"),
        )
    )


def unmapped_keys(facts: DataFrame, dimension: DataFrame, key: str = "fips_code") -> DataFrame:
    """Distinct fact keys that the dimension does not know."""
    return facts.select(key).distinct().join(dimension.select(key), key, "left_anti")


def prune_codes(codes: DataFrame, facts: DataFrame, key: str = "fips_code") -> DataFrame:
    """Codes that have at least one fact."""
    return codes.join(facts.select(key).distinct(), key, "left_semi")


def join_panels(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows present in both panels."""
    return left.join(right, list(keys))
