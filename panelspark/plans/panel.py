"""Summaries of a growth panel, shared by all measures.

A growth panel has one row per (entity, period) with the measure and its growth
rate. Column names are parameters; group and entity columns are those of ``Panel``.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelspark.functions import growth_percent, hundredths, mean_of_hundredths
from panelspark.operators.aggregates import deepest, highest, loser, lowest, mean_percent, winner
from panelspark.operators.ranking import extremes
from panelspark.operators.sequence import with_previous_and_peak, with_previous_and_peak_split


@dataclass(frozen=True)
class Panel:
    """Column names of a panel."""

    measure: str
    growth: str = "yoy_growth_rate"
    entity: str = "fips_code"
    entity_name: str = "county_name"
    group: str = "state_code"
    group_name: str = "state_name"
    period: str = "year"

    @property
    def keys(self) -> list[str]:
        return [self.group, self.group_name, self.entity, self.entity_name]

    @property
    def sequence(self) -> list[str]:
        """The entity with its labels, in the order that rows are sorted.

        The labels depend on the entity, so they add no groups; with them the sort of
        the window also serves the aggregation by ``keys`` that follows.
        """
        return [self.group, self.entity, self.entity_name, self.group_name]

    @property
    def groups(self) -> list[str]:
        return [self.group, self.group_name]


def sequence(
    df: DataFrame, panel: Panel, previous: str, drawdown: str = "drawdown_pct", sliced: bool = False
) -> DataFrame:
    """The rows with the entity's preceding measure, the growth from it, and the distance from the peak so far.

    By default an entity must have few rows, as in a panel with one row per entity and
    period. With ``sliced`` it may have any number.
    """
    step = with_previous_and_peak_split if sliced else with_previous_and_peak
    rows = step(df, panel.sequence, panel.period, panel.measure, previous, "_peak")
    measure = F.col(panel.measure)
    return rows.withColumns(
        {
            panel.growth: growth_percent(measure, F.col(previous)),
            drawdown: growth_percent(measure, F.col("_peak")),
        }
    ).drop("_peak")


def entity_summary(
    rows: DataFrame, panel: Panel, extra: Mapping[str, Column], drawdown: str = "drawdown_pct"
) -> DataFrame:
    """One row per entity: mean growth, extremes of growth, deepest drawdown, from ``sequence`` rows.

    One aggregation over rows already placed and sorted by entity. Extremes are
    structs (value, period); ``extra`` adds aggregates of the caller. Entities
    without a known group or name are kept.
    """
    return rows.groupBy(*panel.sequence).agg(
        mean_percent(panel.growth).alias("mean_growth"),
        highest(panel.growth, panel.period).alias("highest"),
        lowest(panel.growth, panel.period).alias("lowest"),
        deepest(drawdown, panel.period).alias("deepest"),
        *[aggregate.alias(name) for name, aggregate in extra.items()],
    )


def group_summary(growth: DataFrame, panel: Panel) -> DataFrame:
    """One row per group: entities, span, growth statistics, best and worst entity by mean growth.

    Rows are reduced to one per entity and those to one per group, each with a
    partial step before its shuffle. Best and worst are looked for among all rows
    of a group code, whatever name they carry; without a group code there is none.
    """
    rate = F.col(panel.growth)
    entities = (
        growth.groupBy(*panel.sequence)
        .agg(
            F.min(panel.period).alias("first_period"),
            F.max(panel.period).alias("last_period"),
            F.sum(hundredths(rate)).alias("growth_sum"),
            F.count(rate).alias("growth_count"),
            F.max(rate).alias("top_growth"),
            F.min(rate).alias("low_growth"),
        )
        .withColumn("avg_growth", mean_of_hundredths(F.col("growth_sum"), F.col("growth_count")))
    )
    groups = entities.groupBy(*panel.groups).agg(
        F.countDistinct(panel.entity).alias("entities"),
        F.min("first_period").alias("first_period"),
        F.max("last_period").alias("last_period"),
        mean_of_hundredths(F.sum("growth_sum"), F.sum("growth_count")).alias("mean_growth"),
        F.max("top_growth").alias("top_growth"),
        F.min("low_growth").alias("low_growth"),
        winner("avg_growth", panel.entity, panel.entity_name).alias("best"),
        loser("avg_growth", panel.entity, panel.entity_name).alias("worst"),
    )
    same_code = Window.partitionBy(panel.group)
    known = F.col(panel.group).isNotNull()
    return groups.withColumns(
        {side: F.when(known, F.min(side).over(same_code)) for side in ("best", "worst")}
    )


def group_period_extremes(df: DataFrame, panel: Panel, totals: Mapping[str, Column]) -> DataFrame:
    """One row per (group, period): entity count, totals, entities with the highest and lowest measure.

    Reads the table three times, each time only the columns needed, so it should be
    a stored one. Rows without a group code get no best and worst.
    """
    counted = df.groupBy(*panel.groups, panel.period).agg(
        F.countDistinct(panel.entity).alias("entities"),
        *[total.alias(name) for name, total in totals.items()],
    )
    keys = [panel.group, panel.period]
    found = extremes(df.dropna(subset=[panel.group]), keys, panel.measure, panel.entity, panel.entity_name)
    return counted.join(found, keys, "left")
