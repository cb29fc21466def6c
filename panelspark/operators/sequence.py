"""Previous value and running peak of each entity, in period order.

Rows of one entity are ordered by period and then by value, so that repeated
periods give the same result on every run.

``with_previous_and_peak`` is one shuffle and one sort. It puts an entity into
one task, which suits panels: an entity has one row per period there, so its rows
are bounded by the calendar. Where an entity may hold any share of the table, use
``with_previous_and_peak_split``: all rows are cut into slices of the sort order,
each a task of its own, whoever they belong to; what crosses a slice border is one
row per slice.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from panelspark.session import written

def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def previous_value(value: str, entity: Sequence[str], period: str) -> Column:
    return F.lag(value).over(Window.partitionBy(*entity).orderBy(period, value))


def running_peak(value: str, entity: Sequence[str], period: str) -> Column:
    return F.max(value).over(_so_far(Window.partitionBy(*entity).orderBy(period, value)))


def with_previous_and_peak(
    df: DataFrame, entity: Sequence[str], period: str, value: str, previous: str = "previous", peak: str = "peak"
) -> DataFrame:
    """The rows with the entity's preceding value and its highest value so far."""
    return df.withColumns(
        {previous: previous_value(value, entity, period), peak: running_peak(value, entity, period)}
    )


def with_previous_and_peak_split(
    df: DataFrame,
    entity: Sequence[str],
    period: str,
    value: str,
    previous: str = "previous",
    peak: str = "peak",
    slices: int | None = None,
) -> DataFrame:
    """Same rows as ``with_previous_and_peak``, for tables where an entity can be hot.

    The rows, placed by ranges of (entity, period, value), are written to the shared
    folder with the number of their slice, so that all readers see the same borders.
    ``slices`` is the number of ranges, by default that of the session's shuffles.
    """
    # The random last key spreads rows that are equal in every other key; which of
    # them comes first does not change the result.
    keys = [*entity, period, value, "_tie"]
    tied = df.withColumn("_tie", F.rand(7))
    placed = tied.repartitionByRange(slices, *keys) if slices else tied.repartitionByRange(*keys)
    sliced = written(placed.withColumn("_slice", F.spark_partition_id()))
    in_slice = Window.partitionBy("_slice", *entity).orderBy(period, value, "_tie")
    rows = sliced.withColumns(
        {
            "_first": F.row_number().over(in_slice) == 1,
            previous: F.lag(value).over(in_slice),
            peak: F.max(value).over(_so_far(in_slice)),
        }
    )
    # One row per (slice, entity). Only the first entity of a slice can continue from
    # the slice before, so at most one row per slice survives the filter below.
    by_slice = Window.partitionBy(*entity).orderBy("_slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy("_slice", *entity)
        .agg(F.max(F.struct(period, value, "_tie")).alias("_last"), F.max(value).alias("_top"))
        .select(
            "_slice",
            *entity,
            F.lag(F.lit(True)).over(by_slice).alias("_continues"),
            F.lag(f"_last.{value}").over(by_slice).alias("_last_before"),
            F.max("_top").over(before).alias("_top_before"),
        )
        .filter("_continues")
    )
    same = [F.col("rows._slice") == F.col("carried._slice")]
    same += [F.col(f"rows.{c}").eqNullSafe(F.col(f"carried.{c}")) for c in entity]
    joined = rows.alias("rows").join(carried.alias("carried"), same, "left")
    starts = F.col("_first") & F.col("carried._continues").isNotNull()
    kept = [F.col(f"rows.{c}") for c in df.columns if c not in (previous, peak)]
    return joined.select(
        *kept,
        F.when(starts, F.col("_last_before")).otherwise(F.col(f"rows.{previous}")).alias(previous),
        F.greatest(F.col(f"rows.{peak}"), F.col("_top_before")).alias(peak),
    )
