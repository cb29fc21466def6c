"""Data-quality gates: tables of findings, and errors where a gate must stop the flow."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import written


class QualityError(ValueError):
    """A gate was not passed."""


@dataclass(frozen=True)
class Expectation:
    """What a published table must hold."""

    min_rows: int = 1
    key_columns: Sequence[str] = field(default_factory=tuple)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The table itself, or an error if it has no row."""
    if df.isEmpty():
        raise QualityError(f"{name} has no rows")
    return df


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: null count of each column, all in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The table itself, or an error if a key occurs twice."""
    if not duplicate_keys(df, keys).isEmpty():
        raise QualityError(f"{name} repeats a key of ({', '.join(keys)})")
    return df


def profile(df: DataFrame, entity: str, period: str) -> DataFrame:
    """One row: rows, distinct entities and distinct periods."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.countDistinct(entity).alias("entity_count"),
        F.countDistinct(period).alias("period_count"),
    )


def distinct_bitmaps(df: DataFrame, by: Sequence[str], code: str) -> DataFrame:
    """Rows (by, bucket, bits): the distinct values of a whole-number code in each group, as bitmaps of 32,768 codes.

    Bitmaps of several groups put together by ``merged_bitmaps`` count a code once, which counts do not. They suit codes
    that lie close together; a code far from all others costs a bitmap of its own. Null is no value.
    """
    code = F.col(code).cast("long")
    known = df.filter(code.isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(code).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("bits")
    )


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The number of distinct codes in each group of the bitmaps."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def profile_codes(df: DataFrame, entity: str, period: str) -> DataFrame:
    """``profile`` for an entity and a period that are whole numbers: one pass that keeps a bitmap of each for every
    bucket of codes, in place of a copy of the rows for each distinct count."""
    codes = {"entity": F.col(entity).cast("long"), "period": F.col(period).cast("long")}
    cells = df.groupBy(*[F.bitmap_bucket_number(c).alias(f"{n}_bucket") for n, c in codes.items()]).agg(
        F.count("*").alias("row_count"),
        *[F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias(n) for n, c in codes.items()],
    )
    cells = written(cells)

    def counted(name: str) -> DataFrame:
        bits = F.bitmap_count(F.bitmap_or_agg(name)).alias("n")
        return cells.groupBy(f"{name}_bucket").agg(bits, F.sum("row_count").alias("row_count"))

    none = F.lit(0).cast("long")
    parts = counted("entity").select("row_count", F.col("n").alias("entity_count"), none.alias("period_count"))
    parts = parts.unionAll(counted("period").select(none, none, "n"))
    zero = F.lit(0).cast("long")
    return parts.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in parts.columns])


def table_report(df: DataFrame, name: str, expected: Expectation) -> DataFrame:
    """Rows (table_name, check_name, observed, expected, passed), one aggregation over the table.

    A key column that the table lacks fails its check, as if all its values were null.
    """
    checks = {"min_rows": F.count("*")}
    absent = F.greatest(F.count("*"), F.lit(1))
    given = {c.lower() for c in df.columns}
    checks |= {
        f"no_nulls_{c}": F.count_if(F.col(c).isNull()) if c.lower() in given else absent for c in expected.key_columns
    }
    bounds = {name: 0 for name in checks} | {"min_rows": expected.min_rows}
    observed = df.agg(*[check.cast("long").alias(label) for label, check in checks.items()])
    stacked = observed.unpivot([], list(checks), "check_name", "observed")
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("check_name")].cast("long")
    return stacked.select(
        F.lit(name).alias("table_name"),
        "check_name",
        "observed",
        bound.alias("expected"),
        F.when(F.col("check_name") == "min_rows", F.col("observed") >= bound)
        .otherwise(F.col("observed") <= bound)
        .alias("passed"),
    )


def quality_report(tables: Mapping[str, DataFrame], expectations: Mapping[str, Expectation]) -> DataFrame:
    """The reports of all tables together."""
    reports = [table_report(df, name, expectations.get(name, Expectation())) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, reports)


def verdicts(report: DataFrame) -> DataFrame:
    """One PASSED or FAILED per table."""
    return report.groupBy("table_name").agg(
        F.when(F.bool_and("passed"), "PASSED").otherwise("FAILED").alias("verdict")
    )


def require_passed(report: DataFrame) -> None:
    """An error that names every failed check; the report has a few rows per table."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        listing = ", ".join(f"{r.table_name}.{r.check_name}={r.observed}" for r in failed)
        raise QualityError(f"failed checks: {listing}")
