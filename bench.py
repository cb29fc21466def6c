"""Times the headline queries; prints one JSON line.

Each query runs once to warm up and then three times, its rows going to a sink
that discards them; the median counts. ``--control`` adds the county and state
tables built the long way, from one aggregate or window per column group joined on
the county keys, for comparison.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelspark.plans import gdp  # noqa: E402
from panelspark.queries import QUERIES  # noqa: E402
from panelspark.queries.gdp import _panel, _rows  # noqa: E402
from panelspark.session import remove_scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = [
    "gdp_by_year",
    "gdp_with_growth",
    "gdp_county_summary",
    "gdp_state_summary",
    "gdp_by_state_by_year",
    "population_by_year",
    "population_with_growth",
    "population_county_summary",
    "population_state_summary",
    "population_by_state_by_year",
    "epa_consolidated",
    "epa_yearly_mean",
    "aqi_history",
    "aqi_latest_per_key",
    "quality_duplicate_keys",
]


def joined_county_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Control: every group of columns is its own table, all joined on the county keys."""
    keys = gdp.PANEL.keys
    growth = gdp.with_growth(_rows(spark, sf))
    known = growth.filter("yoy_growth_rate is not null")
    peak = F.max("gdp_value").over(Window.partitionBy("fips_code").orderBy("year"))
    fall = F.round((F.col("gdp_value") - peak) / F.nullif(peak, F.lit(0)) * 100, 2)
    falls = _panel(spark, sf).withColumn("fall", fall).filter("fall < 0")
    tables = [
        known.groupBy(*keys).agg(F.round(F.avg("yoy_growth_rate"), 2).alias("average_yoy")),
        known.groupBy(*keys).agg(F.max(F.struct("yoy_growth_rate", "year")).alias("top")),
        known.groupBy(*keys).agg(F.min(F.struct("yoy_growth_rate", "year")).alias("low")),
        falls.groupBy(*keys).agg(F.min(F.struct("fall", "year")).alias("deepest")),
    ]
    summary = _panel(spark, sf).groupBy(*keys).agg(F.min("year"), F.max("year"), F.count("*"))
    for table in tables:
        summary = summary.join(table, keys, "left")
    return summary


def windowed_state_years(spark: SparkSession, sf: str) -> DataFrame:
    """Control: best and worst county of a state and year by row numbers over all rows."""
    rows = _panel(spark, sf)
    keys = ["state_code", "year"]
    totals = rows.groupBy("state_code", "state_name", "year").agg(
        F.countDistinct("fips_code").alias("counties"), F.sum("gdp_value").alias("total_gdp")
    )
    for name, order in (("best", F.desc("gdp_value")), ("worst", F.asc("gdp_value"))):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(order, "fips_code"))
        picked = rows.withColumn("place", place).filter("place = 1")
        totals = totals.join(picked.select(*keys, F.col("county_name").alias(name)), keys, "left")
    return totals


CONTROL = {"control_county_summary": joined_county_summary, "control_by_state_by_year": windowed_state_years}


def seconds(build, spark: SparkSession) -> float:
    start = time.perf_counter()
    build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("panelspark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {name: QUERIES[name] for name in HEADLINE}
    if "--control" in sys.argv:
        jobs |= CONTROL
    times = {}
    for name, build in jobs.items():
        seconds(build, spark)
        times[name] = round(statistics.median(seconds(build, spark) for _ in range(RUNS)), 3)
    total = round(sum(times[name] for name in HEADLINE), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": SF_DIR}))
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
