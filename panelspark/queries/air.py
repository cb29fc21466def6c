"""Queries over the air-quality tables, batch and stream."""

import uuid

from pyspark.sql import functions as F

from panelspark import pipeline, schemas
from panelspark.functions import city_and_pollutant, decoded_file_name
from panelspark.operators import filters, joins, project, setops
from panelspark.plans import airquality, gdp, population
from panelspark.queries import gdp as gdp_queries
from panelspark.queries import people
from panelspark.queries.registry import SQL_VIEWS, query
from panelspark.session import scratch_path, written
from panelspark.sinks import files as sinks
from panelspark.sinks.tables import declare_warehouse
from panelspark.sources.records import begun, malformed_files, scan_records
from panelspark.streaming import observations as stream
from panelspark.testtables import (
    COUNTY_WIDTH,
    STATE_WIDTH,
    aqi_obs,
    epa_obs,
    observation_records,
    observations,
    table,
)

LISTED = ", ".join(f"'{c}'" for c in airquality.MAIN_CITIES)

SQL_VIEWS["aqi_rows"] = """
    select event_id, ts, DateObserved as DATEOBSERVED, HourObserved as HOUROBSERVED,
           cast(null as varchar) as LOCALTIMEZONE, cast(null as varchar) as REPORTINGAREA,
           cast(null as varchar) as STATECODE, cast(null as double) as LATITUDE, cast(null as double) as LONGITUDE,
           ParameterName as PARAMETERNAME, AQI,
           json_extract_string(Category, '$.k') as CATEGORY_NAME,
           cast(json_extract_string(Category, '$.k') as integer) as CATEGORY_NUM, TargetCity as TARGETCITY
    from aqi_obs"""
SQL_VIEWS["aqi_stored"] = "select * exclude (event_id, ts) from aqi_rows"
SQL_VIEWS["epa_rows"] = f"""
    select obs_id, state_code, county_code, year, arithmetic_mean,
           regexp_extract(source_file, '([^/]*)_([^_/]+)\\.json$', 1) as city,
           regexp_extract(source_file, '([^/]*)_([^_/]+)\\.json$', 2) as pollutant,
           lpad(state_code, {STATE_WIDTH}, '0') || lpad(county_code, {COUNTY_WIDTH}, '0') as GeoFips
    from epa_obs"""
SQL_VIEWS["epa_place_year"] = """
    select GeoFips as fips_code, year,
           cast(sum(cast(arithmetic_mean as decimal(28, 6))) as double) / count(*) as arithmetic_mean
    from epa_rows group by GeoFips, year"""


def _records(spark, sf):
    return observation_records(aqi_obs(spark, sf))


def _history(spark, sf):
    return airquality.history_rows(_records(spark, sf))


def _epa(spark, sf):
    return airquality.consolidate(epa_obs(spark, sf), "source_file", STATE_WIDTH, COUNTY_WIDTH)


# --- yearly history --------------------------------------------------------


@query("""
    select obs_id, regexp_extract(source_file, '([^/]*)_([^_/]+)\\.json$', 1) as city,
           regexp_extract(source_file, '([^/]*)_([^_/]+)\\.json$', 2) as pollutant from epa_obs""")
def str_city_pollutant(spark, sf):
    city, pollutant = city_and_pollutant(decoded_file_name(F.col("source_file")))
    return epa_obs(spark, sf).select("obs_id", city.alias("city"), pollutant.alias("pollutant"))


@query("select * from epa_rows")
def epa_consolidated(spark, sf):
    return _epa(spark, sf)


@query(f"""
    select city as City, year as Year, pollutant as Pollutant, arithmetic_mean as Value, state_code as state,
           county_code as county
    from epa_rows where city is not null and arithmetic_mean is not null and city in ({LISTED})""")
def epa_tidy_cities(spark, sf):
    names = {"pollutant": "parameter", "state_code": "state", "county_code": "county"}
    return airquality.tidy(project.rename(_epa(spark, sf), names))


@query("""
    select city, pollutant, year,
           cast(sum(cast(arithmetic_mean as decimal(28, 6))) as double) / count(*) as arithmetic_mean
    from epa_rows group by city, pollutant, year""")
def epa_yearly_mean(spark, sf):
    return airquality.yearly_mean(_epa(spark, sf), ["city", "pollutant"])


@query(f"select obs_id, city, year from epa_rows where city in ({LISTED})")
def filter_isin(spark, sf):
    return filters.keep_values(_epa(spark, sf), "city", airquality.MAIN_CITIES).select("obs_id", "city", "year")


@query("select o_orderkey, o_totalprice as value from orders where o_orderstatus <> 'P'")
def coerce_numeric(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", ".").otherwise(F.col("o_totalprice").cast("string"))
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("value"))
    return filters.coerce_numeric(rows, ["value"])


@query("""
    select e.fips_code, e.year, e.arithmetic_mean, g.gdp_value, p.total_population
    from epa_place_year as e join gdp_panel as g on e.fips_code = g.fips_code and e.year = g.year
    join pop_panel as p on e.fips_code = p.fips_code and e.year = p.year""")
def join_panels(spark, sf):
    place = _epa(spark, sf).withColumnRenamed("GeoFips", "fips_code")
    means = airquality.yearly_mean(place, ["fips_code"])
    output = gdp.clean(gdp_queries._bronze(spark, sf)).select("fips_code", "year", "gdp_value")
    people_rows = population.clean(people._county(spark, sf), gdp_queries.dim_fips(spark, sf))
    both = joins.join_panels(output, people_rows.select("fips_code", "year", "total_population"), ["fips_code", "year"])
    return joins.join_panels(means, both, ["fips_code", "year"])


@query("""
    select state_code, county_code, cast(year as integer) as year, arithmetic_mean, source_file,
           cast(2 as bigint) as malformed
    from epa_obs""")
def scan_json_documents(spark, sf):
    """The yearly records as JSON documents, half of them plain lists and half lists under a name, beside two broken
    files, read by split; strings hold what looks like JSON."""
    rows, folder = epa_obs(spark, sf), scratch_path(spark, "documents")
    tricky = F.struct(F.lit('}], "Data": [{').alias("text"), F.array(F.struct("obs_id")).alias("nested"))
    rows = rows.select("state_code", "county_code", "year", "arithmetic_mean", tricky.alias("city"), F.col("source_file").alias("state"), "obs_id")
    for wrapped in (False, True):
        half = rows.filter(F.col("obs_id") % 2 == int(wrapped)).drop("obs_id")
        sinks.write_json_arrays(half, f"{folder}/{wrapped}", wrapped)
    for name, text in (("cut", '[{"state_code": "1"}, {"year": 20'), ("half", '{"Data": [{"state_code": "1"}]')):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    states = begun(spark, f"{folder}/*")
    found = scan_records(spark, f"{folder}/*", schemas.EPA_RECORD, states=states)
    broken = malformed_files(spark, f"{folder}/*", states=states).count()
    kept = found.select("state_code", "county_code", "year", "arithmetic_mean", F.col("state").alias("source_file"))
    return kept.withColumn("malformed", F.lit(broken).cast("long"))


# --- observations ----------------------------------------------------------


@query("""
    select event_id as EVENT_ID, DateObserved as DATE_OBSERVED, AQI as AQI_VALUE, TargetCity as TARGET_CITY
    from aqi_obs""")
def normalize_names(spark, sf):
    rows = aqi_obs(spark, sf).select(
        "event_id",
        F.col("DateObserved").alias("Date Observed"),
        F.col("AQI").alias("Aqi Value"),
        F.col("TargetCity").alias("Target_City"),
    )
    return project.normalize_names(rows)


@query("""
    select event_id, cast(json_extract_string(Category, '$.k') as integer) as CATEGORY_NUM from aqi_obs""")
def flatten_struct(spark, sf):
    parsed = project.parse_json_column(aqi_obs(spark, sf).select("event_id", "Category"), "Category", "k int")
    return project.flatten_struct(parsed, "Category", {"k": "CATEGORY_NUM"})


@query("select * exclude (event_id, ts, CATEGORY_NAME, CATEGORY_NUM), "
       "cast(null as varchar) as CATEGORY_NAME, cast(null as integer) as CATEGORY_NUM from aqi_rows")
def normalize_to_schema(spark, sf):
    return project.normalize_to_schema(aqi_obs(spark, sf), schemas.AQI_HISTORY)


@query("""
    select event_id as EVENT_ID, DATEOBSERVED, HOUROBSERVED, PARAMETERNAME, AQI, CATEGORY_NAME, CATEGORY_NUM,
           TARGETCITY from aqi_rows""")
def aqi_flatten(spark, sf):
    return airquality.flatten_observations(_records(spark, sf).drop("ts"))


@query("select * from aqi_stored")
def aqi_history(spark, sf):
    return _history(spark, sf)


@query("""
    select TARGETCITY as CITY, PARAMETERNAME as POLLUTANT_TYPE, AQI as VALUE from aqi_stored
    where (DATEOBSERVED, HOUROBSERVED) =
          (select (DATEOBSERVED, HOUROBSERVED) from aqi_stored order by DATEOBSERVED desc, HOUROBSERVED desc limit 1)""")
def aqi_snapshot_last_batch(spark, sf):
    return airquality.snapshot_rows(airquality.last_batch(_history(spark, sf)))


@query("""
    select TARGETCITY, PARAMETERNAME, AQI from
      (select *, row_number() over (partition by TARGETCITY, PARAMETERNAME order by ts desc, event_id desc) as place
       from aqi_rows) as t where place = 1""")
def aqi_latest_per_key(spark, sf):
    return airquality.latest_per_key(airquality.flatten_observations(_records(spark, sf)), ["TS", "EVENT_ID"])


@query("""
    select TargetCity as city, ParameterName as pollutant, cast(null as integer) as year, AQI as aqi,
           cast(null as double) as arithmetic_mean from aqi_obs
    union all select city, pollutant, year, null, arithmetic_mean from epa_rows""")
def set_union_batches(spark, sf):
    names = {"TargetCity": "city", "ParameterName": "pollutant", "AQI": "aqi"}
    now = project.select_renamed(aqi_obs(spark, sf), names)
    past = _epa(spark, sf).select("city", "pollutant", "year", "arithmetic_mean")
    return setops.union_batches([now, past])


@query("select distinct TargetCity, ParameterName from aqi_obs")
def set_distinct(spark, sf):
    return setops.distinct_values(aqi_obs(spark, sf), ["TargetCity", "ParameterName"])


# --- stream ----------------------------------------------------------------


def _stored(spark, sf):
    """Run the store once over the event files; returns the history and snapshot folders."""
    events = table(spark, sf, "events")
    landed = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = observation_records(observations(landed))
    folder = scratch_path(spark, "aqi")
    running = stream.start_store(rows, f"{folder}/history", f"{folder}/snapshot", f"{folder}/checkpoint")
    _finish(running)
    return f"{folder}/history", f"{folder}/snapshot"


def _finish(running, seconds=3600):
    if not running.awaitTermination(seconds):
        running.stop()
        raise TimeoutError(f"the stream did not end in {seconds} seconds")


def _stored_in_three(spark, sf, folder=None, then=lambda: None):
    """The events of each third of the day landed and stored one after another: three batches of one store."""
    events, folder = table(spark, sf, "events"), folder or scratch_path(spark, "aqi")
    for third in range(3):
        part = events.filter(F.floor(F.hour("ts") / 8) == third)
        part.write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(events.schema).parquet(f"{folder}/landed")
        rows = observation_records(observations(landed))
        _finish(stream.start_store(rows, f"{folder}/history", f"{folder}/current", f"{folder}/checkpoint"))
        then()
    return f"{folder}/history", f"{folder}/current"


def _published(spark, sf, name, *columns):
    """A published table after three batches were stored and each was published, the last one twice."""
    folder, database = scratch_path(spark, "aqi"), f"aqi_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    try:
        declare_warehouse(spark, database)
        _stored_in_three(spark, sf, f"{folder}/air_quality", lambda: pipeline.publish_observations(spark, folder, database))
        pipeline.publish_observations(spark, folder, database)
        return written(spark.table(f"{database}.{name}").select(*columns))
    finally:
        spark.sql(f"drop database {database} cascade")


@query("select *, cast(0 as bigint) as batch_id from aqi_stored")
def aqi_stream_history(spark, sf):
    """All events through the stream, stored as one batch, since they lie in one file."""
    return stream.read_history(spark, _stored(spark, sf)[0]).drop("run")


@query("select TARGETCITY as CITY, PARAMETERNAME as POLLUTANT_TYPE, AQI as VALUE from aqi_stored")
def aqi_stream_snapshot(spark, sf):
    """The snapshot after the stream: the rows of its only batch."""
    return stream.read_snapshot(spark, _stored(spark, sf)[1])


@query("select *, cast(floor(HOUROBSERVED / 8) as bigint) as batch_id from aqi_stored")
def aqi_stream_history_in_batches(spark, sf):
    """All events, stored in three batches."""
    return stream.read_history(spark, _stored_in_three(spark, sf)[0]).drop("run")


@query("select TARGETCITY as CITY, PARAMETERNAME as POLLUTANT_TYPE, AQI as VALUE from aqi_stored where HOUROBSERVED >= 16")
def aqi_stream_snapshot_of_last_batch(spark, sf):
    """The snapshot after three batches: the rows of the last."""
    return stream.read_snapshot(spark, _stored_in_three(spark, sf)[1])


@query("select *, cast(1 as bigint) as malformed from aqi_stored")
def aqi_landed_json(spark, sf):
    """The events landed as JSON documents beside a broken one, taken in two files at a time."""
    folder = scratch_path(spark, "aqi")
    rows = _records(spark, sf).drop("event_id", "ts")
    sinks.write_json_arrays(rows.repartition(5, "TargetCity", "HourObserved"), f"{folder}/landed")
    broken = spark.createDataFrame([('[{"AQI": 1}, {"AQI"',)], "value string")
    broken.coalesce(1).write.mode("append").text(f"{folder}/landed")
    landed = stream.landed_observations(spark, f"{folder}/landed", files_per_batch=2, keep_malformed=True)
    paths = [f"{folder}/{name}" for name in ("history", "current", "checkpoint")]
    _finish(stream.start_store(landed, *paths, rejected_path=f"{folder}/rejected"))
    rejected = stream.read_rejected(spark, f"{folder}/rejected").count()
    stored = stream.read_history(spark, f"{folder}/history").drop("run", "batch_id")
    return stored.withColumn("malformed", F.lit(rejected).cast("long"))


@query("""
    select TARGETCITY as CITY, PARAMETERNAME as POLLUTANT_TYPE, AQI as VALUE from
      (select *, row_number() over (partition by TARGETCITY, PARAMETERNAME
                                    order by DATEOBSERVED desc, HOUROBSERVED desc, AQI desc) as place
       from aqi_stored) as t where place = 1""")
def aqi_latest_running(spark, sf):
    """The table of latest values kept by the state of a stream, after three batches that came out of order."""
    folder, events = scratch_path(spark, "aqi"), table(spark, sf, "events")
    for third in (1, 2, 0):
        events.filter(F.floor(F.hour("ts") / 8) == third).write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(events.schema).parquet(f"{folder}/landed")
        rows = airquality.history_rows(observation_records(observations(landed)))
        _finish(stream.start_latest(rows, f"{folder}/latest", f"{folder}/checkpoint"))
    return stream.read_snapshot(spark, f"{folder}/latest")


@query("select *, cast(floor(HOUROBSERVED / 8) + 1 as bigint) as LOAD_ID from aqi_stored")
def aqi_published_history(spark, sf):
    """The history table after three publishes of three batches and one of nothing: each batch once, in its own load."""
    return _published(spark, sf, "AIR_QUALITY_13_CITIES", "*")


@query("""
    select cast(floor(HOUROBSERVED / 8) + 1 as bigint) as load_id, 'done' as state, count(*) as row_count
    from aqi_stored group by all""")
def aqi_publish_ledger(spark, sf):
    """What the ledger tells of the same publishes."""
    return _published(spark, sf, "AIR_QUALITY_13_CITIES_LOADS", "load_id", "state", "row_count").filter("state = 'done'")


@query("select TARGETCITY as CITY, PARAMETERNAME as POLLUTANT_TYPE, AQI as VALUE from aqi_stored where HOUROBSERVED >= 16")
def aqi_published_snapshot(spark, sf):
    """The snapshot table after the same publishes: the rows of the last batch."""
    return _published(spark, sf, "AQI_REALTIME", "*")
