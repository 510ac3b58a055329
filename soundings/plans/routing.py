"""Registered queries on providers, channels, units and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.acoustics import absorption_ainslie_mccolm
from ..operators import environment, statistics
from ..session import shared_path
from ..sources import csvs, providers, store
from .queries import query, r6
from .standins import SAMPLES, TRACK, haversine, samples, table
from .standins import track as fixes


@query(f"with {TRACK} select event_id, lat as latitude, case event_type when 'view' then 'mooring' when 'click' then 'glider' else event_type end as platform_type, round(value, 6) as temperature from track")
def prj04_provider_names(spark, d):
    own = fixes(spark, d).select("event_id", F.col("lat").alias("LATITUDE"), F.col("value").alias("TEMP"), F.when(F.col("event_type") == "view", "MO").when(F.col("event_type") == "click", "GL").otherwise(F.col("event_type")).alias("platform_type"))
    return providers.enrich(own, "oceansites").select("event_id", "latitude", "platform_type", r6("temperature").alias("temperature"))


@query("select user_id::varchar as file, case when user_id % 3 = 0 then 'oceansites' when user_id % 3 = 1 then 'ship' else 'generic' end as provider from events group by user_id")
def udf02_providers(spark, d):
    k = F.col("user_id") % 3
    names = F.when(k == 0, F.array(F.lit("TIME"), F.lit("TEMP"), F.lit("PSAL"))).when(k == 1, F.array(F.lit("ship_latitude"), F.lit("ship_longitude"))).otherwise(F.array(F.lit("x")))
    heads = table(spark, d, "events").select("user_id").distinct().select(F.col("user_id").cast("string").alias("file"), names.alias("columns"))
    return providers.recognise(heads).select("file", "provider")


@query("select event_id, case when event_type = 'view' then 'C1' else user_id::varchar end as campaign_id from events")
def prj08_campaign(spark, d):
    own = table(spark, d, "events").select("event_id", F.when(F.col("event_type") == "view", "C1").alias("cruise_id"), F.col("user_id").cast("string").alias("platform_id"))
    return providers.campaign(own).select("event_id", "campaign_id")


@query(f"with {SAMPLES} select channel, count(*) as n from samples where abs((case when channel % 2 = 0 then 38.2 else 200 end) - 38) <= 0.5 group by channel")
def prj15_channels(spark, d):
    own = samples(spark, d).withColumn("khz", F.when(F.col("channel") % 2 == 0, 38.2).otherwise(200.0))
    return providers.choose_channels(own).groupBy("channel").agg(F.count("*").alias("n"))


@query(f"with {TRACK} select event_id, round((degrees(atan2(sin(radians(20 - lon)) * cos(radians(10)), cos(radians(lat)) * sin(radians(10)) - sin(radians(lat)) * cos(radians(10)) * cos(radians(20 - lon)))) + 360) % 360, 5) as course, round({haversine('lat', 'lon', '10.0', '20.0')}, 4) as nmi from track")
def scl02_bearing(spark, d):
    to = (F.lit(10.0), F.lit(20.0))
    return fixes(spark, d).select("event_id", F.round(geo.bearing(F.col("lat"), F.col("lon"), *to), 5).alias("course"), F.round(geo.great_circle_nmi(F.col("lat"), F.col("lon"), *to), 4).alias("nmi"))


@query()
def scl08_row_environment(spark, d):
    channels = spark.createDataFrame([("38", 38.0), ("120", 120.0)], "channel string, khz double")
    own = fixes(spark, d).select("event_id", (10 + F.col("value") % 10).alias("temperature"), F.lit(35.0).alias("salinity"))
    return environment.row_environment(own, channels).select("event_id", "channel", r6("sound_speed").alias("sound_speed"), F.round("absorption", 9).alias("absorption"))


@query()
def scl07_absorption_track(spark, d):
    a = absorption_ainslie_mccolm(F.lit(38.0), 10 + F.abs(F.col("lat")) / 10, F.lit(35.0), F.lit(100.0), F.lit(8.0))
    return fixes(spark, d).select("event_id", F.round(a, 9).alias("absorption"))


@query(f"with {TRACK} select count(*) as n_rows, min(lat) as south, max(lat) as north, count(distinct platform) as n_platforms from track")
def snk08_report(spark, d):
    """The report is written as JSON and read back."""
    path = shared_path(spark, "report")
    store.save_metadata(statistics.report(fixes(spark, d)), path)
    return spark.read.json(path).select("n_rows", "south", "north", "n_platforms")


@query("select 'value' as name, 'degC' as units")
def snk02_units(spark, d):
    """Units as column metadata, through a write and a read."""
    path = shared_path(spark, "units")
    e = table(spark, d, "events")
    e.select("event_id", F.col("value").alias("value", metadata={"units": "degC"})).write.parquet(path)
    back = spark.read.parquet(path)
    return spark.createDataFrame([(f.name, f.metadata["units"]) for f in back.schema if "units" in f.metadata], "name string, units string")


@query("select count(*) as n, 'value' as first_variable from events")
def ord03_top_variables(spark, d):
    e = table(spark, d, "events")
    first = statistics.top_variables(e.columns, ["value", "salinity"], 1)[0]
    return e.agg(F.count("*").alias("n")).withColumn("first_variable", F.lit(first))


@query("select event_id, value from events union all select event_id, value from events")
def set01_union(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return csvs.union_all([e, e])
