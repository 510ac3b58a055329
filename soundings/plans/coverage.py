"""Registered queries on navigation scans, catalogues, units, masks, thinned points and reducers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import acoustics, geo, text
from ..operators import echo, environment, grid, statistics, track
from ..session import shared_path
from ..sources import catalogue, csvs, navigation, providers, store
from .queries import query, r6
from .standins import EVENTS, SAMPLES, TRACK, samples, table
from .standins import track as fixes

_ISO = "strftime(make_timestamp({}), '%Y-%m-%dT%H:%M:%SZ')"


@query(f"with {TRACK} select platform, count(*) as n, min(lat) as south, max(lon) as east, {_ISO.format('min(t)')} as t0, round(max(value), 6) as most from track group by platform")
def snk06_catalogue(spark, d):
    own = catalogue.items(fixes(spark, d), "observations", ["platform"], properties=[F.max("value").alias("most")])
    j = lambda p, kind: F.get_json_object("value", p).cast(kind)
    return own.select(F.element_at(F.split("id", "="), -1).cast("long").alias("platform"), j("$.properties.n_rows", "long").alias("n"), j("$.bbox[1]", "double").alias("south"), j("$.geometry.coordinates[0][2][0]", "double").alias("east"), j("$.properties.start_datetime", "string").alias("t0"), r6(j("$.properties.most", "double")).alias("most"))


@query(f"with {SAMPLES}, c as (select day, channel % 3 as product, count(*) as n, min(depth) as d, max(t) as t1, string_agg(distinct channel % 2, ',' order by channel % 2) as f from samples group by all) select day, product, n, {_ISO.format('t1')} as t1, f as frequencies from c")
def snk09_product_catalogue(spark, d):
    own = samples(spark, d).withColumns({"product": F.col("channel") % 3, "lat": F.col("depth"), "lon": F.col("depth")})
    own = catalogue.items(own, "products", ["day", "product"], properties=[F.sort_array(F.collect_set((F.col("channel") % 2).cast("string"))).alias("frequencies")])
    j = lambda p: F.get_json_object("value", p)
    f = F.array_join(F.from_json(j("$.properties.frequencies"), "array<string>"), ",")
    return own.select(F.regexp_extract("id", "day=([^/]+)", 1).cast("date").alias("day"), F.regexp_extract("id", "product=(.+)", 1).cast("long").alias("product"), j("$.properties.n_rows").cast("long").alias("n"), j("$.properties.end_datetime").alias("t1"), f.alias("frequencies"))


@query(f"with {TRACK} select 'observations' as id, 'MIT' as license, count(distinct platform) as n_items, string_agg(distinct platform::varchar, ',' order by platform::varchar) as platforms from track")
def src22_catalogue_read(spark, d):
    path, t = shared_path(spark, "catalogue"), fixes(spark, d)
    catalogue.write_catalogue(path, catalogue.collection(t, "observations", "test", ["value"]), catalogue.items(t, "observations", ["platform"]))
    return catalogue.read_catalogue(spark, path).select("id", "license", "n_items", F.array_join("platforms", ",").alias("platforms"))


@query(f"with {TRACK}, k as (select t, lat, lon from track where event_id % 5 <> 0) select t, round(min((lat, lon))[1], 6) as lat from k group by t")
def src16_navigation(spark, d):
    """Positions under other names in one file and as points in another, some of them no numbers."""
    t = fixes(spark, d)
    when = F.timestamp_micros("t")
    bad = F.col("event_id") % 5 == 0
    named = t.where("event_id % 2 = 0").select(F.when(bad, "x").otherwise(F.col("lat").cast("string")).alias("LATITUDE"), F.col("lon").alias("lng"), when.cast("string").alias("Date_Time"))
    points = t.where("event_id % 2 = 1").select(geo.point_wkb(F.col("lon"), F.when(~bad, F.col("lat"))).alias("geometry"), when.alias("time"))
    both = navigation.navigation(named).unionByName(navigation.navigation(points))
    both = both.groupBy("dt").agg(F.min(F.struct("lat", "lon")).alias("p"))
    return both.select(F.unix_micros("dt").alias("t"), r6("p.lat").alias("lat"))


@query(f"with {TRACK} select platform::varchar as file_name, t, lat, lon, value as knt from track where event_id % 7 <> 0")
def src17_json(spark, d):
    """Records with a list of positions, an array of them in each file; a record without positions gives no row.

    Platforms share files, so their number follows the events and not the platforms."""
    path = shared_path(spark, "locations")
    at = F.struct("lat", "lon", F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("dt"), F.col("value").alias("knt"))
    own = fixes(spark, d).groupBy("platform", "day").agg(F.collect_list(F.when(F.col("event_id") % 7 != 0, at)).alias("location_data"))
    record = F.struct(F.concat(F.lit("raw/"), F.col("platform").cast("string")).alias("source_path"), F.col("platform").cast("string").alias("file_name"), "location_data")
    n_files = -(-table(spark, d, "events").count() // EVENTS)  # from footers
    own = own.groupBy(F.pmod(F.xxhash64("platform"), F.lit(max(n_files, 1))).alias("k")).agg(F.to_json(F.collect_list(record)).alias("value")).select("value")
    own.write.option("maxRecordsPerFile", 1).text(path)  # an array is a whole file
    return navigation.read_locations(spark, path).select("file_name", F.unix_micros("dt").alias("t"), "lat", "lon", "knt")


@query("select source, count(*) as n from documents where source is not null group by source")
def src18_manifest(spark, d):
    """Files named by date, of which two days are asked for; a third lies outside."""
    path = shared_path(spark, "files")
    own = table(spark, d, "documents").where("source is not null").select("source", "doc_id")
    for day in ("20240101", "20240102", "20240301"):
        part = own.where(F.col("doc_id") % 2 == int(day[-1]) % 2) if day != "20240301" else own
        part.write.parquet(f"{path}/D{day}")
    place = lambda c: F.element_at(F.split(c, "/files-", 2), -1)
    files = store.manifest(spark, path).select("path", "length", text.name_date(F.regexp_extract("path", "/(D[0-9]+)/", 1)).alias("day"))
    files = files.where((F.col("day") <= F.lit("2024-01-31").cast("date")) & F.col("path").endswith(".parquet") & (F.col("length") > 0)).select(place(F.col("path")).alias("name"))
    rows = spark.read.parquet(f"{path}/*").withColumn("name", place(F.col("_metadata.file_path")))
    return rows.join(files, "name", "left_semi").groupBy("source").agg(F.count("*").alias("n"))


@query("select source as campaign_id, count(*) as n from documents where source is not null group by source")
def src20_routed(spark, d):
    path = shared_path(spark, "routed")
    store.write_routed(table(spark, d, "documents").select("doc_id", F.col("source").alias("campaign_id")), path)
    return store.read_campaign(spark, path).groupBy("campaign_id").agg(F.count("*").alias("n"))


@query("select o_orderkey, coalesce(list_sort(list_distinct(list(l_linenumber) filter (l_linenumber is not null)))::varchar, '[]') as frequencies, count(l_orderkey) as n_rows from orders left join lineitem on o_orderkey = l_orderkey group by o_orderkey")
def src21_file_frequencies(spark, d):
    own = store.file_frequencies(table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "l_linenumber")
    return own.select("o_orderkey", F.concat(F.lit("["), F.array_join("frequencies", ", "), F.lit("]")).alias("frequencies"), "n_rows")


@query(f"with {TRACK} select event_type as campaign_id, (floor(lat / 30) * 30)::int as lat_bin, count(*) as n from track where lat between -20 and 20 and event_type = 'view' group by all")
def snk03_density_points(spark, d):
    path = shared_path(spark, "density")
    store.write_density(fixes(spark, d).select("event_id", "lat", "lon", F.col("event_type").alias("campaign_id")), path, 30.0)
    return store.read_density(spark, path, (-180, -20, 180, 20), "view", size=30.0).groupBy("campaign_id", "lat_bin").agg(F.count("*").alias("n"))


@query("select event_id, case when event_id % 10 < 5 then (event_id % 100)::double end as half from events")
def prj02_majority_on_writing(spark, d):
    """Half of the values are numbers: enough on writing, not on reading."""
    own = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 < 5, (F.col("event_id") % 100).cast("string")).otherwise("x").alias("half"))
    share = csvs.numeric_share(own)["half"]
    return csvs.coerce_by_majority(own, min(0.5, share)).select("event_id", "half")


@query("""select variable, count(*) as n_valid, round(sum(v), 3) as total from (select 'TEMP' as variable, value as v from events union all select 'RELATIVE_HUMIDITY', event_id::double from events
 union all select 'HDG_FILTERED_MEAN', value * 2 from events where event_id % 3 > 0 union all select 'TEMP_QC', 1.0 from events) group by variable""")
def prj11_measurement_columns(spark, d):
    e, v = table(spark, d, "events"), F.col("value")
    left_out = ["TEMP_SBE37_STDDEV", "SAL_STD", "Depth_min", "BARO_MAX", "Wave_Peak", "UWND_MEAN", "VWND_MEAN", "WWND_MEAN", "PITCH_WING_MEAN", "WING_ANGLE", "HDG", "sog", "COG", "latitude", "time", "lat_bin", "lower"]
    own = e.select(v.alias("TEMP"), F.col("event_id").cast("double").alias("RELATIVE_HUMIDITY"), F.when(F.col("event_id") % 3 > 0, v * 2).alias("HDG_FILTERED_MEAN"), F.lit(1.0).alias("TEMP_QC"), *[v.alias(c) for c in left_out])
    long = own.select(*statistics.measurement_columns(own)).unpivot([], statistics.measurement_columns(own), "variable", "value")
    return long.groupBy("variable").agg(F.count("value").alias("n_valid"), F.round(F.sum("value"), 3).alias("total"))


@query(f"with {SAMPLES} select channel, (count(*) filter (not ((ping_idx + sample_idx) % 3 = 0 and sample_idx % 2 = 0)))::bigint as n from samples group by channel")
def prj12_mask_applied(spark, d):
    s = samples(spark, d)
    masks = s.where("sample_idx % 2 = 0").select("channel", "ping_idx", "sample_idx", ((F.col("ping_idx") + F.col("sample_idx")) % 3 == 0).alias("mask"))
    return echo.apply_masks(s, masks).groupBy("channel").agg(F.count("sv").alias("n"))


@query(f"with {SAMPLES} select channel, (count(*) filter (depth >= 30))::bigint as n from samples group by channel")
def prj14_surface_excluded(spark, d):
    return echo.surface_excluded(samples(spark, d), 30).groupBy("channel").agg(F.count("sv").alias("n"))


@query(f"with {SAMPLES} select channel, round(sum(coalesce(case when sample_idx % 2 = 0 then depth end, sample_idx) + 1.5), 3) as total from samples group by channel")
def prj16_depth_from_range(spark, d):
    own = samples(spark, d).withColumn("echo_range", F.when(F.col("sample_idx") % 2 == 0, F.col("depth")))
    return echo.depth_from_range(own, 1.5).groupBy("channel").agg(F.round(F.sum("depth"), 3).alias("total"))


@query("select event_type as sensor, count(distinct user_id) as n from events where user_id % 3 = 0 group by event_type")
def prj18_sensors_present(spark, d):
    """A catalogue with a row for each event type and user; columns are those of every third user."""
    e = table(spark, d, "events").select(F.col("event_type").alias("sensor"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("variable")).distinct()
    have = [r[0] for r in e.where("substring(variable, 2) % 3 = 0").select("variable").distinct().collect()]
    present = providers.sensors_present(have, e)
    return e.join(present, "sensor", "left_semi").where("substring(variable, 2) % 3 = 0").groupBy("sensor").agg(F.countDistinct("variable").alias("n"))


@query("select event_id, value as temperature, user_id as salinity from events")
def prj20_aliases(spark, d):
    own = table(spark, d, "events").select("event_id", F.col("value").alias("TEMP_SBE37_MEAN"), F.col("user_id").alias("SAL_SBE37_MEAN"))
    return csvs.normalise(own, {"TEMP_SBE37_MEAN": "temperature", "SAL_SBE37_MEAN": "salinity", "absent": "other"})


@query("""with n as (select distinct case event_type when 'view' then 'TEMP' when 'click' then 'salinity' else event_type || '_x' end as name from events)
select name, case name when 'TEMP' then 'sea_water_temperature' else 'sea_water_salinity' end as standard_name, case name when 'TEMP' then 1.0 else 0.85 end::double as confidence from n where name in ('TEMP', 'salinity')""")
def prj21_standard_names(spark, d):
    kind = F.when(F.col("event_type") == "view", "TEMP").when(F.col("event_type") == "click", "salinity").otherwise(F.concat("event_type", F.lit("_x")))
    names = table(spark, d, "events").select(kind.alias("name")).distinct()
    aliases = spark.createDataFrame([("temp", "sea_water_temperature")], "alias string, target string")
    standard = spark.createDataFrame([("sea_water_temperature",), ("sea_water_salinity",), ("sea_surface_salinity_x",)], "standard string")
    return environment.standard_names(names, aliases, standard)


@query("select user_id, round(sum(value), 3) as total, 'degree_Celsius' as unit, 'm' as depth_unit from events group by user_id")
def prj22_units(spark, d):
    """Units of a row below the header and of a block, standard ones first; they come back from the Parquet files."""
    path = shared_path(spark, "units")
    e = table(spark, d, "events").select("user_id", F.col("value").alias("temperature"), F.col("event_id").alias("depth"))
    units = csvs.units_mapping(e.columns, ["(unitless)", "degC", ""], standard={"temperature": "degree_Celsius", "absent": "x"}) | csvs.units_mapping(["depth"], metadata={"field_unit": " m "})
    csvs.with_units(e, units).write.parquet(path)
    back = spark.read.parquet(path)
    unit = {f.name: f.metadata.get("units") for f in back.schema}
    return back.groupBy("user_id").agg(F.round(F.sum("temperature"), 3).alias("total")).select("user_id", "total", F.lit(unit["temperature"]).alias("unit"), F.lit(unit["depth"]).alias("depth_unit"))


@query("select event_type, count(*) as n from events where event_type = 'view' group by event_type")
def prj23_compatible_schemas(spark, d):
    """Frames are put together if nothing speaks against it; one has a text where the others have a number."""
    e = table(spark, d, "events")
    parts = [e.where("event_type = 'view'"), e.where("event_type = 'click'").withColumn("value", F.col("value").cast("string")), e.where("event_type = 'purchase'").drop("ts")]
    fit = [p for p in parts if not store.schema_issues(parts[0].schema, p.schema, critical=("ts",))]
    return csvs.union_all(fit).groupBy("event_type").agg(F.count("*").alias("n"))


@query("select event_id, len(beams) as n_beams, beams[2] as b1 from (select event_id, [value, value * 2, value * 3] as beams from events)")
def prj26_flattened(spark, d):
    own = table(spark, d, "events").select("event_id", F.posexplode(F.array(F.col("value"), F.col("value") * 2, F.col("value") * 3)).alias("beam", "velocity"))
    return grid.flattened(own, ["event_id"], "beam", "velocity").select("event_id", F.size("velocities").cast("long").alias("n_beams"), F.element_at("velocities", 2).alias("b1"))


@query(f"with {SAMPLES} select channel, (count(*) filter (sv <= -40))::bigint as n from samples group by channel")
def prj27_clipped(spark, d):
    return echo.clipped(samples(spark, d), -40).groupBy("channel").agg(F.count("sv").alias("n"))


@query(f"with {TRACK} select event_id, t from track where event_id % 11 = 0")
def join21_back_matched(spark, d):
    t = fixes(spark, d)
    return track.back_matched(t, t.where("event_id % 11 = 0").select("platform", "event_id")).select("event_id", "t")


@query(f"""with {SAMPLES}, c as (select channel, t // 3600000000 as tb, floor(depth / 40) as db, avg(sv) as coarse from samples group by all),
f as (select *, ceil(t / 3600000000 - 0.5)::bigint as tb, ceil(depth / 40 - 0.5)::bigint as db from samples) select f.channel, f.ping_idx, count(coarse) as n, round(sum(coarse), 4) as total from f left join c on f.channel = c.channel and f.tb = c.tb and f.db = c.db group by all""")
def join22_resampled(spark, d):
    s = samples(spark, d)
    coarse = s.groupBy("channel", F.floor(F.col("t") / 3_600_000_000).alias("tb"), F.floor(F.col("depth") / 40).alias("db")).agg(F.avg("sv").alias("coarse"))
    coarse = coarse.select("channel", (F.col("tb") * 3_600_000_000).alias("t"), (F.col("db") * 40).alias("depth"), "coarse")
    own = echo.resampled_nearest(s, coarse, "coarse", (3_600_000_000, 40))
    return own.groupBy("channel", "ping_idx").agg(F.count("coarse").alias("n"), F.round(F.sum("coarse"), 4).alias("total"))


@query(f"with {TRACK} select event_id, row_number() over (partition by platform order by t, event_id) - 1 as place from track")
def ord01_time_order(spark, d):
    return track.in_time_order(fixes(spark, d)).select("event_id", "place")


@query("select event_id, round(case when abs(value) > 0.5 and pow(10, value / 10) - pow(10, (value - event_id % 4) / 10) > 0 then 10 * log10(case when pow(10, value / 10) - pow(10, (value - event_id % 4) / 10) > 0 then pow(10, value / 10) - pow(10, (value - event_id % 4) / 10) end) end, 6) as clean from events")
def scl10_noise_subtracted(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", r6(F.when(F.abs("value") > 0.5, acoustics.subtract_db(F.col("value"), F.col("value") - F.col("event_id") % 4))).alias("clean"))


@query("select o_orderkey, case when o_orderkey % 600 < 600 and o_orderkey % 900 < 600 then round((o_orderkey % 200) * 0.01 + case when o_orderkey % 2 = 0 then -80.0 else -75.0 end, 6)::double end as sv from orders")
def scl11_counts_to_sv(spark, d):
    offset = F.when(F.col("o_orderkey") % 2 == 0, -80.0).otherwise(-75.0)
    return table(spark, d, "orders").select("o_orderkey", r6(acoustics.counts_to_sv(F.col("o_orderkey") % 200, F.lit(0.01), offset, F.col("o_orderkey") % 900, 600)).alias("sv"))


@query("select event_id, case event_id % 6 when 0 then 'nav' when 1 then 'met' when 2 then 'met' when 3 then 'ocean' when 4 then 'ocean' else 'other' end as category from events")
def scl16_category(spark, d):
    names = F.array(*[F.lit(n) for n in ("SOG_filtered", "wind_speed", "TEMP_AIR_MEAN", "sal_sbe37", "Wave_height", "latitude")])
    return table(spark, d, "events").select("event_id", text.category_of(F.get(names, (F.col("event_id") % 6).cast("int"))).alias("category"))


@query(f"""with {TRACK}, w as (select event_id, list(value) over (partition by platform order by t rows between 2 preceding and 2 following) as v from track)
select event_id, round(list_max(v) - list_min(v), 6) as spread from w""")
def udf04_reducer(spark, d):
    own = echo.rolling(fixes(spark, d), "value", "spread", 2, lambda v: F.array_max(v) - F.array_min(v), ["platform"], "t")
    return own.select("event_id", r6("spread").alias("spread"))


@query("select (date_trunc('day', ts)::date - (datediff('day', date '0001-01-01', ts::date) % 5)::int) as window_start, event_type as category, count(*) as n from events group by all")
def agg25_day_windows(spark, d):
    return statistics.by_day_window(table(spark, d, "events"), "ts", 5, "event_type")


@query(f"with {TRACK} select platform, count(*) as n_rows, 8 as n_columns, min(t) as t0, max(t) as t1, count(distinct day) as n_days from track group by platform")
def agg28_inspection(spark, d):
    return statistics.inspection(fixes(spark, d), ["platform"])
