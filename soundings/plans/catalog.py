"""More registered queries: scans, sinks, catalogues, routing and expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import acoustics, geo, text
from ..operators import echo, environment, grid, statistics
from ..session import shared_path
from ..sources import csvs, logs, store
from ..streaming import ingest
from .queries import SEGMENTS, _bed, _lines, query, r6
from .standins import SAMPLES, TRACK, samples, table
from .standins import track as fixes


@query("select user_id::varchar as file, arg_min(round(value, 6), event_id) as t, case when arg_min(event_id, event_id) % 2 = 0 then 'a, \"b\"' end as note from events group by user_id")
def src11_snapshot(spark, d):
    e = table(spark, d, "events")
    head = e.select("user_id").distinct().select(F.col("user_id").cast("string").alias("file"), F.lit(0).cast("long").alias("line_no"), F.lit("time,TEMP,note").alias("line"))
    # Rows are ragged: some have a quoted cell with a comma in it and one cell too many, the others one too few.
    more = F.when(F.col("event_id") % 2 == 0, F.lit('"a, ""b""",too many'))
    rows = e.select(F.col("user_id").cast("string").alias("file"), (F.col("event_id") + 1).alias("line_no"), F.concat_ws(",", F.lit("2024-01-01"), F.col("value").cast("string"), more).alias("line"))
    out = csvs.first_snapshot(head.unionByName(rows), {"time": "time", "TEMP": "t"}, (63.46, 10.39))
    noted = csvs.first_snapshot(head.unionByName(rows), {"time": "time", "note": "note"}, (63.46, 10.39), text=("note",))
    return out.join(noted.select("file", "note"), "file").select("file", r6("t").alias("t"), "note")


@query("select user_id::varchar as file, count(*) as n, 'degC' as unit, round(sum(value), 3) as total from events group by user_id")
def src12_units_row(spark, d):
    e = table(spark, d, "events")
    head = e.select("user_id").distinct().select(F.col("user_id").cast("string").alias("file"), F.posexplode(F.array(F.lit("time,TEMP"), F.lit("UTC,degC"))).alias("line_no", "line"))
    rows = e.select(F.col("user_id").cast("string").alias("file"), (F.col("event_id") + 2).cast("int").alias("line_no"), F.concat_ws(",", F.lit('"2024-01-01, noon"'), F.col("value").cast("string"), F.when(F.col("event_id") % 3 == 0, "x")).alias("line"))
    data, units = csvs.read_units_csv(head.unionByName(rows))
    own = data.groupBy("file").agg(F.count("*").alias("n"), F.round(F.sum(F.col("fields")["TEMP"].cast("double")), 3).alias("total"))
    return own.join(units.select("file", F.col("units")["TEMP"].alias("unit")), "file")


@query(f"with {TRACK} select event_id, value from track")
def src13_campaign_columns(spark, d):
    path = shared_path(spark, "campaign")
    fixes(spark, d).write.partitionBy("event_type").parquet(path)
    fixes(spark, d).write.parquet(f"{path}/stac/items")  # a catalogue's folder is no partition and not read
    return store.read_campaign(spark, path, ["event_id", "value", "absent"])


@query(f"with {SAMPLES} select day, channel % 2 as category, count(*) as n from samples group by all")
def snk07_products(spark, d):
    path = shared_path(spark, "product")
    own = samples(spark, d).withColumn("category", F.col("channel") % 2).select("day", "category", "channel", "sv")
    store.write_product(own, path)
    store.write_product(own.where("category = 1"), path)  # a second run replaces its own partitions
    return spark.read.parquet(path).groupBy("day", "category").agg(F.count("*").alias("n")).select("day", F.col("category").cast("long").alias("category"), "n")


@query(f"with {SEGMENTS} select day, count(*) as n_points, round(arg_min(lon, (t, event_id)), 6) as lon_start from seg group by day")
def snk10_day_segments(spark, d):
    return fixes(spark, d).groupBy("day").agg(F.count("*").alias("n_points"), r6(F.min_by("lon", F.struct("t", "event_id"))).alias("lon_start"))


@query("select event_id, case when event_id % 10 < 7 then (event_id % 100)::double end as mostly, (event_id % 5)::varchar as code from events")
def prj01_majority_types(spark, d):
    own = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 < 7, (F.col("event_id") % 100).cast("string")).otherwise("x").alias("mostly"), F.concat(F.when(F.col("event_id") % 2 == 0, "").otherwise("k"), (F.col("event_id") % 5).cast("string")).alias("code"))
    out = csvs.coerce_by_majority(own, 0.6)
    return out.select("event_id", "mostly", F.regexp_replace("code", "k", "").alias("code"))


@query("select event_id, ts from events")
def prj05_typed(spark, d):
    own = table(spark, d, "events").select("event_id", F.col("ts").cast("string").alias("time"))
    return csvs.typed(own).select("event_id", F.col("time").cast("timestamp_ntz").alias("ts"))


@query("select doc_id, source as platform from documents")
def prj07_platform_of(spark, d):
    return table(spark, d, "documents").select("doc_id", text.platform_of(F.concat_ws("_", F.lit("vessel"), F.col("source"))).alias("platform"))


@query(f"""with {SAMPLES}, h as (select event_id as ping_idx, sample_idx % 2 as channel, case when (event_id + sample_idx) % (event_id % 7 + 2) <> 0 then sv end as sv from samples), p as (select ping_idx, channel, avg(case when sv is null then 1.0 else 0.0 end) as f from h group by all),
m as (select ping_idx, min(f) as f from p group by ping_idx) select count(*) as n_rows from h where ping_idx in (select ping_idx from m where f < 0.2)""")
def prj17_pings_dropped(spark, d):
    from .queries import _holes

    return grid.drop_null_pings(_holes(spark, d), 0.2).agg(F.count("*").alias("n_rows"))


@query()
def prj28_constant_environment(spark, d):
    return environment.constant_environment(table(spark, d, "orders").select("o_orderkey"), 10.0, 35.0, 100.0).select("o_orderkey", r6("sound_speed").alias("sound_speed"))


@query("select o_orderkey, o_orderkey % 7 as depth, 'in_situ' as source from orders union all select o_orderkey, 5 + o_orderkey % 7, 'model' from orders")
def join11_blended_profile(spark, d):
    o = table(spark, d, "orders")
    surface = o.select("o_orderkey", (F.col("o_orderkey") % 7).alias("depth"), F.lit(1.0).alias("t"), F.lit(35.0).alias("s"))
    model = surface.withColumn("depth", F.explode(F.array(F.lit(1), F.col("depth") + 5)))
    return environment.blended_profile(surface, model, ["o_orderkey"]).select("o_orderkey", "depth", "source")


@query("select event_id, ts from events order by ts, event_id limit 10")
def ord02_head(spark, d):
    return table(spark, d, "events").orderBy("ts", "event_id").limit(10).select("event_id", "ts")


@query("select o_orderkey, case when abs((o_orderkey % 250) - 38) <= abs((o_orderkey % 250) - 120) and abs((o_orderkey % 250) - 38) <= abs((o_orderkey % 250) - 200) then 38 when abs((o_orderkey % 250) - 120) <= abs((o_orderkey % 250) - 200) then 120 else 200 end as preset from orders")
def ord04_best_match(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 250).alias("khz"))
    presets = F.array(*[F.lit(k) for k in (38, 120, 200)])
    near = F.array_min(F.transform(presets, lambda p: F.struct(F.abs(p - F.col("khz")).alias("d"), p.alias("p"))))
    return o.select("o_orderkey", near["p"].alias("preset"))


@query("select event_type, user_id, min(event_id) as event_id from events group by event_type, user_id")
def set04_pings_deduped(spark, d):
    return store.distinct_on(table(spark, d, "events"), ["event_type", "user_id"], ["event_id"]).select("event_type", "user_id", "event_id")


@query("""select o_orderkey, z as depth, round((0.106 * f1 * f / (f1 * f1 + f) + 0.52 * (1 + 10 / 43.0) * f2 * f / (f2 * f2 + f) * exp(-z / 6000.0) + 0.00049 * f * exp(-(10 / 27.0 + z / 17000.0))) / 1000, 9) as absorption
from (select o_orderkey, unnest([0, 100, 500, 1000]) as z, 38.0 * 38.0 as f, 0.78 * exp(10 / 26.0) as f1, 42.0 * exp(10 / 17.0) as f2 from orders)""")
def scl07_typical_depths(spark, d):
    own = table(spark, d, "orders").select("o_orderkey", F.explode(F.array(*[F.lit(x) for x in (0, 100, 500, 1000)])).alias("depth"))
    alpha = acoustics.absorption_ainslie_mccolm(F.lit(38.0), F.lit(10.0), F.lit(35.0), F.col("depth"), F.lit(8.0))
    return own.select("o_orderkey", "depth", F.round(alpha, 9).alias("absorption"))


@query(f"with {TRACK} select event_id, regexp_replace(regexp_replace(printf('%.6f', lat), '0+$', ''), '\\.$', '') as label from track")
def scl13_edge_text(spark, d):
    return fixes(spark, d).select("event_id", geo.edge_text(F.col("lat")).alias("label"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso from events")
def scl18_iso_text(spark, d):
    return table(spark, d, "events").select("event_id", geo.iso_utc(F.col("ts")).alias("iso"))


@query("select channel, count(*) filter (sv > limit_db) as n from (select s.*, case when channel % 2 = 0 then -60 else -50 end as limit_db from (with " + SAMPLES + " select * from samples) s) group by channel")
def scl19_stage_parameters(spark, d):
    rows = [(0, "x", "limit_db", -60.0), (1, "x", "limit_db", -50.0)]
    own = samples(spark, d).withColumns({"khz": (F.col("channel") % 2).cast("int"), "pulse": F.lit("x")})
    own = environment.stage_parameters(own, spark.createDataFrame(rows, "khz int, pulse string, key string, value double"), ["limit_db"])
    return own.groupBy("channel").agg(F.sum((F.col("sv") > F.col("limit_db")).cast("long")).alias("n"))


@query("select event_id, ts, value from events")
def str01_incremental(spark, d):
    """Two runs over a folder that grows between them; the second takes only what is new."""
    source, target, check = (shared_path(spark, n) for n in ("landing", "table", "ledger"))
    e = table(spark, d, "events").select("event_id", "ts", "value")
    for part in (0, 1):
        e.where(F.col("event_id") % 2 == part).write.mode("append").parquet(source)
        ingest.append_new_files(spark, source, e.schema, target, check, ["event_id"], ["ts"]).awaitTermination()
    return spark.read.parquet(target)


@query("select count(distinct user_id) as n from events")
def str02_streaming_distinct(spark, d):
    source, target, check = (shared_path(spark, n) for n in ("landing", "distinct", "state"))
    e = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    e.write.parquet(source)
    stream = spark.readStream.schema(e.schema).parquet(source)
    own = ingest.distinct_within(stream, ["user_id"], "ts", "3650 days")
    own.writeStream.format("parquet").option("path", target).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).agg(F.count("*").alias("n"))


@query("select user_id::varchar as file, count(*) as n from events group by user_id")
def udf03_registered_processor(spark, d):
    lines = _lines(spark, d, F.concat(F.date_format("ts", "MM/dd/yyyy,HH:mm:ss.SSS"), F.lit(", 1500.5")))
    return logs.PROCESSORS["ssv"](lines).groupBy("file").agg(F.count("*").alias("n"))


@query()
def clu03_methods(spark, d):
    methods = {"gradient": {"over_db": 20}, "maximum": {"least_db": -40, "stop_db": -60}}
    return echo.seabed_lines(_bed(spark, d), methods, 100, 400).select("channel", "ping_idx", "method", "seabed")


@query(f"with {SAMPLES} select channel, (t // 86400000000) as t_bin, count(*) as n from samples where sv is not null group by all having count(sv) > 0")
def agg30_no_empty_bins(spark, d):
    return grid.mvbs(samples(spark, d), 1000.0, 86_400_000_000).select("channel", F.floor(F.col("t_bin") / 86_400_000_000).alias("t_bin"), "n")
