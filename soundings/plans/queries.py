"""Registered queries: each applies an operator of the library, and most have the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import acoustics, geo, text
from ..operators import echo, environment, grid, statistics, timejoin, track
from ..session import shared_path
from ..sources import csvs, files, logs, store
from .standins import SAMPLES, TRACK, haversine, samples, table
from .standins import track as fixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c):
    return F.round(c, 6)


# Tracks

SEGMENTS = TRACK + """,
gaps as (select *, case when t - lag(t) over w <= 43200000000 then 0 else 1 end as split from track window w as (partition by platform order by t, event_id)),
seg as (select * exclude split, sum(split) over (partition by platform order by t, event_id rows unbounded preceding) as segment from gaps)"""


def _segmented(spark, d):
    return track.segments(fixes(spark, d), 720, tie=["event_id"])


@query(f"with {SEGMENTS} select event_id, segment::bigint as segment from seg")
def win01_segments(spark, d):
    return _segmented(spark, d).select("event_id", "segment")


@query(f"""with {SEGMENTS} select platform, segment::bigint as segment, count(*) as n_points, min(t) as t_start, max(t) as t_end, round(avg(value), 7) as mean_value,
 array_to_string(list(cast((lon * 100)::bigint as varchar) order by t, event_id), ',') as path from seg group by platform, segment having count(*) > 1""")
def agg08_segment_summary(spark, d):
    out = track.segment_summary(_segmented(spark, d), ["value"], tie=["event_id"], decimals=7)
    return out.withColumn("path", F.array_join(F.transform("coordinates", lambda c: F.round(c[0] * 100).cast("long").cast("string")), ",")).drop("coordinates")


@query(f"""with {SEGMENTS}, n as (select *, count(*) over (partition by platform, segment) as n, row_number() over w - 1 as rn,
 lag(lat) over w as la, lag(lon) over w as lo, lead(lat) over w as lb, lead(lon) over w as lp from seg window w as (partition by platform, segment order by t, event_id))
select event_id, (round(((degrees(atan2(sin(radians(lp - lo)) * cos(radians(lb)), cos(radians(la)) * sin(radians(lb)) - sin(radians(la)) * cos(radians(lb)) * cos(radians(lp - lo)))) + 360) % 360), 1) % 360) as bearing
from n where n >= 5 and rn > 0 and rn < n - 1 and rn % greatest(1, n // 5) = 0 and rn <= greatest(1, n // 5) * 4""")
def win02_arrows(spark, d):
    return track.arrows(_segmented(spark, d), 4, tie=["event_id"]).select("event_id", "bearing")


@query(f"""with {TRACK}, s as (select *, coalesce({haversine('lag(lat) over w', 'lag(lon) over w', 'lat', 'lon')}, 0) as step from track window w as (partition by platform order by t, event_id))
select event_id, round(step, 4) as step_nmi, round(sum(step) over (partition by platform order by t, event_id rows unbounded preceding), 3) as distance_nmi from s""")
def win03_distance(spark, d):
    return track.along_track(fixes(spark, d), tie=["event_id"]).select("event_id", F.round("step_nmi", 4).alias("step_nmi"), F.round("distance_nmi", 3).alias("distance_nmi"))


@query(f"""with {TRACK}, s as (select event_id, 60 * sqrt(pow(lat - lag(lat) over w, 2) + pow(lon - lag(lon) over w, 2)) as miles, (t - lag(t) over w) / 3.6e9 as hours from track window w as (partition by platform order by t, event_id)),
k as (select event_id, case when hours > 0 then miles / hours end as speed_knots from s) select event_id, round(speed_knots, 6) as speed_knots from k where speed_knots is null or speed_knots < 2000""")
def win04_speed_filter(spark, d):
    return track.speed_filter(fixes(spark, d), 2000, tie=["event_id"]).select("event_id", r6("speed_knots").alias("speed_knots"))


@query()
def win05_smoothing(spark, d):
    return echo.savitzky_golay(fixes(spark, d), "value", "smooth", 11, 2, ["platform"], "t").select("event_id", r6("smooth").alias("smooth"))


@query(f"""with {TRACK}, m as (select event_id, lat, lon, list(lat) over (w rows between 4 preceding and 1 preceding) as a, list(lat) over (w rows between 1 following and 4 following) as b,
 list(lon) over (w rows between 4 preceding and 1 preceding) as c, list(lon) over (w rows between 1 following and 4 following) as e from track window w as (partition by platform order by t, event_id))
select event_id, coalesce(greatest(abs(lat - list_median(list_concat(coalesce(a, []), coalesce(b, [])))), abs(lon - list_median(list_concat(coalesce(c, []), coalesce(e, []))))) > 30, false) as outlier from m""")
def win21_outliers(spark, d):
    return track.position_outliers(fixes(spark, d), 30, order=["t", "event_id"]).select("event_id", "outlier")


@query(f"""with {TRACK}, g as (select event_id, t, case when t - lag(t) over (order by t, event_id) <= 1800000000 then 0 else 1 end as split from track)
select event_id, sum(split) over (order by t, event_id rows unbounded preceding)::bigint as block from g""")
def win22_recording_breaks(spark, d):
    return track.recording_breaks(fixes(spark, d), 30, tie=["event_id"]).select("event_id", "block")


@query(f"""with {TRACK}, n as (select *, row_number() over (partition by platform, day order by t, event_id) - 1 as rn, count(*) over (partition by platform, day) as n from track)
select event_id from n where n <= 3 or rn in (0, (n - 1) // 2, n - 1)""")
def win24_capped_points(spark, d):
    return track.capped_points(fixes(spark, d), 3, ["platform", "day"], ["t", "event_id"]).select("event_id")


@query(f"""with {TRACK} select platform, day, min(t) as t_first, max(t) as t_last, arg_min(lon, (t, event_id)) as lon_first, arg_max(lat, (t, event_id)) as lat_last from track group by platform, day""")
def agg07_day_markers(spark, d):
    return track.day_markers(fixes(spark, d)).select("platform", "day", "t_first", "t_last", F.col("first.lon").alias("lon_first"), F.col("last.lat").alias("lat_last"))


@query(f"""with {TRACK} select platform, round(arg_min(lat, (t, event_id)), 6) as start_lat, round(arg_max(lon, (t, event_id)), 6) as end_lon from track group by platform""")
def agg29_endpoints(spark, d):
    return track.endpoints(fixes(spark, d)).select("platform", r6("start.lat").alias("start_lat"), r6("end.lon").alias("end_lon"))


@query(f"with {TRACK}, n as (select event_id, row_number() over (partition by platform order by t, event_id) - 1 as rn from track) select event_id from n where rn % 5 = 0")
def prj10_every_nth(spark, d):
    return track.every_nth(fixes(spark, d), 5, order=["t", "event_id"]).select("event_id")


# Time joins: events of type view are the reference, the others the sensor

SIDES = TRACK + """,
ref as (select platform, t, event_id as ref_id, value as v from track where event_type = 'view'), sensor as (select platform, t, event_id from track where event_type <> 'view'),
b as (select s.*, r.t as bt, r.ref_id as bid, r.v as bv from sensor s asof left join ref r on s.platform = r.platform and s.t >= r.t),
br as (select b.*, r.t as ft, r.ref_id as aid, r.v as av from b asof left join ref r on b.platform = r.platform and b.t <= r.t)"""


def _sides(spark, d):
    t = fixes(spark, d)
    ref = t.where("event_type = 'view'").select("platform", "t", F.col("event_id").alias("ref_id"), F.col("value").alias("v"))
    return t.where("event_type <> 'view'").select("platform", "t", "event_id"), ref


@query(f"with {SIDES} select event_id, case when t - bt <= 36000000000 then bid end as ref_id from br")
def join01_asof_backward(spark, d):
    s, r = _sides(spark, d)
    return timejoin.asof(s, r, ["platform"], ["ref_id"], "backward", 36_000_000_000).select("event_id", "match.ref_id")


@query(f"with {SIDES} select event_id, case when ft - t <= 36000000000 then aid end as ref_id from br")
def join02_asof_forward(spark, d):
    s, r = _sides(spark, d)
    return timejoin.asof(s, r, ["platform"], ["ref_id"], "forward", 36_000_000_000).select("event_id", "match.ref_id")


@query(f"""with {SIDES}, n as (select event_id, t, case when ft is null or t - bt <= ft - t then bid else aid end as rid, case when ft is null or t - bt <= ft - t then t - bt else ft - t end as d from br)
select event_id, case when d <= 36000000000 then rid end as ref_id from n""")
def join03_asof_nearest(spark, d):
    s, r = _sides(spark, d)
    return timejoin.asof(s, r, ["platform"], ["ref_id"], "nearest", 36_000_000_000).select("event_id", "match.ref_id")


LINE = "coalesce(case when ft > bt then bv + (av - bv) * (t - bt) / (ft - bt) else bv end, bv, av)"


@query(f"with {SIDES} select event_id, round({LINE}, 6) as v from br")
def join05_interpolated(spark, d):
    s, r = _sides(spark, d)
    return timejoin.interpolated(s, r, ["platform"], ["v"]).select("event_id", r6("v").alias("v"))


@query(f"""with {TRACK}, ref as (select platform, t, value as v from track where event_type = 'view'), sensor as (select platform, t, event_id from track where event_type <> 'view'),
times as (select platform, t, row_number() over (partition by platform order by t) as p from (select platform, t from ref union select platform, t from sensor)),
rp as (select platform, p, v from ref join times using (platform, t)), sp as (select platform, p, event_id from sensor join times using (platform, t)),
b as (select s.*, r.p as bt, r.v as bv from sp s asof left join rp r on s.platform = r.platform and s.p >= r.p), br as (select b.*, r.p as ft, r.v as av from b asof left join rp r on b.platform = r.platform and b.p <= r.p)
select event_id, round(coalesce(case when ft > bt then bv + (av - bv) * (p - bt) / (ft - bt) else bv end, bv, av), 6) as v from br""")
def join04_interpolated_by_position(spark, d):
    s, r = _sides(spark, d)
    return timejoin.interpolated_by_position(s, r, ["platform"], ["v"]).select("event_id", r6("v").alias("v"))


@query(f"""with {SIDES}, o as (select platform, t, v, row_number() over (partition by platform order by t) as up, row_number() over (partition by platform order by t desc) as down from ref),
e as (select platform, max(case when up = 1 then t end) as t1, max(case when up = 1 then v end) as v1, max(case when up = 2 then t end) as t2, max(case when up = 2 then v end) as v2,
 max(case when down = 1 then t end) as z1, max(case when down = 1 then v end) as w1, max(case when down = 2 then t end) as z2, max(case when down = 2 then v end) as w2 from o group by platform)
select event_id, case when bt is null then coalesce(v1 + (v2 - v1) * (t - t1) / (t2 - t1), v1) when ft is null then coalesce(w2 + (w1 - w2) * (t - z2) / (z1 - z2), w1) else {LINE} end as v
from br left join e on br.platform = e.platform""")
def join06_extrapolated(spark, d):
    s, r = _sides(spark, d)
    return timejoin.extrapolated(s, r, ["platform"], "v").select("event_id", "v")  # not rounded: values grow without bound as outer fixes come near each other


@query(f"with {SIDES} select event_id, round(coalesce(case when ft is null or t - bt <= ft - t then bv else av end, 0), 6) as speed from br")
def join07_nearest_navigation(spark, d):
    s, r = _sides(spark, d)
    return timejoin.asof(s, r, ["platform"], ["v"], "nearest").select("event_id", r6(F.coalesce("match.v", F.lit(0.0))).alias("speed"))


@query(f"""with {SIDES} select platform, count(*) as n, round(avg(case when t - bt <= 3600000000 then 1.0 else 0.0 end), 6) as matched from br group by platform""")
def join08_match_rate(spark, d):
    s, r = _sides(spark, d)
    own = timejoin.asof(s, r, ["platform"], ["ref_id"], "backward", 3_600_000_000)
    return own.groupBy("platform").agg(F.count("*").alias("n"), r6(F.avg(F.col("match").isNotNull().cast("double"))).alias("matched"))


@query(f"""with {TRACK}, l as (select platform, t, event_id from track where event_type = 'click'), a as (select platform, t, value as v from track where event_type = 'view'), m as (select platform, t, value as v from track where event_type not in ('view', 'click')),
x as (select l.*, r.t as b1, r.v as v1 from l asof left join a r on l.platform = r.platform and l.t >= r.t), y as (select x.*, r.t as a1, r.v as w1 from x asof left join a r on x.platform = r.platform and x.t <= r.t),
z as (select y.*, r.t as b2, r.v as v2 from y asof left join m r on y.platform = r.platform and y.t >= r.t), q as (select z.*, r.t as a2, r.v as w2 from z asof left join m r on z.platform = r.platform and z.t <= r.t),
p as (select event_id, case when a1 is null or t - b1 <= a1 - t then t - b1 else a1 - t end as d1, case when a1 is null or t - b1 <= a1 - t then v1 else w1 end as x1, case when a2 is null or t - b2 <= a2 - t then v2 else w2 end as x2 from q)
select event_id, round(case when d1 <= 7200000000 then x1 else x2 end, 6) as v, case when d1 <= 7200000000 then 'in_situ' when x2 is not null then 'model' end as source from p""")
def join10_first_source(spark, d):
    t = fixes(spark, d).withColumn("v", F.col("value"))
    left = t.where("event_type = 'click'").select("platform", "t", "event_id")
    own, model = t.where("event_type = 'view'").select("platform", "t", "v"), t.where("event_type not in ('view', 'click')").select("platform", "t", "v")
    return timejoin.first_source(left, [("in_situ", own, 7_200_000_000), ("model", model, None)], ["platform"], ["v"]).select("event_id", r6("v").alias("v"), "source")


@query(f"""with {SIDES}, pos as (select r.platform, r.t, t.lat from track t join ref r on t.event_id = r.ref_id), b2 as (select s.*, p.t as bt2, p.lat as bl from sensor s asof left join pos p on s.platform = p.platform and s.t >= p.t),
c2 as (select b2.*, p.t as at2, p.lat as al from b2 asof left join pos p on b2.platform = p.platform and b2.t <= p.t)
select event_id, round(case when least(abs(t - bt2), abs(at2 - t)) <= 36000000000 then coalesce(case when at2 > bt2 then bl + (al - bl) * (t - bt2) / (at2 - bt2) else bl end, bl, al) end, 6) as lat from c2""")
def join09_positioned_pings(spark, d):
    t = fixes(spark, d)
    pings = t.where("event_type <> 'view'").select("platform", "t", "event_id")
    return timejoin.interpolated(pings, t.where("event_type = 'view'").select("platform", "t", "lat"), ["platform"], ["lat"], 36_000_000_000).select("event_id", r6("lat").alias("lat"))


# Extents and statistics

EDGES = [float(x) for x in range(-60, 61, 20)]
LON_EDGES = [float(x) for x in range(-180, 181, 60)]


def _bin(c, edges, lowest=">"):
    return "case " + " ".join(f"when {c} {lowest if i == 0 else '>'} {a} and {c} <= {b} then {i}" for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))) + " end"


@query(f"with {TRACK}, b as (select *, {_bin('lat', EDGES)} as lat_i, {_bin('lon', LON_EDGES)} as lon_i from track) select lat_i, lon_i, round(avg(value), 6) as mean_value, count(*) as n from b where lat_i is not null and lon_i is not null group by lat_i, lon_i")
def agg01_mean_by_cell(spark, d):
    return grid.mean_by_cell(fixes(spark, d), EDGES, LON_EDGES, ["value"]).withColumn("mean_value", r6("mean_value"))


@query(f"with {TRACK} select count(*) as n_rows, ((max(t) - min(t)) // 86400000000)::bigint as days, min(lat) as south, max(lat) as north, min(lon) as west, max(lon) as east, count(distinct platform) as n_platforms, count(distinct (floor(lat), floor(lon))) as n_bins from track")
def agg02_report(spark, d):
    return statistics.report(fixes(spark, d))


@query("""with l as (select unnest([struct_pack(variable := 'l_quantity', v := l_quantity), struct_pack(variable := 'l_extendedprice', v := l_extendedprice), struct_pack(variable := 'l_discount', v := l_discount)], recursive := true) from lineitem)
select variable, min(v) as min, max(v) as max, round(avg(v), 6) as mean, count(v) as n_valid, 100.0 * count(v) / count(*) as valid_percent from l group by variable""")
def agg03_statistics(spark, d):
    return statistics.measurement_statistics(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("mean", r6("mean"))


@query(f"with {TRACK} select platform, grouping(platform)::bigint as level, min(lat) as south, max(lat) as north, min(lon) as west, max(lon) as east, min(t) as t0, max(t) as t1, count(*) as n from track group by grouping sets ((platform), ())")
def agg04_extents(spark, d):
    return statistics.extents(fixes(spark, d), ["platform"])


@query(f"""with {TRACK}, e as (select greatest(floor((min(lat) - 1) / 2) * 2, -90) as a, least(ceil((max(lat) + 1) / 2) * 2, 90) as b, greatest(floor((min(lon) - 1) / 2) * 2, -180) as c, least(ceil((max(lon) + 1) / 2) * 2, 180) as e from track)
select ((b - a) / 2)::int + 1 as n_lat, a as lat_first, b as lat_last, ((e - c) / 2)::int + 1 as n_lon from e""")
def agg05_grid_suggestion(spark, d):
    out = statistics.grid_suggestion(fixes(spark, d))
    return out.select(F.size("lat_edges").alias("n_lat"), F.col("lat_edges")[0].alias("lat_first"), F.element_at("lat_edges", -1).alias("lat_last"), F.size("lon_edges").alias("n_lon"))


@query(f"with {TRACK} select platform, count(*) as n_rows, min(event_type) as campaign_id from track group by platform")
def agg06_roster(spark, d):
    return statistics.roster(fixes(spark, d).withColumn("campaign_id", F.col("event_type")))


@query(f"""with {TRACK} select platform, day, """ + ", ".join(f"arg_min(round(value, 6), (t, event_id)) filter (event_type = '{v}') as {v}, arg_min(event_id % 9, (t, event_id)) filter (event_type = '{v}') as {v}_qc" for v in ("view", "click")) + " from track group by platform, day")
def agg10_pivot(spark, d):
    long = fixes(spark, d).select("platform", "day", "t", "event_id", F.col("event_type").alias("variable"), r6("value").alias("value"), (F.col("event_id") % 9).alias("value_qc"))
    return statistics.pivot_quality(long, ["platform", "day"], ["view", "click"], ["t", "event_id"])


# Grids

@query(f"with {SAMPLES} select channel, t // 86400000000 * 86400000000 as t_bin, floor(depth / 50) * 50.0 as depth_bin, round(10 * log10(avg(pow(10, sv / 10))), 6) as sv, count(*) as n from samples group by all")
def agg11_mvbs(spark, d):
    return grid.mvbs(samples(spark, d), 50.0, 86_400_000_000).withColumn("sv", r6("sv"))


@query(f"""with {SAMPLES}, s as (select platform as channel, row_number() over w - 1 as ping_idx, event_id, t, platform, coalesce({haversine('lag(lat) over w', 'lag(lon) over w', 'lat', 'lon')}, 0) as step from track window w as (partition by platform order by t, event_id)),
dist as (select channel, ping_idx, floor(round(sum(step) over (partition by platform order by t, event_id rows unbounded preceding), 6) / 5000)::bigint as distance_bin from s)
select channel, distance_bin, floor(depth / 100)::bigint as depth_bin, round(avg(pow(10, sv / 10)) * 100 * 4 * pi() * 1852 * 1852, 4) as nasc, count(*) as n from samples join dist using (channel, ping_idx) group by all""")
def agg12_nasc(spark, d):
    s = samples(spark, d)
    way = track.along_track(fixes(spark, d), tie=["event_id"]).select("event_id", F.round("distance_nmi", 6).alias("distance_nmi"))
    pings = s.where("sample_idx = 0").select("channel", "ping_idx", "event_id").join(way, "event_id")
    return grid.nasc(s, pings, 100.0, 5000.0).withColumn("nasc", F.round("nasc", 4))


def _cells(spark, d):
    return samples(spark, d).select("day", F.col("channel"), F.when(F.col("channel") % 2 == 0, 38).otherwise(200).alias("khz"), "depth", (F.col("sv") + 91).alias("nasc"))


@query(f"""with {SAMPLES}, c as (select day, case when channel % 2 = 0 then 38 else 200 end as khz, depth, sv + 91 as nasc from samples),
m as (select day, coalesce(sum(nasc) filter (khz = 200 and depth >= 10 and depth < 150), 0) as shallow, coalesce(sum(nasc) filter (khz = 38 and depth >= 150 and depth < 500), 0) as deep, coalesce(sum(nasc) filter (khz = 38), 0) as nasc_38, coalesce(sum(nasc) filter (khz = 200), 0) as nasc_200 from c group by day)
select *, shallow + deep as combined from m where shallow + deep >= 0.1""")
def agg13_depth_frequency(spark, d):
    return grid.depth_frequency_merge(_cells(spark, d), ["day"])


@query(f"""with {TRACK}, c as (select event_id, count(*) over (partition by round_even(lat / 20, 0), round_even(lon / 20, 0)) as n from track) select event_id from c where n >= 60""")
def agg14_sparse_removed(spark, d):
    return grid.drop_sparse(fixes(spark, d).withColumns({"lat": F.col("lat") / 20, "lon": F.col("lon") / 20}), 60).select("event_id")


@query(f"""with {TRACK}, n as (select count(*) as n from track), p as (select round(value, 1) as cap, value as p from (select value, row_number() over (order by value) as rn from track), n where rn = floor(n * 0.99) + 1)
select event_id, round(case when value > p then cap else value end, 6) as value from track, p""")
def agg15_capped(spark, d):
    return grid.cap_at_quantile(fixes(spark, d), "value").select("event_id", r6("value").alias("value"))


def _holes(spark, d):
    return samples(spark, d).withColumn("sv", F.when((F.col("event_id") + F.col("sample_idx")) % (F.col("event_id") % 7 + 2) != 0, F.col("sv"))).withColumns({"ping_idx": F.col("event_id"), "channel": F.col("sample_idx") % 2})


@query(f"""with {SAMPLES}, h as (select event_id as ping_idx, sample_idx % 2 as channel, case when (event_id + sample_idx) % (event_id % 7 + 2) <> 0 then sv end as sv from samples),
p as (select ping_idx, channel, avg(case when sv is null then 1.0 else 0.0 end) as f from h group by all) select ping_idx, round(min(f), 6) as null_fraction from p group by ping_idx""")
def agg16_null_fraction(spark, d):
    return grid.null_fraction(_holes(spark, d)).withColumn("null_fraction", r6("null_fraction"))


@query(f"""with {SAMPLES}, p as (select channel, ping_idx, 10 * log10(avg(pow(10, sv / 10))) as level from samples where depth between 200 and 400 group by all),
m as (select channel, quantile_cont(level, 0.5) as med, count(*) as n from p group by channel) select channel as day, ping_idx, round(level, 6) as level, n >= 20 and level > med + 0.5 as crosstalk from p join m using (channel)""")
def agg17_crosstalk(spark, d):
    s = samples(spark, d).withColumn("day", F.col("channel"))
    return grid.crosstalk_pings(s, 200, 400, 0.5, 20).withColumn("level", r6("level"))


@query(f"with {SAMPLES} select channel, ping_idx, quantile_cont(sv, 0.5) as p50, quantile_cont(sv, 0.75) as p75 from samples where depth between 100 and 300 group by all")
def agg19_band_statistics(spark, d):
    return echo.band_statistics(samples(spark, d), 100, 300)


@query(f"with {SAMPLES} select channel, sample_idx // 8 as sample_idx, round(10 * log10(avg(pow(10, sv / 10))), 6) as sv from samples group by all")
def agg23_downsampled(spark, d):
    return grid.downsample(samples(spark, d), "sample_idx", 8, "sv", ["channel"], log=True).withColumn("sv", r6("sv"))


@query(f"""with {TRACK}, o as (select *, (t - (select min(t) from track)) // 86400000000 as bin from track)
select bin, platform as depth_cell, round(avg(value), 6) as u, round(avg(lat), 6) as v, round(avg(event_id % 360), 6) as heading, count(distinct t) as n_pings from o group by all""")
def agg22_current_ensemble(spark, d):
    c = fixes(spark, d).select("t", F.col("platform").alias("depth_cell"), F.col("value").alias("u"), F.col("lat").alias("v"), F.col("lon").alias("w"), F.col("value").alias("amplitude"), (F.col("event_id") % 360).cast("double").alias("heading"))
    return grid.ensemble(c, 86400).select("bin", "depth_cell", r6("u").alias("u"), r6("v").alias("v"), r6("heading").alias("heading"), "n_pings")


@query(f"""with {SAMPLES}, c as (select depth, sv + 91 as nasc from samples), p as (select depth, avg(nasc) as m from c group by depth)
select min(nasc) as min, max(nasc) as max, round(avg(nasc), 6) as mean, quantile_cont(nasc, 0.5) as median, round(avg(nasc) filter (depth < 10) / avg(nasc) filter (depth >= 10), 6) as surface_ratio, (select arg_max(depth, (m, -depth)) from p) as peak_depth, (select round(sum(m), 5) from p) as integrated from c""")
def agg26_density_summary(spark, d):
    out = grid.density_summary(_cells(spark, d))
    return out.select("min", "max", r6("mean").alias("mean"), "median", r6("surface_ratio").alias("surface_ratio"), "peak_depth", F.round("integrated", 5).alias("integrated"))


@query(f"""with {SAMPLES}, p as (select channel // 2 as pair, ping_idx, sample_idx, max(sv) filter (channel % 2 = 0) - max(sv) filter (channel % 2 = 1) as difference from samples group by all)
select pair, count(*) as n_cells, count(difference) as n_both, count(*) filter (difference between -12 and -2) as n_mask from p group by pair""")
def join13_frequency_difference(spark, d):
    s = samples(spark, d).withColumns({"pair": F.floor(F.col("channel") / 2), "channel": F.when(F.col("channel") % 2 == 0, "low").otherwise("high")})
    out = grid.frequency_difference(s, "low", "high", keys=["pair", "ping_idx", "sample_idx"])
    return out.groupBy("pair").agg(F.count("*").alias("n_cells"), F.count("difference").alias("n_both"), F.sum(F.col("mask").cast("long")).alias("n_mask"))


@query(f"""with {SAMPLES} select t // 86400000000 * 86400000000 as t_bin, floor(depth / 50) * 50.0 as depth_bin, round(10 * log10(avg(pow(10, sv / 10)) filter (channel % 2 = 0)), 6) as low, round(10 * log10(avg(pow(10, sv / 10)) filter (channel % 2 = 1)), 6) as high from samples group by all""")
def join14_aligned(spark, d):
    cells = grid.mvbs(samples(spark, d).withColumn("channel", F.col("channel") % 2), 50.0, 86_400_000_000)
    out = grid.aligned([("low", cells.where("channel = 0")), ("high", cells.where("channel = 1"))], ["t_bin", "depth_bin"])
    return out.select("t_bin", "depth_bin", r6("low").alias("low"), r6("high").alias("high"))


@query(f"""with {SAMPLES}, n as (select channel, ping_idx, depth + (event_id % 7) as depth, sv, lead(depth + (event_id % 7)) over w as d1, lead(sv) over w as s1 from samples window w as (partition by channel, ping_idx order by depth)),
k as (select channel, ping_idx, depth as d0, sv as s0, d1, s1, unnest(range(ceil(depth / 25)::bigint, case when d1 is null then floor(depth / 25)::bigint + 1 else ceil(d1 / 25)::bigint end)) as k from n)
select channel, ping_idx, (k * 25)::double as depth, round(coalesce(s0 + (s1 - s0) * (k * 25.0 - d0) / (d1 - d0), s0), 6) as sv from k""")
def win25_regridded(spark, d):
    s = samples(spark, d).withColumn("depth", F.col("depth") + F.col("event_id") % 7)
    return grid.regrid(s, 25.0).withColumn("sv", r6("sv"))


@query(f"""with {TRACK}, s as (select platform, min(t) as start, max(value) as len from track group by platform), o as (select platform, coalesce(sum(len + 0.5) over (order by start, platform rows between unbounded preceding and 1 preceding), 0) as off from s)
select event_id, round(value + off, 4) as distance_nmi from track join o using (platform)""")
def win23_chained_offsets(spark, d):
    t = fixes(spark, d).select("event_id", F.col("platform").alias("store"), F.col("value").alias("distance_nmi"), "t")
    first = t.groupBy("store").agg(F.min("t").alias("store_start"))
    return grid.chained_offsets(t.join(first, "store")).select("event_id", F.round("distance_nmi", 4).alias("distance_nmi"))


# Masks, seabed, schools

@query(f"""with {SAMPLES}, p as (select channel, ping_idx, quantile_cont(sv, 0.5) as p50 from samples where depth between 100 and 300 group by all),
b as (select *, quantile_cont(p50, 0.5) over w as block, count(*) over w as n from p window w as (partition by channel order by ping_idx rows between 5 preceding and 5 following))
select channel, ping_idx, n = 11 and p50 - block < -2 as attenuated, n < 11 as unfeasible from b""")
def win06_attenuated(spark, d):
    return echo.attenuated_pings(samples(spark, d), 100, 300, 5, 2).select("channel", "ping_idx", "attenuated", "unfeasible")


@query(f"""with {SAMPLES}, l as (select *, coalesce(lag(sv) over w, -1e9) as a1, coalesce(lead(sv) over w, -1e9) as b1, coalesce(lag(sv, 2) over w, -1e9) as a2, coalesce(lead(sv, 2) over w, -1e9) as b2, min(ping_idx) over (partition by channel) as lo, max(ping_idx) over (partition by channel) as hi from samples window w as (partition by channel, sample_idx order by ping_idx))
select channel, count(*) filter ((sv - a1 > 10 and sv - b1 > 10 or sv - a2 > 10 and sv - b2 > 10) and ping_idx >= lo + 2 and ping_idx <= hi - 2) as n_impulse from l group by channel""")
def win07_impulse(spark, d):
    return echo.impulse_mask(samples(spark, d), [1, 2]).groupBy("channel").agg(F.sum(F.col("impulse").cast("long")).alias("n_impulse"))


@query()
def win08_transient_below(spark, d):
    own = echo.transient_below(samples(spark, d), (300, 480), 50, over_db=1, until_db=0.5, exclude_above=100)
    return own.groupBy("channel").agg(F.sum(F.col("transient").cast("long")).alias("n_transient"))


@query()
def win09_transient_block(spark, d):
    own = echo.transient_block(samples(spark, d), 2, 2, 0.15, 20, 100, 64)
    return own.groupBy("channel").agg(F.sum(F.col("transient").cast("long")).alias("n_transient"))


@query(f"""with {SAMPLES}, c as (select *, [coalesce(lag(sv) over w, sv), sv, coalesce(lead(sv) over w, sv)] as col from samples window w as (partition by channel, ping_idx order by sample_idx)),
n as (select channel, ping_idx, sample_idx, list_sort(list_concat(list_concat(coalesce(lag(col) over w, col), col), coalesce(lead(col) over w, col)))[5] as m from c window w as (partition by channel, sample_idx order by ping_idx))
select channel, ping_idx, sum(m) as total from n group by all""")
def win10_median(spark, d):
    return echo.median_3x3(samples(spark, d)).groupBy("channel", "ping_idx").agg(F.sum("sv_median").alias("total"))


@query(f"""with {SAMPLES}, a as (select channel, ping_idx, sample_idx, min((sv >= -75)::int) over w = 1 and count(*) over w = 3 as m from samples window w as (partition by channel, ping_idx order by sample_idx rows between 1 preceding and 1 following)),
b as (select channel, ping_idx, max(m::int) over w as m from a window w as (partition by channel, sample_idx order by ping_idx rows between 1 preceding and 1 following)) select channel, sum(m)::bigint as n from b group by channel""")
def win11_morphology(spark, d):
    own = samples(spark, d).withColumn("m", F.col("sv") >= -75)
    own = echo.morph(echo.morph(own, "m", "e", 0, 1, grow=False), "e", "g", 1, 0, grow=True)
    return own.groupBy("channel").agg(F.sum(F.col("g").cast("long")).alias("n"))


def _bed(spark, d):
    """An echo eight samples thick about sample 25, wandering with the ping."""
    off = F.abs(F.col("sample_idx") - 25 - F.col("ping_idx") % 3)
    return samples(spark, d).withColumn("sv", F.when(off <= 4, -30.0 - off).otherwise(F.col("sv") - 20))


@query()
def win14_seabed_morphological(spark, d):
    return echo.seabed(_bed(spark, d), "morphological", low=100, high=400, least_db=-66)


@query()
def win15_seabed_composite(spark, d):
    return echo.seabed(_bed(spark, d), "composite", low=100, high=400, least_db=-80)


@query(f"with {SAMPLES} select channel, ping_idx, sample_idx, round(avg(sv) over (partition by channel, sample_idx order by ping_idx rows between 5 preceding and 4 following), 6) as level from samples")
def win17_adaptive_level(spark, d):
    return echo.adaptive_level(samples(spark, d)).select("channel", "ping_idx", "sample_idx", r6("level").alias("level"))


@query(f"""with {SAMPLES}, v as (select *, last_value(case when sv >= -70 then sample_idx end ignore nulls) over (w rows unbounded preceding) as b, first_value(case when sv >= -70 then sample_idx end ignore nulls) over (w rows between current row and unbounded following) as a from samples window w as (partition by channel, ping_idx order by sample_idx)),
f as (select channel, ping_idx, sample_idx, coalesce(sv >= -70 or a - b - 1 <= 1, false) as f from v), h as (select *, last_value(case when f then ping_idx end ignore nulls) over (w rows unbounded preceding) as b, first_value(case when f then ping_idx end ignore nulls) over (w rows between current row and unbounded following) as a from f window w as (partition by channel, sample_idx order by ping_idx))
select channel, count(*) filter (f or coalesce(a - b - 1 <= 1, false)) as n from h group by channel""")
def win18_gaps_filled(spark, d):
    own = echo.fill_gaps(samples(spark, d).withColumn("m", F.col("sv") >= -70), "m", "f", 1, 1)
    return own.groupBy("channel").agg(F.sum(F.col("f").cast("long")).alias("n"))


@query()
def clu01_schools_weill(spark, d):
    return echo.SCHOOLS["weill"](samples(spark, d), least_db=-55, vertical_gap=1, horizontal_gap=0, least_height=2, least_length=2)


@query()
def clu02_schools_three_stage(spark, d):
    return echo.SCHOOLS["three_stage"](samples(spark, d), least_db=-60)


@query()
def agg21_school_statistics(spark, d):
    s = samples(spark, d)
    out = echo.school_statistics(echo.schools_weill(s, -55, 1, 0, 2, 2), s)
    return out.withColumn("share", r6("share"))


NOISE = SAMPLES + """,
pw as (select channel, ping_idx // 10 as ping_block, sample_idx // 5 as range_block, case when depth > 0 then sv - (20 * log10(case when depth > 0 then depth end) + 2 * 0.01 * depth) end as p from samples),
cell as (select channel, ping_block, range_block, 10 * log10(avg(pow(10, p / 10))) as p from pw group by all), noise as (select channel, ping_block, least(min(p), -100.0) as noise from cell group by all)"""


@query(f"with {NOISE} select channel, ping_block, round(noise, 6) as noise from noise")
def agg18_background_noise(spark, d):
    return echo.background_noise(samples(spark, d), F.lit(0.01), 10, 5, most_db=-100).withColumn("noise", r6("noise"))


@query(f"""with {NOISE}, l as (select s.*, case when depth > 0 then noise + 20 * log10(case when depth > 0 then depth end) + 2 * 0.01 * depth end as level from samples s left join noise n on s.channel = n.channel and s.ping_idx // 10 = n.ping_block),
c as (select *, case when pow(10, sv / 10) - pow(10, level / 10) > 0 then 10 * log10(case when pow(10, sv / 10) - pow(10, level / 10) > 0 then pow(10, sv / 10) - pow(10, level / 10) end) end as clean from l)
select channel, ping_idx, count(clean) as n_left, count(*) filter (coalesce(clean - level < 3, true)) as n_low from c group by all""")
def join16_noise_subtracted(spark, d):
    s = samples(spark, d)
    own = echo.subtract_noise(s, echo.background_noise(s, F.lit(0.01), 10, 5, most_db=-100), F.lit(0.01), 10)
    return own.groupBy("channel", "ping_idx").agg(F.count("sv_clean").alias("n_left"), F.sum(F.col("low_snr").cast("long")).alias("n_low"))


@query(f"""with {SAMPLES} select channel, round(100 * avg((sv > -40)::int), 6) as loud, round(100 * avg((depth < 50)::int), 6) as shallow from samples group by channel""")
def agg27_flag_shares(spark, d):
    s = samples(spark, d).withColumns({"loud": F.col("sv") > -40, "shallow": F.col("depth") < 50})
    out = echo.flag_shares(s, ["loud", "shallow"])
    return out.select("channel", r6("loud").alias("loud"), r6("shallow").alias("shallow"))


# Store: keys, bins, unions

KEYS = "l_orderkey, l_linenumber"


@query(f"select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over (partition by {KEYS} order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem) where rn = 1")
def set02_distinct_on(spark, d):
    own = store.distinct_on(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return own.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""with have as (select distinct {KEYS} from lineitem where l_returnflag = 'R') select l_orderkey, l_linenumber, l_partkey, l_suppkey from
 (select *, row_number() over (partition by {KEYS} order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem where l_returnflag <> 'R') n where rn = 1 and not exists (select 1 from have h where h.l_orderkey = n.l_orderkey and h.l_linenumber = n.l_linenumber)""")
def set03_upsert_rows(spark, d):
    li = table(spark, d, "lineitem")
    own = store.new_rows(li.where("l_returnflag = 'R'"), li.where("l_returnflag <> 'R'"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return own.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _label(prefix, edges, c):
    return "case " + " ".join(f"when {c} {'>=' if i == 0 else '>'} {a} and {c} <= {b} then '{prefix}_{int(a)}_{int(b)}'" for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))) + " end"


@query(f"with {TRACK} select {_label('lat', EDGES, 'lat')} as lat_bin, {_label('lon', LON_EDGES, 'lon')} as lon_bin, count(*) as n, sum(event_id)::bigint as ids from track group by all")
def snk01_partitioned_store(spark, d):
    path = shared_path(spark, "observations")
    store.write_observations(fixes(spark, d).withColumnsRenamed({"lat": "latitude", "lon": "longitude"}), path, EDGES, LON_EDGES, {"value": "degC"})
    return store.read_campaign(spark, path).groupBy("lat_bin", "lon_bin").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(f"with {TRACK} select event_id, lat, lon from track where event_type = 'view' and lat between -10.5 and 20.25 and lon between 5.5 and 99.5")
def src15_density_points(spark, d):
    path = shared_path(spark, "density")
    store.write_density(fixes(spark, d).withColumnRenamed("event_type", "campaign_id"), path, 30.0)
    return store.read_density(spark, path, (5.5, -10.5, 99.5, 20.25), "view", size=30.0).select("event_id", "lat", "lon")


@query("select o_orderkey as name from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def join19_unprocessed(spark, d):
    files = table(spark, d, "orders").select(F.col("o_orderkey").alias("name"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"))
    ledger = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("name"), F.sha2(F.col("l_orderkey").cast("string"), 256).alias("sha256"))
    return store.unprocessed(files, ledger).select("name")


@query("select event_id, ts, value, cast(null as bigint) as l_orderkey from events union all select null, null, null, l_orderkey from lineitem")
def src04_union(spark, d):
    return csvs.union_all([table(spark, d, "events").select("event_id", "ts", "value"), table(spark, d, "lineitem").select("l_orderkey")])


@query(f"with {TRACK} select event_id, value, lat from track where event_type in ('view', 'click') and lat between -20 and 20")
def src14_environment(spark, d):
    return store.read_environment(fixes(spark, d), {"event_id": "event_id", "value": "value", "lat": "lat"}, lat_range=(-20, 20), platforms=["view", "click"], lat="lat", platform="event_type")


# Text: files that Spark writes from the tables, then scans

def _lines(spark, d, line):
    """Log lines made from the events, numbered by event in a file for each platform."""
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("file"), F.col("event_id").alias("line_no"), line.alias("line"))


@query(f"""with {TRACK} select event_id, round(floor(abs(lat)) + (abs(lat) - floor(abs(lat))), 4) * case when lat < 0 then -1 else 1 end as latitude, round(abs(lon), 4) * case when lon < 0 then -1 else 1 end as longitude, (event_id % 9)::double as quality from track""")
def src05_nmea(spark, d):
    t = fixes(spark, d)
    ddmm = lambda c, w: F.format_string(f"%0{w}d%08.5f", F.floor(F.abs(c)).cast("int"), (F.abs(c) - F.floor(F.abs(c))) * 60)
    body = F.concat_ws(",", F.lit("GPGGA,000000.00"), ddmm(F.col("lat"), 2), F.when(F.col("lat") < 0, "S").otherwise("N"), ddmm(F.col("lon"), 3), F.when(F.col("lon") < 0, "W").otherwise("E"), (F.col("event_id") % 9).cast("string"), F.lit("10,0.8,10.0,M,,,"))
    lines = t.select(F.col("platform").cast("string").alias("file"), F.col("event_id").alias("line_no"), F.concat(F.lit("2024-02-17T00:00:00.000000Z $"), body).alias("line"))
    return logs.read_nmea(lines, ["GGA"]).select(F.col("line_no").alias("event_id"), F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"), "quality")


@query("select event_id, round(value, 6) as velocity from events where event_id % 3 <> 0")
def src07_sound_velocity(spark, d):
    line = F.concat(F.date_format("ts", "MM/dd/yyyy,HH:mm:ss.SSS"), F.lit(", "), F.when(F.col("event_id") % 3 == 0, "bad").otherwise(F.round("value", 6).cast("string")))
    return logs.read_sound_velocity(_lines(spark, d, line)).select(F.col("line_no").alias("event_id"), r6("velocity").alias("velocity"))


@query("select event_id, (event_id * 3)::varchar as value_2 from events")
def src08_fluorometer(spark, d):
    line = F.concat(F.date_format("ts", "MM/dd/yyyy,HH:mm:ss.SSS"), F.lit(",\x00"), F.concat_ws("\t", F.lit("06/14/22"), F.lit("06:25:23"), F.lit("695"), (F.col("event_id") * 3).cast("string"), F.lit("7")))
    return logs.read_fluorometer(_lines(spark, d, line)).select(F.col("line_no").alias("event_id"), "value_2")


@query("select event_id, event_id / 1000 as wire_out_m from events")
def src09_winch(spark, d):
    line = F.concat(F.lit("2022-06-14T06:25:23.876888Z \x1e\x0103RD,2022-05-14T16:17:36.502,"), F.format_string("%08d", "event_id"), F.lit(",00000000,-00004.8,2839"))
    return logs.read_winch(_lines(spark, d, line)).select(F.col("line_no").alias("event_id"), "wire_out_m")


@query("select user_id::varchar as file, round(sum(value), 3) as t090C, count(*) as n from events group by user_id")
def src10_cnv(spark, d):
    e = table(spark, d, "events")
    head = e.select("user_id").distinct().select(F.col("user_id").cast("string").alias("file"), F.posexplode(F.array(F.lit("# name 0 = t090C: Temperature"), F.lit("# name 1 = c0: Conductivity"), F.lit("*END*"))).alias("line_no", "line"))
    rows = e.select(F.col("user_id").cast("string").alias("file"), (F.col("event_id") + 3).cast("int").alias("line_no"), F.concat(F.lit("  "), F.col("value").cast("string"), F.lit("   1.5")).alias("line"))
    out = logs.read_cnv(head.unionByName(rows)).groupBy("file").pivot("name", ["t090C"]).agg(F.sum("value").alias("t"), F.count("value").alias("n"))
    return out.select("file", F.round("t090C_t", 3).alias("t090C"), F.col("t090C_n").alias("n"))


@query("select user_id::varchar as file, max(event_id)::varchar as cruise from events group by user_id")
def src19_key_values(spark, d):
    own = logs.key_values(_lines(spark, d, F.concat(F.lit("Cruise ID: "), F.col("event_id").cast("string"))))
    return own.select("file", logs.pick(F.col("pairs"), "campaign", "cruise id").alias("cruise"))


@query("select user_id::varchar as file, arg_max(value, event_id) filter (event_type = 'view') as v, arg_max(event_id, event_id) filter (event_type = 'click') as c from events group by user_id")
def agg09_merged_sentences(spark, d):
    rows = table(spark, d, "events").select(F.col("user_id").cast("string").alias("file"), F.col("event_id").alias("line_no"), F.when(F.col("event_type") == "view", F.col("value")).alias("v"), F.when(F.col("event_type") == "click", F.col("event_id")).alias("c"))
    return logs.merge_sentences(rows, ["file"])


# Expressions

@query("select o_orderkey, round(1448.96 + 4.591*t - 5.304e-2*t*t + 2.374e-4*t*t*t + 1.340*(s-35) + 1.630e-2*d + 1.675e-7*d*d - 1.025e-2*t*(s-35) - 7.139e-13*t*d*d*d, 6) as speed from (select o_orderkey, (o_orderkey % 30)::double as t, 30 + (o_custkey % 10)::double as s, (o_orderkey % 4000)::double as d from orders)")
def scl05_sound_speed(spark, d):
    o = table(spark, d, "orders")
    t, s, z = (F.col("o_orderkey") % 30).cast("double"), 30 + (F.col("o_custkey") % 10).cast("double"), (F.col("o_orderkey") % 4000).cast("double")
    return o.select("o_orderkey", r6(acoustics.speed_mackenzie(t, s, z)).alias("speed"))


@query()
def scl04_chen_millero(spark, d):
    o = table(spark, d, "orders")
    t, s, p = (F.col("o_orderkey") % 30).cast("double"), 30 + (F.col("o_custkey") % 10).cast("double"), (F.col("o_orderkey") % 100).cast("double")
    return o.select("o_orderkey", r6(acoustics.speed_chen_millero(t, s, p)).alias("speed"))


@query()
def scl06_absorption(spark, d):
    channels = spark.createDataFrame([("38", 38.0), ("200", 200.0)], "channel string, khz double")
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 30).cast("double").alias("temperature"), (30 + F.col("o_custkey") % 10).cast("double").alias("salinity"))
    return environment.row_environment(o, channels).select("o_orderkey", "channel", F.round("absorption", 9).alias("absorption"), r6("sound_speed").alias("sound_speed"))


@query("select o_orderkey, round(case when r > 0 then 20 * log10(case when r > 0 then r end) + 2 * 0.01 * r end, 6) as gain from (select o_orderkey, (o_orderkey % 500 - 3)::double as r from orders)")
def scl09_gain(spark, d):
    r = (F.col("o_orderkey") % 500 - 3).cast("double")
    return table(spark, d, "orders").select("o_orderkey", r6(acoustics.time_varied_gain(r, F.lit(0.01))).alias("gain"))


@query(f"with {TRACK} select event_id, round({haversine('lat', 'lon', 'lon / 2.5', 'lat * 2')}, 4) as nmi from track")
def scl01_distance(spark, d):
    return fixes(spark, d).select("event_id", F.round(geo.great_circle_nmi(F.col("lat"), F.col("lon"), F.col("lon") / 2.5, F.col("lat") * 2), 4).alias("nmi"))


@query("select o_orderkey, case when o_totalprice > 0 then round(10 * log10(case when o_totalprice > 0 then o_totalprice end), 6) else -999 end as db, round(pow(10, (o_orderkey % 60 - 90) / 10.0), 12) as lin from orders")
def scl03_decibels(spark, d):
    return table(spark, d, "orders").select("o_orderkey", r6(acoustics.to_db(F.col("o_totalprice"), -999.0)).alias("db"), F.round(acoustics.to_linear((F.col("o_orderkey") % 60 - 90).cast("double")), 12).alias("lin"))


@query("select o_orderkey, o_totalprice as x from orders")
def scl15_lenient_number(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.lenient_number(F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" dB"))).alias("x"))


@query("select user_id, sha256(string_agg(event_id::varchar || ',' || event_type, chr(10) order by event_id) || chr(10)) as sha256 from events group by user_id")
def scl17_content_hash(spark, d):
    """A text file for each platform, hashed as a stream."""
    path = shared_path(spark, "logs")
    own = table(spark, d, "events").select("event_id", F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"), F.concat_ws("/", F.pmod("user_id", F.lit(64)), F.concat(F.coalesce(F.col("user_id").cast("string"), F.lit("none")), F.lit(".log"))).alias("file"))
    files.write_text_files(own, path, "file", ["event_id"])
    return files.content_hashes(spark, path).select(F.regexp_extract("name", r"^(-?\d+)\.log$", 1).try_cast("long").alias("user_id"), "sha256")


@query("select event_id, case event_type when 'view' then 'mooring' when 'click' then 'vessel' else event_type end as code from events")
def prj06_codes(spark, d):
    own = table(spark, d, "events").select("event_id", F.col("event_type").alias("kind"))
    return csvs.normalise(own, {"kind": "code"}, {"code": {"view": "mooring", "click": "vessel"}}).select("event_id", "code")


@query(f"with {TRACK} select event_id, lat * 2 as latitude from track where lat * 2 between -90 and 90 and lon between -180 and 180")
def prj03_valid_positions(spark, d):
    own = fixes(spark, d).select("event_id", (F.col("lat") * 2).alias("latitude"), F.col("lon").alias("longitude"))
    return csvs.valid_positions(own).select("event_id", "latitude")


@query()
def prj09_points(spark, d):
    return fixes(spark, d).select("event_id", F.hex(geo.point_wkb(F.col("lon"), F.col("lat"))).alias("wkb"))


@query("select o_orderkey, case when o_orderkey % 6000 < 1000 then null when o_orderkey % 6000 < 2000 then 'explorer' else 'voyager' end as class from orders")
def join20_platform_class(spark, d):
    ranges = spark.createDataFrame([(1000, 1999, "explorer"), (2000, 10**9, "voyager")], "lo long, hi long, class string")
    return environment.platform_class(table(spark, d, "orders").withColumn("platform", F.col("o_orderkey") % 6000), ranges).select("o_orderkey", "class")


@query(f"""with {TRACK}, c as (select event_id as cell_id, lat, lon from track where event_type = 'view'), p as (select lat, lon from track where event_type = 'purchase')
select cell_id, exists (select 1 from p where sqrt(pow(p.lat - c.lat, 2) + pow(p.lon - c.lon, 2)) <= 1.5) as near from c""")
def join17_near_points(spark, d):
    t = fixes(spark, d)
    return environment.near_points(t.where("event_type = 'view'").select(F.col("event_id").alias("cell_id"), "lat", "lon"), t.where("event_type = 'purchase'"), 1.5).select("cell_id", "near")


@query(f"""with {TRACK}, g as (select (round((lat + 90) / 10))::bigint as iy, (round((lon + 180) / 10))::bigint as ix, event_id from track)
select event_id, greatest(-((iy * 7 + ix * 13) % 50 - 40)::double, 0) as bottom_depth from g""")
def join18_bathymetry(spark, d):
    cells = spark.range(0, 19).select(F.col("id").alias("iy"), F.explode(F.sequence(F.lit(0), F.lit(36))).alias("ix"))
    cells = cells.withColumn("elevation", ((F.col("iy") * 7 + F.col("ix") * 13) % 50 - 40).cast("double"))
    return environment.nearest_grid(fixes(spark, d), cells, -90, -180, 10).select("event_id", "bottom_depth")


@query(f"""with {TRACK}, c as (select value, event_id, lat, lon, unnest(range(ceil((lat - 3) / 2)::bigint, floor((lat + 3) / 2)::bigint + 1)) as iy from track where value > 0), e as (select *, unnest(range(ceil((lon - 3) / 2)::bigint, floor((lon + 3) / 2)::bigint + 1)) as ix from c),
w as (select *, sqrt(pow(iy * 2 - lat, 2) + pow(ix * 2 - lon, 2)) as dd from e) select iy, ix, round(sum(1 / greatest(dd, 1e-9) * value) / sum(1 / greatest(dd, 1e-9)), 5) as value from w where dd <= 3 group by iy, ix""")
def clu04_surface(spark, d):
    return environment.grid_surface(fixes(spark, d), "value", 2.0, 3.0).withColumn("value", F.round("value", 5))


@query("select l_orderkey, list_sort(list_distinct(list(case when l_linenumber % 2 = 0 then 38000 else 200000 end))) = [38000, 200000] as both from lineitem group by l_orderkey")
def prj24_pulse_category(spark, d):
    f = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("file"), F.when(F.col("l_linenumber") % 2 == 0, 38000).otherwise(200000).alias("hz"))
    return environment.pulse_category(f).select(F.col("file").alias("l_orderkey"), (F.col("category") == "short").alias("both"))


@query("select l_orderkey, case when l_orderkey % 2 = 0 then 'short' else 'long' end as mode from lineitem group by l_orderkey")
def prj25_pulse_mode(spark, d):
    p = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("file"), F.lit("c").alias("channel"), F.when(F.col("l_orderkey") % 2 == 0, 1.024e-3).otherwise(2.048e-3).alias("seconds"))
    return environment.pulse_mode(p).select(F.col("file").alias("l_orderkey"), "mode")


@query("select o_orderkey, case when o_orderkey % 2 = 0 then 27.5 else 25.0 end::double as gain from orders")
def join12_calibration(spark, d):
    c = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, 200).otherwise(38).alias("khz"), F.lit("long").alias("pulse"))
    cal = spark.createDataFrame([(200, "short", 27.5), (38, "long", 25.0)], "khz int, pulse string, gain double")
    return environment.calibrated(c, cal).select("o_orderkey", "gain")


@query("""with p as (select o_custkey as k, o_orderkey % 1000 as depth, (o_orderkey % 30)::double as t from orders) select k, arg_min(depth, (abs(depth - 400), depth, t)) as depth, arg_min(t, (abs(depth - 400), depth, t)) as t from (select distinct * from p) group by k""")
def join23_nearest_depth(spark, d):
    p = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 1000).alias("depth"), (F.col("o_orderkey") % 30).cast("double").alias("t"), F.lit(35.0).alias("s"))
    return environment.nearest_depth(p.distinct(), ["k"], F.lit(400)).select("k", "depth", "t")


@query()
def agg24_depth_weighted(spark, d):
    p = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 1000).cast("double").alias("depth"), (F.col("o_orderkey") % 30).cast("double").alias("t"), F.lit(35.0).alias("s"))
    own = p.groupBy("k", "depth").agg(F.avg("t").alias("t"), F.avg("s").alias("s"))
    return environment.depth_weighted(own, ["k"], 500.0, 38.0).select("k", r6("sound_speed").alias("sound_speed"), F.round("absorption", 9).alias("absorption"))


@query(f"""with {TRACK}, k as (select platform, t, event_id, case when event_id % 3 = 0 then event_id % 2 end as mode from track),
a as (select event_id, coalesce(mode, first_value(mode ignore nulls) over (w rows between current row and unbounded following), last_value(mode ignore nulls) over (w rows unbounded preceding)) as mode from k window w as (partition by platform order by t)) select event_id, mode from a""")
def join15_pulse_attribution(spark, d):
    t = fixes(spark, d).select("platform", "t", "event_id")
    known = t.where("event_id % 3 = 0").select("platform", "t", (F.col("event_id") % 2).alias("mode"))
    return environment.attributed_modes(t, known).select("event_id", "mode")


@query(f"with {TRACK} select event_id, 'Feature' as kind, round(lon, 6) as lon, platform from track")
def snk05_features(spark, d):
    own = store.geojson(fixes(spark, d), store.point(F.col("lon"), F.col("lat")), ["platform", "event_id"])
    j = lambda p: F.get_json_object("value", p)
    return own.select(j("$.properties.event_id").cast("long").alias("event_id"), j("$.type").alias("kind"), r6(j("$.geometry.coordinates[0]").cast("double")).alias("lon"), j("$.properties.platform").cast("long").alias("platform"))


@query(f"with {SEGMENTS} select platform, segment::bigint as segment, count(*) as n from seg group by all having count(*) > 1")
def snk04_track_features(spark, d):
    own = store.geojson(track.segment_summary(_segmented(spark, d), ["value"], tie=["event_id"]), store.line_string(F.col("coordinates")), ["platform", "segment", "n_points"])
    j = lambda p: F.get_json_object("value", p).cast("long")
    return own.select(j("$.properties.platform").alias("platform"), j("$.properties.segment").alias("segment"), j("$.properties.n_points").alias("n"))


@query("select user_id::varchar as file, case when user_id % 2 = 0 then 'emso' else 'generic' end as provider from events group by user_id")
def prj19_best_provider(spark, d):
    h = table(spark, d, "events").select("user_id").distinct().select(F.col("user_id").cast("string").alias("file"), F.when(F.col("user_id") % 2 == 0, F.array(F.lit("TEMP"), F.lit("PSAL"))).otherwise(F.array(F.lit("x"))).alias("columns"))
    rules = spark.createDataFrame([("emso", ["TEMP", "PSAL"]), ("ooi", ["TEMP", "obs"])], "provider string, markers array<string>")
    return environment.best_provider(h, rules).select("file", "provider")
