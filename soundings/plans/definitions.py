"""SQL of queries whose operators take several steps, written from their definitions; and queries of the scans by header, the stages and the seabed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import text
from ..operators import echo, grid
from ..session import shared_path
from ..sources import csvs, logs
from .queries import NOISE, SQL, _bed, query, r6
from .standins import EVENTS, SAMPLES, TRACK, sample_tasks, samples, table
from .standins import track as fixes

ALONG = "partition by channel, ping_idx order by sample_idx"
ACROSS = "partition by channel, sample_idx order by ping_idx"
BED = SAMPLES + """,
bed as (select * replace (case when abs(sample_idx - 25 - ping_idx % 3) <= 4 then -30.0 - abs(sample_idx - 25 - ping_idx % 3) else sv - 20 end as sv) from samples)"""


def _median(source: str) -> str:
    """``f``: the source with ``m``, the median of a cell and its neighbours, edge cells standing for those beyond."""
    return f"""m3 as (select *, [coalesce(lag(sv) over w, sv), sv, coalesce(lead(sv) over w, sv)] as col from {source} window w as ({ALONG})),
f as (select * exclude col, list_sort(list_concat(list_concat(coalesce(lag(col) over w, col), col), coalesce(lead(col) over w, col)))[5] as m from m3 window w as ({ACROSS}))"""


def _rectangle(source: str, mask: str, name: str, pings: int, depth: int, grow: bool) -> str:
    """``name``: the source with ``d``, its mask eroded or dilated by a rectangle; outside the grid is FALSE."""
    part = lambda c, w, k: f"max({c}::int) over ({w} rows between {k} preceding and {k} following) = 1" if grow else f"(min({c}::int) over ({w} rows between {k} preceding and {k} following) = 1 and count({c}) over ({w} rows between {k} preceding and {k} following) = {2 * k + 1})"
    return f"{name}_a as (select *, {part(mask, ALONG, depth)} as d0 from {source}), {name} as (select * exclude d0, {part('d0', ACROSS, pings)} as d from {name}_a)"


def _smoothed(source: str, value: str, by: str, order: str, window: int, degree: int, carry: str) -> str:
    """``smooth``: ``carry`` and ``s``, each value by the polynomial of least squares through its window; shorter groups as they are."""
    x = np.arange(window)
    rows = []
    for p in range(window):
        for j in range(window):
            unit = np.zeros(window)
            unit[j] = 1.0
            rows.append(f"({p}, {j}, {np.polyval(np.polyfit(x, unit, degree), p):.17g}::double)")
    h = window // 2
    return f"""weights(pos, j, w) as (values {', '.join(rows)}),
numbered as (select *, row_number() over (partition by {by} order by {order}) - 1 as i, count(*) over (partition by {by}) as n from {source}),
placed as (select *, case when i < {h} then i when i >= n - {h} then i - n + {window} else {h} end as pos from numbered),
smooth as (select {', '.join(f'a.{c}' for c in carry.split(', '))}, any_value(a.n) as n, any_value(a.i) as i, any_value(a.{value}) as plain, case when any_value(a.n) >= {window} then sum(w.w * b.{value}) else any_value(a.{value}) end as s
 from placed a left join weights w on w.pos = a.pos left join placed b on b.{by} = a.{by} and b.i = a.i - a.pos + w.j group by {', '.join(f'a.{c}' for c in carry.split(', '))})"""


SQL["win05_smoothing"] = f"with {TRACK}, {_smoothed('track', 'value', 'platform', 't', 11, 2, 'event_id')} select event_id, round(s, 6) as smooth from smooth"

SQL["win08_transient_below"] = f"""with {SAMPLES}, p as (select channel, ping_idx, quantile_cont(sv, 0.5) filter (depth between 300 and 480) as p50 from samples group by all),
b as (select *, quantile_cont(p50, 0.5) over (partition by channel order by ping_idx rows between 5 preceding and 5 following) as block from p), loud as (select channel, ping_idx from b where p50 - block > 1),
st as (select channel, ping_idx, floor(depth / 50) as s, quantile_cont(sv, 0.5) as m from samples where depth between 100 and 480 group by all),
ex as (select *, m - quantile_cont(m, 0.5) over (partition by channel, s order by ping_idx rows between 5 preceding and 5 following) as excess from st),
calm as (select channel, ping_idx, (max(s) + 1) * 50 as top from ex where excess < 0.5 group by all), cut as (select loud.channel, loud.ping_idx, coalesce(top, 100) as top from loud left join calm using (channel, ping_idx))
select channel, (count(*) filter (depth >= top and depth >= 100))::bigint as n_transient from samples left join cut using (channel, ping_idx) group by channel"""

BLOCK = """near as (select a.channel, a.ping_idx, a.sample_idx, any_value(a.sv) as sv, any_value(a.depth) as depth, quantile_cont(pow(10, b.sv / 10), 0.15) as q, count(*) as n
 from samples a join samples b on a.channel = b.channel and b.ping_idx between a.ping_idx - 2 and a.ping_idx + 2 and b.sample_idx between a.sample_idx - 2 and a.sample_idx + 2 group by all),
transient as (select channel, ping_idx, sample_idx, n = 25 and depth >= 100 and sv - 10 * log10(q) > 20 + 1e-9 as transient from near)"""
SQL["win09_transient_block"] = f"with {SAMPLES}, {BLOCK} select channel, (count(*) filter (transient))::bigint as n_transient from transient group by channel"

SQL["win12_seabed_maximum"] = f"""with {BED}, {_median('bed')},
g as (select *, 10 * log10(avg(pow(10, m / 10)) over (w rows between 5 preceding and 1 preceding)) as mm, count(*) over (w rows between 5 preceding and 1 preceding) as nn from f window w as ({ALONG})),
p as (select *, arg_max(sample_idx, (m, -sample_idx)) filter (depth between 100 and 400 and m >= -40) over (partition by channel, ping_idx) as peak from g)
select channel, ping_idx, max(sample_idx) as seabed from p where sample_idx <= peak and (nn < 5 or coalesce(mm < -60, true)) group by all"""


@query(SQL["win12_seabed_maximum"])
def win12_seabed_maximum(spark, d):
    return echo.seabed(_bed(spark, d), "maximum", low=100, high=400, least_db=-40, stop_db=-60)


@query(f"""with {BED}, {_median('bed')}, g as (select *, m - lag(m) over ({ALONG}) as dv from f) select channel, ping_idx, min(sample_idx) as seabed from g where depth between 100 and 400 and dv > 12 group by all""")
def win13_seabed_gradient(spark, d):
    return echo.seabed(_bed(spark, d), "gradient", low=100, high=400, over_db=12)


GRADIENT = f"""{BED}, {_median('bed')}, g as (select channel, ping_idx, min(sample_idx) as seabed from (select *, m - lag(m) over ({ALONG}) as dv from f) where depth between 100 and 400 and dv > 12 group by all)"""


@query(f"""with {GRADIENT} select s.channel, s.ping_idx, count(*) filter (g.seabed is null or depth < g.seabed * 10 - 10) as n_kept from bed s left join g on s.channel = g.channel and s.ping_idx = g.ping_idx group by all""")
def prj13_below_seabed(spark, d):
    s = _bed(spark, d)
    line = echo.seabed_gradient(s, 100, 400, 12).withColumn("seabed_depth", F.col("seabed") * 10.0)
    return echo.mask_below_seabed(s, line, 10).groupBy("channel", "ping_idx").agg(F.count("sv").alias("n_kept"))


@query(f"""with {GRADIENT}, p as (select channel, count(*) as n from pings group by channel)
select p.channel, round(count(seabed) / max(n), 6) as rate, round(avg(seabed * 10.0::double), 6) as mean, round(stddev_pop(seabed * 10.0::double), 6) as std, min(seabed * 10.0::double) as min, max(seabed * 10.0::double) as max from p left join g on g.channel = p.channel group by p.channel""")
def agg20_seabed_statistics(spark, d):
    s = _bed(spark, d)
    line = echo.seabed_gradient(s, 100, 400, 12).withColumn("depth", F.col("seabed") * 10.0)
    out = echo.seabed_statistics(line, s)
    return out.select("channel", *[r6(c).alias(c) for c in ("rate", "mean", "std")], "min", "max")


SQL["win14_seabed_morphological"] = f"""with {BED}, {_median('bed')}, x as (select *, m >= -66 and depth between 100 and 400 as k from f),
{_rectangle('x', 'k', 'eroded', 1, 1, False)}, e as (select * rename (d as e) from eroded), {_rectangle('e', 'e', 'grown', 3, 9, True)},
line as (select channel, ping_idx, min(sample_idx)::double as v from grown where d and depth between 100 and 400 group by all), {_smoothed('line', 'v', 'channel', 'ping_idx', 11, 1, 'channel, ping_idx')}
select channel, ping_idx, (case when n > 11 then trunc(round(s, 6)) else plain end)::int as seabed from smooth"""

SQL["win15_seabed_composite"] = f"""with {BED}, {_median('bed')},
lim as (select *, greatest(quantile_cont(case when depth between 100 and 400 then m end, 0.75) over (partition by channel, ping_idx) - 3, -80) as lim from f),
x as (select *, m > lim and depth between 100 and 400 as k from lim), {_rectangle('x', 'k', 'eroded', 0, 1, False)}, e as (select * rename (d as e) from eroded), {_rectangle('e', 'e', 'grown', 1, 2, True)},
a as (select *, max(d::int) over (partition by channel, ping_idx) = 1 as kept from grown),
l as (select channel, ping_idx, max(sample_idx) filter (case when kept then d else k end and depth between 100 and 400) as own, max(sample_idx) filter (k) as loud, max(sample_idx) as bottom from a group by all),
h as (select *, (own is not null)::int as has from l),
c as (select *, has + coalesce(lag(has, 1) over w, first_value(has) over w) + coalesce(lag(has, 2) over w, first_value(has) over w) + coalesce(lead(has, 1) over w, last_value(has) over (w rows between current row and unbounded following))
 + coalesce(lead(has, 2) over w, last_value(has) over (w rows between current row and unbounded following)) as near from h window w as (partition by channel order by ping_idx)),
line as (select channel, ping_idx, own is not null and near >= 2 as detected, coalesce(case when near >= 2 then own end, loud, bottom)::double as v, bottom from c),
{_smoothed('line', 'v', 'channel', 'ping_idx', 31, 1, 'channel, ping_idx, detected, bottom')},
k as (select *, coalesce(abs(s - lag(s) over w), 0) <= 5 as good from smooth window w as (partition by channel order by ping_idx)),
z as (select *, last_value(case when good then i end ignore nulls) over (w rows unbounded preceding) as ia, last_value(case when good then s end ignore nulls) over (w rows unbounded preceding) as sa,
 first_value(case when good then i end ignore nulls) over (w rows between current row and unbounded following) as ib, first_value(case when good then s end ignore nulls) over (w rows between current row and unbounded following) as sb from k window w as (partition by channel order by ping_idx))
select channel, ping_idx, detected, least(greatest(trunc(round(coalesce(sa + (sb - sa) * (i - ia) / greatest(ib - ia, 1), sa, sb, s), 6)), 0), bottom)::int as seabed from z"""

_ANGLES = "((event_id * 3 + sample_idx) % 23) / 46.0 as along, ((event_id + sample_idx * 5) % 19) / 38.0 as athwart"


def _box(c: str, w: str) -> str:
    return f"(coalesce(lag({c}) over ({w}), {c}) + {c} + coalesce(lead({c}) over ({w}), {c})) / 3"


@query(f"""with {SAMPLES}, g as (select channel, ping_idx, sample_idx, depth, {_ANGLES} from samples), a as (select *, {_box('along * 22 * 128 / 180', ALONG)} as a1, {_box('athwart * 22 * 128 / 180', ALONG)} as b1 from g),
b as (select *, {_box('a1', ACROSS)} as a2, {_box('b1', ACROSS)} as b2 from a) select channel, ping_idx, min(sample_idx) as seabed from b where depth between 100 and 400 and (a2 > 5 or b2 > 4.5) group by all""")
def win16_seabed_angle(spark, d):
    own = samples(spark, d).withColumns({"angle_alongship": (F.col("event_id") * 3 + F.col("sample_idx")) % 23 / 46.0, "angle_athwartship": (F.col("event_id") + F.col("sample_idx") * 5) % 19 / 38.0})
    return echo.seabed(own, "angle", low=100, high=400, along=5.0, athwart=4.5)


@query(f"""with {NOISE}, {BLOCK}, l as (select s.*, case when depth > 0 then noise + 20 * log10(case when depth > 0 then depth end) + 2 * 0.01 * depth end as level from samples s left join noise n on s.channel = n.channel and s.ping_idx // 10 = n.ping_block),
cl as (select *, case when pow(10, sv / 10) - pow(10, level / 10) > 0 then 10 * log10(case when pow(10, sv / 10) - pow(10, level / 10) > 0 then pow(10, sv / 10) - pow(10, level / 10) end) end as clean from l),
im as (select *, coalesce(lag(sv) over w, -1e9) as a1, coalesce(lead(sv) over w, -1e9) as b1, min(ping_idx) over (partition by channel) as lo, max(ping_idx) over (partition by channel) as hi from cl window w as ({ACROSS})),
ap as (select channel, ping_idx, quantile_cont(sv, 0.5) filter (depth between 100 and 300) as p50 from samples group by all),
ab as (select *, quantile_cont(p50, 0.5) over w as block, count(*) over w as n from ap window w as (partition by channel order by ping_idx rows between 5 preceding and 5 following)),
mk as (select im.channel, im.sv, coalesce(clean - level < 3, true) as background, (sv - a1 > 10 and sv - b1 > 10 and ping_idx > lo and ping_idx < hi) or ping_idx <= lo or ping_idx >= hi as impulse, transient, n <> 11 or p50 - block < -2 as attenuation
 from im join transient using (channel, ping_idx, sample_idx) join ab using (channel, ping_idx))
select channel, (count(*) filter (background or impulse or transient or attenuation))::bigint as n_masked, (count(*) filter (not (background or impulse or transient or attenuation)))::bigint as n_left from mk group by channel""")
def set05_denoised(spark, d):
    stages = [
        ("impulse", {"lags": [1]}), ("transient", {"pings": 2, "depth": 2, "over_db": 20, "below_m": 100, "block": 64}),
        ("attenuation", {"low": 100, "high": 300, "half": 5, "below_db": 2}), ("background", {"pings": 10, "ranges": 5, "most_db": -100}),
    ]
    own = samples(spark, d).select("channel", "ping_idx", "sample_idx", "depth", "sv")  # the kernel carries what it is given
    own = echo.denoise(own, stages, mask_unfeasible=True, tasks=sample_tasks(spark, d))
    return own.groupBy("channel").agg(F.sum(F.col("masked").cast("long")).alias("n_masked"), F.count("sv_clean").alias("n_left"))


@query(f"with {SAMPLES} select channel, count(*)::bigint as n_low from samples where depth < 0 or sv < -80 group by channel")
def udf01_registered_stage(spark, d):
    """A stage of one's own beside one that fails, which is left out with a warning."""
    echo.register_stage("quiet", lambda df, below: df.withColumn("quiet", F.col("sv") < below))
    echo.register_stage("broken", lambda df: df.withColumn("broken", F.col("no such column")))
    own = echo.denoise(samples(spark, d), [("broken", {}), ("quiet", {"below": -80})])
    return own.where("masked").groupBy("channel").agg(F.count("*").alias("n_low"))


# Published formulas

_FG = """(8.86 / c * pow(10, 0.78 * ph - 5) * f1 * f / (f1 * f1 + f) + 21.44 * s / c * (1 + 0.025 * t) * (1 - 1.37e-4 * z + 6.2e-9 * z * z) * f2 * f / (f2 * f2 + f)
 + (case when t < 20 then 4.937e-4 - 2.59e-5 * t + 9.11e-7 * t * t - 1.50e-8 * t * t * t else 3.964e-4 - 1.146e-5 * t + 1.45e-7 * t * t - 6.5e-10 * t * t * t end) * (1 - 3.83e-5 * z + 4.9e-10 * z * z) * f) / 1000"""
_MACKENZIE = "1448.96 + 4.591 * t - 5.304e-2 * t * t + 2.374e-4 * t * t * t + 1.340 * (s - 35) + 1.630e-2 * z + 1.675e-7 * z * z - 1.025e-2 * t * (s - 35) - 7.139e-13 * t * z * z * z"
_TERMS = "2.8 * sqrt(s / 35) * pow(10, 4 - 1245 / (t + 273)) as f1, 8.17 * pow(10, 8 - 1990 / (t + 273)) / (1 + 0.0018 * (s - 35)) as f2, khz * khz as f"

SQL["scl06_absorption"] = f"""with o as (select o_orderkey, (o_orderkey % 30)::double as t, (30 + o_custkey % 10)::double as s, 0.6::double as z, 8.1::double as ph, unnest([38.0::double, 200.0::double]) as khz from orders),
c as (select *, {_MACKENZIE} as c, {_TERMS} from o) select o_orderkey, khz::int::varchar as channel, round({_FG}, 9) as absorption, round(c, 6) as sound_speed from c"""
SQL["scl08_row_environment"] = f"""with o as (select event_id, (10 + value % 10)::double as t, 35::double as s, 0.6::double as z, 8.1::double as ph, unnest([38.0::double, 120.0::double]) as khz from events),
c as (select *, {_MACKENZIE} as c, {_TERMS} from o) select event_id, khz::int::varchar as channel, round(c, 6) as sound_speed, round({_FG}, 9) as absorption from c"""
SQL["scl07_absorption_track"] = f"""with {TRACK}, a as (select event_id, 10 + abs(lat) / 10 as t, 1444.0::double as f from track), b as (select *, 0.78 * exp(t / 26) as f1, 42 * exp(t / 17) as f2 from a)
select event_id, round((0.106 * f1 * f / (f1 * f1 + f) + 0.52 * (1 + t / 43) * f2 * f / (f2 * f2 + f) * exp(-0.1 / 6) + 0.00049 * f * exp(-(t / 27 + 0.1 / 17))) / 1000, 9) as absorption from b"""


def _power_sum(x: str, *c: float) -> str:
    return "(" + " + ".join(f"{v!r}::double * pow({x}, {k})" for k, v in enumerate(c)) + ")"


# The published coefficients of the UNESCO equation, ascending powers of t, one entry for each power of p.
_CW = [(1402.388, 5.03711, -5.80852e-2, 3.3420e-4, -1.47800e-6, 3.1464e-9), (0.153563, 6.8982e-4, -8.1788e-6, 1.3621e-7, -6.1185e-10), (3.1260e-5, -1.7107e-6, 2.5974e-8, -2.5335e-10, 1.0405e-12), (-9.7729e-9, 3.8504e-10, -2.3643e-12)]
_A = [(1.389, -1.262e-2, 7.164e-5, 2.006e-6, -3.21e-8), (9.4742e-5, -1.2580e-5, -6.4885e-8, 1.0507e-8, -2.0122e-10), (-3.9064e-7, 9.1041e-9, -1.6002e-10, 7.988e-12), (1.100e-10, 6.649e-12, -3.389e-13)]


def _unesco() -> str:
    in_p = lambda table: " + ".join(f"{_power_sum('t', *row)} * pow(p, {k})" for k, row in enumerate(table))
    b = f"({_power_sum('t', -1.922e-2, -4.42e-5)} + {_power_sum('t', 7.3637e-5, 1.7945e-7)} * p)"
    return f"({in_p(_CW)}) + ({in_p(_A)}) * s + {b} * s * sqrt(s) + (1.727e-3 - 7.9836e-6 * p) * s * s"


SQL["scl04_chen_millero"] = f"select o_orderkey, round({_unesco()}, 6) as speed from (select o_orderkey, (o_orderkey % 30)::double as t, (30 + o_custkey % 10)::double as s, (o_orderkey % 100)::double as p from orders)"
SQL["prj28_constant_environment"] = f"select o_orderkey, round({_unesco()}, 6) as sound_speed from (select o_orderkey, 10::double as t, 35::double as s, 10::double as p from orders)"


# Scans by header

@query(f"with {TRACK} select event_id::varchar as event_id, lat as latitude, lon as longitude, round(value, 6) as value from track where event_id % 3 < 2")
def src01_csv_directory(spark, d):
    """A folder with three headers: columns in two orders, and files without a position."""
    path, t = shared_path(spark, "csv"), fixes(spark, d)
    kinds = (["event_id", "lat as latitude", "lon as longitude", "value", "'nan' as empty"], ["value", "lon as longitude", "event_id", "lat as latitude"], ["t as time", "value as SAL"])
    for k, columns in enumerate(kinds):
        t.where(F.col("event_id") % 3 == k).selectExpr(*columns).write.mode("append").option("header", True).csv(path)
    own = csvs.coerce_by_majority(csvs.read_csv_directory(spark, path), skip=["event_id", "platform_id", "latitude", "longitude"])
    return own.select("event_id", "latitude", "longitude", r6("value").alias("value"))


@query(f"with {TRACK} select event_id::varchar as event_id, lat::varchar as latitude, (event_id % 4)::varchar as part, (select count(distinct event_id % 4) from track) as n_files from track")
def src02_geocsv(spark, d):
    """Files with a block of ``#`` lines, a header, and rows of which some begin with ``#`` too; of each part a file for a range of events."""
    path = shared_path(spark, "geocsv")
    k, file = (F.col("event_id") % 4).alias("k"), F.concat_ws("-", F.col("event_id") % 4, F.floor(F.col("event_id") / (4 * EVENTS))).alias("f")
    t = fixes(spark, d).select(k, file, "event_id", F.concat_ws(",", F.concat(F.when(F.col("event_id") % 5 == 0, "#").otherwise(""), F.col("event_id").cast("string")), F.col("lat").cast("string")).alias("value"))
    head = t.select("k", "f").distinct().select("f", F.posexplode(F.array(F.lit("# dataset: GeoCSV 2.0"), F.concat(F.lit("# part: "), F.col("k").cast("string")), F.lit("event_id,latitude"))).alias("at", "value"))
    rows = head.select("f", (F.col("at") - 3).cast("long").alias("at"), "value").unionByName(t.select("f", F.col("event_id").alias("at"), "value"))
    rows.repartition("f").sortWithinPartitions("f", "at").select("f", "value").write.partitionBy("f").text(path)
    data, metadata = csvs.read_geocsv(spark, f"{path}/*")
    n = metadata.where("metadata['dataset'] = 'GeoCSV 2.0'").agg(F.countDistinct(F.element_at("metadata", "part")).alias("n_files"))
    own = data.select(F.regexp_replace("event_id", "^#", "").alias("event_id"), "latitude")
    return own.withColumn("part", (F.col("event_id").cast("long") % 4).cast("string")).join(F.broadcast(n))


@query(f"with {TRACK} select event_id::varchar as event_id, case when event_id % 3 = 0 then lat end as latitude, case when event_id % 3 = 1 then lat::varchar end as ship_latitude from track where event_id % 3 < 2")
def src03_validated(spark, d):
    path, t = shared_path(spark, "valid"), fixes(spark, d)
    kinds = (["event_id", "lat as latitude", "lon as longitude"], ["lon as ship_longitude", "event_id", "lat as ship_latitude"], ["event_id", "value"])
    for k, columns in enumerate(kinds):
        t.where(F.col("event_id") % 3 == k).selectExpr(*columns).write.mode("append").option("header", True).csv(path)
    return csvs.read_validated(spark, path).select("event_id", "latitude", "ship_latitude")


@query("""with n as (select user_id, row_number() over (partition by user_id order by event_id) - 1 as line_no from events)
select user_id::varchar as file, max((user_id % 3 = 0 or user_id % 3 = 2 and line_no >= 20)::int) filter (line_no < 50) = 1 as is_nmea from n group by user_id""")
def src06_nmea_sniff(spark, d):
    """Files of sentences, of something else, and with sentences after a while only."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    e = table(spark, d, "events").withColumn("line_no", n)
    has = (F.col("user_id") % 3 == 0) | ((F.col("user_id") % 3 == 2) & (F.col("line_no") >= 20))
    line = F.when(has, "2024-02-17T00:00:00Z $GPVTG,1,T,,M,2,N,3,K").otherwise("06/14/2022,06:25:23.876, 1500.5")
    return logs.nmea_files(e.select(F.col("user_id").cast("string").alias("file"), "line_no", line.alias("line")))


@query("select o_orderkey, case when o_orderkey % 4 <> 0 then o_orderdate::date end as day from orders")
def scl14_name_date(spark, d):
    day = F.date_format("o_orderdate", "yyyyMMdd"), F.date_format("o_orderdate", "yyyy-MM-dd")
    name = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("survey_"), F.col("o_orderkey").cast("string").substr(1, 3), F.lit(".raw")))
    name = name.when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("D"), day[0], F.lit("-T0102.raw"))).otherwise(F.concat(F.lit("line_"), day[1], F.lit(".csv")))
    return table(spark, d, "orders").select("o_orderkey", text.name_date(name).alias("day"))


@query("""with b as (select event_id, value as v, (event_id % 7) * 0.1 as e from events),
x as (select *, v * 0.5 - 1.0 * 0.5 as x, 2.0 * 0.25 + 3.0 * 0.25 as y, 1.5 as z, (event_id % 4) as bad from b)
select event_id, round(case when bad <= 2 and e <= 0.3 + 1e-12 then 0.8 * x - 0.6 * y end, 6) as u, round(case when bad <= 2 and e <= 0.3 + 1e-12 then 0.6 * x + 0.8 * y end, 6) as v, round(case when bad <= 2 and e <= 0.3 + 1e-12 then z end, 6) as w from x""")
def scl12_beam_to_earth(spark, d):
    """Beams mixed by a real matrix, turned by a rotation; too few beams that correlate, or too large an error, give nothing."""
    rows = lambda m: F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in m])
    mix = [(0.5, -0.5, 0, 0), (0, 0.0, 0.25, 0), (0, 1.5, 0, 0), (0, 0, 0, 1)]
    turn = [(0.8, -0.6, 0), (0.6, 0.8, 0), (0, 0, 1)]
    # Beams are value, 1, 5 and the error; the second row takes a quarter of the third.
    e = table(spark, d, "events")
    beams = F.array(F.col("value"), F.lit(1.0), F.lit(5.0), F.col("event_id") % 7 * 0.1)
    corr = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i < F.col("event_id") % 4, 10.0).otherwise(100.0))
    own = e.select("event_id", beams.alias("beams"), rows(mix).alias("matrix"), rows(turn).alias("rotation"), corr.alias("corr"))
    return grid.beam_to_earth(own, most_error=0.3 + 1e-12).select("event_id", r6("u").alias("u"), r6("v").alias("v"), r6("w").alias("w"))


# Schools: runs of samples, linked between pings, and the least label that reaches each (labels spread until none falls)

_SCHOOLS = SAMPLES + """,
v as (select *, sv > -55 as m, last_value(case when sv > -55 then sample_idx end ignore nulls) over (w rows unbounded preceding) as b, first_value(case when sv > -55 then sample_idx end ignore nulls) over (w rows between current row and unbounded following) as a from samples window w as (partition by channel, ping_idx order by sample_idx)),
o as (select channel, ping_idx, sample_idx, depth, sample_idx - row_number() over (partition by channel, ping_idx order by sample_idx) as g from v where m or coalesce(a - b - 1 <= 1, false)),
runs as (select channel, ping_idx, min(sample_idx) as lo, max(sample_idx) as hi, min(depth) as d_lo, max(depth) as d_hi, channel || '/' || lpad(ping_idx::varchar, 12, '0') || '/' || lpad(min(sample_idx)::varchar, 9, '0') as id from o group by channel, ping_idx, g),
pairs as (select x.id as a, y.id as b from runs x join runs y on x.channel = y.channel and y.ping_idx = x.ping_idx + 1 and x.lo <= y.hi and y.lo <= x.hi),
edges as (select a, b from pairs union all select b, a from pairs),
cc(id, label) using key (id) as (select id, id from runs union (select e.b, min(cc.label) from cc join edges e on e.a = cc.id join recurring.cc as r on r.id = e.b where cc.label < r.label group by e.b)),
box as (select runs.channel, label, min(ping_idx) as p_lo, max(ping_idx) as p_hi, min(lo) as s_lo, max(hi) as s_hi, min(d_lo) as d_lo, max(d_hi) as d_hi, sum(hi - lo + 1)::bigint as n_cells from runs join cc using (id) group by all),
schools as (select * from box where s_hi - s_lo + 1 >= 2 and p_hi - p_lo + 1 >= 2)"""
SQL["clu01_schools_weill"] = f"with recursive {_SCHOOLS} select * from schools"
SQL["agg21_school_statistics"] = f"""with recursive {_SCHOOLS}, s as (select channel, count(*) as n, sum(n_cells) as cells from schools group by channel), al as (select channel, count(*) as valid from samples where sv > -900 group by channel)
select al.channel, coalesce(n, 0) as n_schools, round(coalesce(cells, 0) / valid, 6) as share from al left join s using (channel)"""

SQL["clu03_methods"] = f"""select channel, ping_idx, 'gradient' as method, seabed from (with {BED}, {_median('bed')}, g as (select *, m - lag(m) over ({ALONG}) as dv from f)
 select channel, ping_idx, min(sample_idx) as seabed from g where depth between 100 and 400 and dv > 20 group by all)
union all select channel, ping_idx, 'maximum', seabed from ({SQL['win12_seabed_maximum']})"""

SQL["agg24_depth_weighted"] = f"""with p as (select o_custkey as k, (o_orderkey % 1000)::double as depth, avg((o_orderkey % 30)::double) as t from orders group by all),
g as (select k, unnest(range(100)) * (500.0::double / 99) as z from (select distinct k from p)),
a as (select g.k, g.z, p.depth as d0, p.t as t0 from g asof left join p on g.k = p.k and g.z >= p.depth), b as (select a.*, q.depth as d1, q.t as t1 from a asof left join p q on a.k = q.k and a.z <= q.depth),
e as (select k, z, case when d1 > d0 then t0 + (t1 - t0) * (z - d0) / (d1 - d0) else coalesce(t0, t1) end as t, 35::double as s, 8.1::double as ph, 38::double as khz from b),
c as (select *, {_MACKENZIE} as c, {_TERMS} from e) select k, round(1 / avg(1 / c), 6) as sound_speed, round(avg({_FG}), 9) as absorption from c group by k"""

SQL["clu02_schools_three_stage"] = f"""with recursive {SAMPLES}, sp as (select channel, max(ping_idx) as p1, max(sample_idx) as s1, (max(depth) - min(depth)) / greatest(max(sample_idx) - min(sample_idx), 1) as step from samples group by channel),
o as (select channel, ping_idx, sample_idx, depth, sample_idx - row_number() over ({ALONG}) as g from samples where sv > -60),
runs as (select channel, ping_idx, min(sample_idx) as lo, max(sample_idx) as hi, min(depth) as d_lo, max(depth) as d_hi, channel || '/' || lpad(ping_idx::varchar, 12, '0') || '/' || lpad(min(sample_idx)::varchar, 9, '0') as id from o group by channel, ping_idx, g),
pairs as (select x.id as a, y.id as b from runs x join runs y on x.channel = y.channel and y.ping_idx = x.ping_idx + 1 and x.lo <= y.hi + 1 and y.lo <= x.hi + 1), edges as (select a, b from pairs union all select b, a from pairs),
cc(id, label) using key (id) as (select id, id from runs union (select e.b, min(cc.label) from cc join edges e on e.a = cc.id join recurring.cc as r on r.id = e.b where cc.label < r.label group by e.b)),
box as (select runs.channel, label as id, min(ping_idx) as p_lo, max(ping_idx) as p_hi, min(lo) as s_lo, max(hi) as s_hi, min(d_lo) as d_lo, max(d_hi) as d_hi from runs join cc using (id) group by all),
cand as (select box.*, step from box join sp using (channel) where d_hi - d_lo + case when s_hi < s1 then step else 0 end >= 3 and p_hi - p_lo + (p_hi < p1)::int >= 10),
own as (select runs.* exclude id, cc.label as id from runs join cc using (id) where cc.label in (select id from cand)),
meet as (select distinct c.id as a, o.id as b from cand c join own o on c.channel = o.channel and c.id <> o.id and o.ping_idx between c.p_lo - 16 and c.p_hi + 16 and o.d_lo <= c.d_hi + 4 + c.step / 2 and o.d_hi >= c.d_lo - 4 - c.step / 2),
links as (select a, b from meet union select b, a from meet),
far(id, label) using key (id) as (select id, id from cand union (select e.b, min(far.label) from far join links e on e.a = far.id join recurring.far as r on r.id = e.b where far.label < r.label group by e.b)),
whole as (select own.channel, far.label, min(ping_idx) as p_lo, max(ping_idx) as p_hi, min(lo) as s_lo, max(hi) as s_hi, min(d_lo) as d_lo, max(d_hi) as d_hi, sum(hi - lo + 1)::bigint as n_cells from own join far using (id) group by all)
select whole.* from whole join sp using (channel) where d_hi - d_lo + case when s_hi < s1 then step else 0 end >= 3 and p_hi - p_lo + (p_hi < p1)::int >= 15"""


def _double_hex(x: str) -> str:
    """The eight bytes of a double, least first, as hex: sign, exponent and fraction put together and turned round."""
    power = f"floor(log2(abs({x})))"
    power = f"({power} + case when abs({x}) >= pow(2, {power} + 1) then 1 when abs({x}) < pow(2, {power}) then -1 else 0 end)"
    bits = f"(({x} < 0)::int::hugeint * 9223372036854775808 + ({power}::hugeint + 1023) * 4503599627370496 + ((abs({x}) / pow(2, {power}) - 1) * 4503599627370496)::hugeint)"
    digits = f"lpad(to_hex({bits}::ubigint), 16, '0')"
    return f"case when {x} = 0 then repeat('0', 16) else " + " || ".join(f"substr({digits}, {k}, 2)" for k in range(15, 0, -2)) + " end"


SQL["prj09_points"] = f"with {TRACK} select event_id, '0101000000' || {_double_hex('lon')} || {_double_hex('lat')} as wkb from track"
