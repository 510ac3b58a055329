"""Gridded products from echo samples and currents: one row for each cell, never a dense cube."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.acoustics import to_db, to_linear

NMI_M = 1852.0


def mvbs(samples: DataFrame, range_m: float, ping_us: int, keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Mean volume backscatter: linear mean over left-closed bins of depth and time, back in dB; labels are left edges."""
    cell = samples.where("sv is not null").select(*keys, (F.floor(F.col("t") / ping_us) * ping_us).alias("t_bin"), (F.floor(F.col("depth") / range_m) * range_m).alias("depth_bin"), to_linear(F.col("sv")).alias("v"))
    return cell.groupBy(*keys, "t_bin", "depth_bin").agg(to_db(F.avg("v")).alias("sv"), F.count("*").alias("n"))


def nasc(samples: DataFrame, pings: DataFrame, depth_m: float = 10.0, distance_nmi: float = 0.5, ping: Sequence[str] = ("channel", "ping_idx")) -> DataFrame:
    """Area backscatter by distance and depth bin: mean linear Sv x bin height x 4 pi x 1852 squared. ``pings`` has ``distance_nmi``."""
    at = pings.select(*ping, F.floor(F.col("distance_nmi") / distance_nmi).alias("distance_bin"))
    cell = samples.where("sv is not null").select(*ping, F.floor(F.col("depth") / depth_m).alias("depth_bin"), to_linear(F.col("sv")).alias("v"))
    # The sum over a ping's cell is made before the join, which then moves a row for each ping and depth bin.
    cell = cell.groupBy(*ping, "depth_bin").agg(F.sum("v").alias("v"), F.count("*").alias("n")).join(at, list(ping))
    scale = depth_m * 4 * math.pi * NMI_M**2
    return cell.groupBy("channel", "distance_bin", "depth_bin").agg((F.sum("v") / F.sum("n") * scale).alias("nasc"), F.sum("n").alias("n"))


def depth_frequency_merge(cells: DataFrame, keys: Sequence[str], least: float = 0.1) -> DataFrame:
    """Shallow (200 kHz, 10 to 150 m) plus deep (38 kHz, 150 to 500 m) density for each key, with both totals; combined below ``least`` goes."""
    d, high, low = F.col("depth"), F.col("khz") == 200, F.col("khz") == 38
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("nasc"))), F.lit(0.0))
    out = cells.groupBy(*keys).agg(part(high & (d >= 10) & (d < 150)).alias("shallow"), part(low & (d >= 150) & (d < 500)).alias("deep"), part(low).alias("nasc_38"), part(high).alias("nasc_200"))
    return out.withColumn("combined", F.col("shallow") + F.col("deep")).where(F.col("combined") >= least)


def drop_sparse(points: DataFrame, least: int = 3) -> DataFrame:
    """Points in 1-degree cells (half-even rounding) with ``least`` points or more."""
    cell = [F.bround("lat").alias("_la"), F.bround("lon").alias("_lo")]
    full = points.groupBy(*cell).count().where(F.col("count") >= least).select("_la", "_lo")
    return points.withColumns({"_la": cell[0], "_lo": cell[1]}).join(full, ["_la", "_lo"], "left_semi").drop("_la", "_lo")


def ranked_value(rows: DataFrame, value: str, rank: int, parts: int = 1024) -> float:
    """The value of ``rank`` (from 0) among the non-NULL ones, exactly: counts of ever narrower ranges find it, and at most ``parts`` counts reach the driver in a round."""
    lo, hi = rows.agg(F.min(value), F.max(value)).first()
    below = 0
    while lo < hi:
        part = F.least(F.floor((F.col(value) - lo) / (hi - lo) * parts), F.lit(parts - 1))
        inner = rows.where(F.col(value).between(lo, hi)).groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
        for row in sorted(inner.collect()):
            if below + row["n"] > rank:
                lo, hi = row["lo"], row["hi"]
                break
            below += row["n"]
    return lo


def cap_at_quantile(points: DataFrame, value: str, share: float = 0.99) -> DataFrame:
    """Values above the one of rank floor(n x share), counted from 0, become that value rounded to one decimal."""
    n = points.where(F.col(value).isNotNull()).count()
    if not n:
        return points
    cap = ranked_value(points, value, min(int(n * share), n - 1))
    return points.withColumn(value, F.when(F.col(value) > cap, F.lit(round(cap, 1))).otherwise(F.col(value)))


def null_fraction(samples: DataFrame, over: str = "min", keys: Sequence[str] = ("ping_idx",)) -> DataFrame:
    """Share of NULL samples of each ping and channel, reduced over channels by min or max."""
    per = samples.groupBy(*keys, "channel").agg(F.avg(F.col("sv").isNull().cast("double")).alias("f"))
    return per.groupBy(*keys).agg((F.min if over == "min" else F.max)("f").alias("null_fraction"))


def drop_null_pings(samples: DataFrame, below: float, over: str = "min", keys: Sequence[str] = ("ping_idx",)) -> DataFrame:
    return samples.join(null_fraction(samples, over, keys).where(F.col("null_fraction") < below), list(keys), "left_semi")


def crosstalk_pings(samples: DataFrame, low: float = 800, high: float = 1200, over_db: float = 6, least: int = 101, day: Sequence[str] = ("day",)) -> DataFrame:
    """Pings whose deep-band level (min over channels) exceeds the day's median by more than ``over_db``; only days with ``least`` pings."""
    band = samples.where(F.col("depth").between(low, high) & F.col("sv").isNotNull())
    per = band.groupBy(*day, "ping_idx", "channel").agg(to_db(F.avg(to_linear(F.col("sv")))).alias("v")).groupBy(*day, "ping_idx").agg(F.min("v").alias("level"))
    mid = per.groupBy(*day).agg(F.percentile("level", F.lit(0.5)).alias("median"), F.count("level").alias("n"))
    return per.join(mid, list(day)).select(*day, "ping_idx", "level", ((F.col("n") >= least) & (F.col("level") > F.col("median") + over_db)).alias("crosstalk"))


def downsample(df: DataFrame, index: str, k: int, value: str, keys: Sequence[str] = (), how: str = "mean", log: bool = False) -> DataFrame:
    """Mean or sum over blocks of ``k`` cells, the ragged end kept; in the linear domain with ``log``."""
    v = to_linear(F.col(value)) if log else F.col(value)
    a = F.avg(v) if how == "mean" else F.sum(v)
    return df.groupBy(*keys, F.floor(F.col(index) / k).alias(index)).agg((to_db(a) if log else a).alias(value))


def ensemble(cells: DataFrame, seconds: float, keys: Sequence[str] = ("depth_cell",)) -> DataFrame:
    """Currents in fixed time bins from the first ping: means, circular mean heading, pings; time is the bin's centre."""
    width = int(seconds * 1e6)
    start = cells.agg(F.min("t").alias("_t0"))
    own = cells.join(F.broadcast(start)).withColumn("bin", F.floor((F.col("t") - F.col("_t0")) / width))
    turn = F.pmod(F.degrees(F.atan2(F.avg(F.sin(F.radians("heading"))), F.avg(F.cos(F.radians("heading"))))) + 360, F.lit(360.0))
    return own.groupBy("bin", *keys).agg(*[F.avg(c).alias(c) for c in ("u", "v", "w", "amplitude")], F.avg("heading").alias("heading"), turn.alias("heading_circular"), F.countDistinct("t").alias("n_pings"), (F.first("_t0") + F.max("bin") * width + width // 2).alias("t_mid"))


def density_summary(cells: DataFrame, surface: float = 10.0) -> DataFrame:
    """Min, max, mean, median, the depth of the greatest mean, and the ratio of the surface layer's mean to the rest's."""
    per = cells.groupBy("depth").agg(F.avg("nasc").alias("m"))
    peak = per.agg(F.max_by("depth", F.struct("m", -F.col("depth"))).alias("peak_depth"), F.sum("m").alias("integrated"))
    n = cells.where("nasc is not null").count()
    middle = sum(ranked_value(cells, "nasc", k) for k in ((n - 1) // 2, n // 2)) / 2 if n else None
    all_ = cells.agg(F.min("nasc").alias("min"), F.max("nasc").alias("max"), F.avg("nasc").alias("mean"), F.lit(middle).cast("double").alias("median"), (F.avg(F.when(F.col("depth") < surface, F.col("nasc"))) / F.avg(F.when(F.col("depth") >= surface, F.col("nasc")))).alias("surface_ratio"))
    return all_.join(F.broadcast(peak))


def frequency_difference(samples: DataFrame, low: str, high: str, limits: tuple[float, float] = (-12, -2), keys: Sequence[str] = ("ping_idx", "sample_idx")) -> DataFrame:
    """Sv of ``low`` minus ``high`` in the same cell, and whether it lies within ``limits``; one pass, no self join."""
    pick = lambda c: F.max(F.when(F.col("channel") == c, F.col("sv")))
    out = samples.where(F.col("channel").isin(low, high)).groupBy(*keys).agg((pick(low) - pick(high)).alias("difference"))
    return out.withColumn("mask", F.coalesce(F.col("difference").between(*limits), F.lit(False)))


def aligned(grids: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """Full outer alignment of grids on their keys, a column for each: one union and one aggregate."""
    rows = None
    for name, g in grids:
        part = g.select(*keys, F.lit(name).alias("_g"), F.col("sv"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(*keys).agg(*[F.max(F.when(F.col("_g") == n, F.col("sv"))).alias(n) for n, _ in grids])


def regrid(samples: DataFrame, step: float = 0.5, keys: Sequence[str] = ("channel", "ping_idx")) -> DataFrame:
    """Each ping linearly interpolated to multiples of ``step`` metres between its samples, never beyond them."""
    nxt = F.lead(F.struct("depth", "sv")).over(Window.partitionBy(*keys).orderBy("depth"))
    own = samples.where("sv is not null").select(*keys, "depth", "sv", nxt.alias("n"))
    first, last = F.ceil(F.col("depth") / step), F.when(F.col("n").isNull(), F.floor(F.col("depth") / step)).otherwise(F.ceil(F.col("n.depth") / step) - 1)
    own = own.where(first <= last).withColumn("k", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    at = F.col("k") * step
    line = F.col("sv") + (F.col("n.sv") - F.col("sv")) * (at - F.col("depth")) / (F.col("n.depth") - F.col("depth"))
    return own.select(*keys, at.alias("depth"), F.coalesce(line, F.col("sv")).alias("sv"))


def chained_offsets(pings: DataFrame, store: str = "store", order: str = "store_start", gap: float = 0.5) -> DataFrame:
    """Distances of stores laid end to end: each shifted by the stores before it and ``gap`` between. A row for each store is windowed."""
    per = pings.groupBy(store, order).agg(F.max("distance_nmi").alias("_len"))
    w = Window.orderBy(order, store).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(store, F.coalesce(F.sum(F.col("_len") + gap).over(w), F.lit(0.0)).alias("_off"))
    return pings.join(per, store).withColumn("distance_nmi", F.col("distance_nmi") + F.col("_off")).drop("_off")


def mean_by_cell(df: DataFrame, edges_lat: Sequence[float], edges_lon: Sequence[float], values: Sequence[str]) -> DataFrame:
    """Means by right-closed position bins; the first bin excludes its low edge and rows outside fall away."""
    from ..functions.geo import right_closed_bin

    own = df.withColumn("lat_i", right_closed_bin(F.col("lat"), edges_lat, False, False)).withColumn("lon_i", right_closed_bin(F.col("lon"), edges_lon, False, False))
    return own.where("lat_i is not null and lon_i is not null").groupBy("lat_i", "lon_i").agg(*[F.avg(v).alias(f"mean_{v}") for v in values], F.count("*").alias("n"))


def beam_to_earth(df: DataFrame, beams: str = "beams", matrix: str = "matrix", rotation: str = "rotation", corr: str = "corr", least_corr: float = 64, least_share: float = 0.5, most_error: float = 0.3) -> DataFrame:
    """u, v, w and error velocity from four beams by a 4x4 and a 3x3 product; NULL where too few beams correlate or the error is large."""

    def dot(row: Column, vec: Column) -> Column:
        return F.aggregate(F.zip_with(row, vec, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)

    xyze = F.transform(F.col(matrix), lambda row: dot(row, F.col(beams)))
    good = F.size(F.filter(F.col(corr), lambda c: c >= least_corr)) / F.size(corr) >= least_share
    own = df.withColumn("_x", xyze).withColumn("_e", F.transform(F.col(rotation), lambda row: dot(row, F.slice(F.col("_x"), 1, 3))))
    ok = good & (F.abs(F.col("_x")[3]) <= most_error)
    return own.withColumns({n: F.when(ok, F.col("_e")[i]) for i, n in enumerate("uvw")} | {"error": F.col("_x")[3]}).drop("_x", "_e")


def flattened(cells: DataFrame, keys: Sequence[str], index: str, value: str, name: str = "velocities") -> DataFrame:
    """One row for each key with the values of a cube's last axis in the order of ``index``; a cube's axis is short, so a row stays small."""
    return cells.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct(index, value))), lambda x: x[value]).alias(name))
