"""Sea-water environment beside pings: profiles, calibration, pulse modes, detection rules."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import acoustics
from .bucketed import nearest_known, with_bucket
from .surface import linear_surface


def row_environment(df: DataFrame, channels: DataFrame, depth: float = 0.6, ph: float = 8.1, t: str = "temperature", s: str = "salinity") -> DataFrame:
    """Sound speed and absorption for each environment row and channel (``channel``, ``khz``; a handful of rows)."""
    own = df.join(F.broadcast(channels))
    c = acoustics.speed_mackenzie(F.col(t), F.col(s), F.lit(depth))
    own = own.withColumn("sound_speed", c)
    return own.withColumn("absorption", acoustics.absorption_francois_garrison(F.col("khz"), F.col(t), F.col(s), F.lit(depth), F.lit(ph), F.col("sound_speed")))


def constant_environment(df: DataFrame, temperature: float, salinity: float, pressure_dbar: float) -> DataFrame:
    own = df.withColumns({"temperature": F.lit(temperature), "salinity": F.lit(salinity), "depth_m": F.lit(pressure_dbar)})
    return own.withColumn("sound_speed", acoustics.speed_chen_millero(F.col("temperature"), F.col("salinity"), F.lit(pressure_dbar / 10)))


def blended_profile(surface: DataFrame, model: DataFrame, keys: Sequence[str], blend_depth: float = 5) -> DataFrame:
    """The in-situ row on top, model rows from ``blend_depth`` down; columns ``depth, t, s`` beside the keys."""
    cols = [*keys, "depth", "t", "s"]
    return surface.select(*cols, F.lit("in_situ").alias("source")).unionByName(model.where(F.col("depth") >= blend_depth).select(*cols, F.lit("model").alias("source")))


def nearest_depth(profile: DataFrame, keys: Sequence[str], target: Column) -> DataFrame:
    """The profile row of each key whose depth is closest to ``target`` (the shallower of two), with its sound speed."""
    best = F.min_by(F.struct("t", "s", "depth"), F.struct(F.abs(F.col("depth") - target), F.col("depth"), F.col("t"), F.col("s")))
    out = profile.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")
    return out.withColumn("sound_speed", acoustics.speed_mackenzie(F.col("t"), F.col("s"), F.col("depth")))


def depth_weighted(profile: DataFrame, keys: Sequence[str], target_depth: float, khz: float, ph: float = 8.1, points: int = 100) -> DataFrame:
    """Harmonic mean sound speed and mean absorption over ``points`` even depths down to ``target_depth``; ends of the profile are held."""
    fix = F.sort_array(F.collect_list(F.struct("depth", "t", "s")))
    own = profile.groupBy(*keys).agg(fix.alias("p")).withColumn("z", F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: i * (target_depth / (points - 1)))))
    above = F.element_at(F.filter("p", lambda x: x["depth"] <= F.col("z")), -1)
    below = F.get(F.filter("p", lambda x: x["depth"] >= F.col("z")), F.lit(0))
    own = own.select(*keys, "z", F.when(F.size(F.filter("p", lambda x: x["depth"] <= F.col("z"))) > 0, above).alias("a"), below.alias("b"))
    share = (F.col("z") - F.col("a.depth")) / (F.col("b.depth") - F.col("a.depth"))

    def at(c: str) -> Column:
        line = F.when(F.col("b.depth") > F.col("a.depth"), F.col(f"a.{c}") + (F.col(f"b.{c}") - F.col(f"a.{c}")) * share)
        return F.coalesce(line, F.col(f"a.{c}"), F.col(f"b.{c}"))

    own = own.select(*keys, "z", at("t").alias("t"), at("s").alias("s"))
    c = acoustics.speed_mackenzie(F.col("t"), F.col("s"), F.col("z"))
    own = own.withColumn("c", c).withColumn("alpha", acoustics.absorption_francois_garrison(F.lit(khz), F.col("t"), F.col("s"), F.col("z"), F.lit(ph), F.col("c")))
    return own.groupBy(*keys).agg((1 / F.avg(1 / F.col("c"))).alias("sound_speed"), F.avg("alpha").alias("absorption"))


def calibrated(channels: DataFrame, calibration: DataFrame, on: Sequence[str] = ("khz", "pulse")) -> DataFrame:
    """Calibration values by frequency and pulse mode; 200 kHz is always short. An unmatched channel raises when it is read."""
    own = channels.withColumn("pulse", F.when(F.col("khz") == 200, "short").otherwise(F.col("pulse")))
    out = own.join(calibration.withColumn("_hit", F.lit(True)), list(on), "left")
    fail = F.raise_error(F.concat(F.lit("no calibration for "), F.concat_ws("/", *[F.col(c).cast("string") for c in on])))
    return out.withColumn("gain", F.when(F.col("_hit"), F.col("gain")).otherwise(fail.cast("double"))).drop("_hit")


def pulse_category(files: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """``short`` for files with 38 and 200 kHz, ``long`` for 38 alone, else ``other``."""
    out = files.groupBy(*keys).agg(F.sort_array(F.collect_set(F.col("hz").cast("long"))).alias("hz"))
    kind = F.when(F.col("hz") == F.array(F.lit(38000), F.lit(200000)).cast("array<bigint>"), "short").when(F.col("hz") == F.array(F.lit(38000)).cast("array<bigint>"), "long").otherwise("other")
    return out.withColumn("category", kind)


def pulse_mode(pings: DataFrame, keys: Sequence[str] = ("file", "channel"), tolerance: float = 5e-6) -> DataFrame:
    """``short`` at 1.024 ms, ``long`` at 2.048 ms or beyond 1.5 ms; channels of mixed durations raise when they are read."""
    out = pings.groupBy(*keys).agg(F.min("seconds").alias("lo"), F.max("seconds").alias("hi"))
    mode = F.when(F.abs(F.col("lo") - 1.024e-3) <= tolerance, "short").when((F.abs(F.col("lo") - 2.048e-3) <= tolerance) | (F.col("lo") > 1.5e-3), "long").otherwise("other")
    return out.select(*keys, F.when(F.col("hi") - F.col("lo") > tolerance, F.raise_error(F.lit("mixed pulse durations")).cast("string")).otherwise(mode).alias("mode"))


def attributed_modes(pings: DataFrame, known: DataFrame, order: str = "t", by: Sequence[str] = ("platform",)) -> DataFrame:
    """Each ping's mode from ``known``; others take the next known ping's, else the last one's."""
    own = with_bucket(pings.join(known, [*by, order], "left"), order)
    own = nearest_known(own, by, [order], F.col("mode"), "_ahead", forward=True)
    own = nearest_known(own, by, [order], F.col("mode"), "_back")
    return own.withColumn("mode", F.coalesce("mode", "_ahead", "_back")).drop("_ahead", "_back", "_b")


def platform_class(df: DataFrame, ranges: DataFrame, number: str = "platform") -> DataFrame:
    """Class by numeric id range (``lo``, ``hi``, ``class``; a small table)."""
    return df.join(ranges, F.col(number).between(F.col("lo"), F.col("hi")), "left").drop("lo", "hi")


def stage_parameters(samples: DataFrame, table: DataFrame, names: Sequence[str], on: Sequence[str] = ("khz", "pulse")) -> DataFrame:
    """Thresholds by frequency and pulse as columns, so that one plan serves every channel; channels without any are skipped."""
    wide = table.groupBy(*on).pivot("key", list(names)).agg(F.max("value"))
    return samples.join(F.broadcast(wide), list(on))


def nearest_grid(df: DataFrame, grid: DataFrame, lat0: float, lon0: float, step: float) -> DataFrame:
    """Depth at the nearest grid cell (integer indexes ``iy``, ``ix``): land is 0."""
    own = df.withColumns({"iy": F.round((F.col("lat") - lat0) / step).cast("long"), "ix": F.round((F.col("lon") - lon0) / step).cast("long")})
    return own.join(grid, ["iy", "ix"], "left").withColumn("bottom_depth", F.greatest(-F.col("elevation"), F.lit(0.0))).drop("iy", "ix", "elevation")


def near_points(cells: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """``near``: whether any point lies within ``radius`` degrees (planar) of a cell.

    Buckets are so small that all of one lie within the radius: cells in a bucket with a point are settled by that, and only the others are held
    against the points of the buckets around."""
    side = radius / math.sqrt(2)
    places = {"_y": F.floor(F.col("lat") / side), "_x": F.floor(F.col("lon") / side)}
    own, points = cells.withColumns(places), points.select("lat", "lon").distinct().withColumns(places)
    full = points.select("_y", "_x").distinct().withColumn("_full", F.lit(True))
    own = own.join(full, ["_y", "_x"], "left")
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3) if i or j])).alias("o")
    dealt = points.select(F.col("lat").alias("plat"), F.col("lon").alias("plon"), "_y", "_x", around).select("plat", "plon", (F.col("_y") + F.col("o.i")).alias("_y"), (F.col("_x") + F.col("o.j")).alias("_x"))
    within = F.sqrt(F.pow(F.col("lat") - F.col("plat"), 2) + F.pow(F.col("lon") - F.col("plon"), 2)) <= radius
    hits = own.where("_full is null").join(dealt, ["_y", "_x"]).where(within).select("cell_id").distinct()
    return own.drop("_y", "_x").join(hits.withColumn("_hit", F.lit(True)), "cell_id", "left").withColumn("near", F.coalesce("_full", "_hit", F.lit(False))).drop("_full", "_hit")


def grid_surface(points: DataFrame, value: str, step: float, radius: float, how: str = "inverse") -> DataFrame:
    """Values on a grid of ``step`` degrees within ``radius`` of points: inverse-distance means, the ``nearest`` point's, or ``linear`` in the points' triangles. Values not above 0 are left out."""
    own = points.where(F.col(value) > 0)
    if how == "linear":
        return linear_surface(own, value, step, radius)
    lo, hi = (lambda c: F.ceil((F.col(c) - radius) / step)), (lambda c: F.floor((F.col(c) + radius) / step))
    cell = own.select(value, "lat", "lon", F.explode(F.sequence(lo("lat").cast("long"), hi("lat").cast("long"))).alias("iy"), "event_id")
    cell = cell.withColumn("ix", F.explode(F.sequence(lo("lon").cast("long"), hi("lon").cast("long"))))
    d = F.sqrt(F.pow(F.col("iy") * step - F.col("lat"), 2) + F.pow(F.col("ix") * step - F.col("lon"), 2))
    cell = cell.withColumn("d", d).where(F.col("d") <= radius)
    if how == "nearest":
        return cell.groupBy("iy", "ix").agg(F.min_by(value, F.struct("d", "event_id")).alias(value))
    w = 1 / F.greatest(F.col("d"), F.lit(1e-9))
    return cell.groupBy("iy", "ix").agg((F.sum(w * F.col(value)) / F.sum(w)).alias(value))


def best_provider(headers: DataFrame, rules: DataFrame) -> DataFrame:
    """The provider whose markers make up the largest share among each file's columns; ties by name, ``generic`` without any.

    ``headers``: file, columns (array). ``rules``: provider, markers (array); a small table."""
    share = F.size(F.array_intersect("columns", "markers")) / F.size("markers")
    scored = headers.join(rules).groupBy("file").agg(F.min_by(F.struct("provider", share.alias("score")), F.struct(-share, F.col("provider"))).alias("b"))
    return scored.select("file", F.when(F.col("b.score") > 0, F.col("b.provider")).otherwise("generic").alias("provider"), F.col("b.score").alias("score"))


def standard_names(columns: DataFrame, aliases: DataFrame, standard: DataFrame, least: float = 0.0) -> DataFrame:
    """``name`` to a standard name: by alias or exactly (1.0), else the shortest standard name that ends with it (0.85, names over four letters)."""
    low = F.lower(F.col("name"))
    own = columns.join(aliases, low == F.col("alias"), "left").withColumn("probe", F.coalesce("target", low))
    # A standard name is put out once as a whole and once for what follows each of its underscores, so that the match is a join of keys.
    parts = F.split("standard", "_")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "_"))
    keys = standard.select("standard", F.explode(F.array_distinct(ends)).alias("probe"))
    both = own.join(keys, "probe").where((F.col("standard") == F.col("probe")) | (F.length("probe") > 4))
    conf = F.when(F.col("standard") == F.col("probe"), 1.0).otherwise(0.85)
    best = both.groupBy("name").agg(F.min_by(F.struct(F.col("standard"), conf.alias("confidence")), F.struct(-conf, F.length("standard"), F.col("standard"))).alias("b"))
    return best.select("name", F.col("b.standard").alias("standard_name"), F.col("b.confidence").alias("confidence")).where(F.col("confidence") >= least)
