"""Vehicle tracks: segments, distances, arrows, thinning, outliers, day markers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import bearing, great_circle_nmi
from ..session import staged
from . import chains
from .bucketed import DAY_US, by_batches, in_blocks, nearest_known, numbered, running_sum, with_bucket

MINUTE_US = 60_000_000


def segments(df: DataFrame, gap_minutes: float = 60, by: Sequence[str] = ("platform",), time: str = "t", tie: Sequence[str] = (), bucket_us: int = DAY_US) -> DataFrame:
    """``segment``: 1, 2, ... along each track, a new one where the gap before a row exceeds ``gap_minutes``."""
    order = [time, *tie]
    own = with_bucket(df, time, bucket_us)
    own = nearest_known(own, by, order, F.col(time), "_prev", inclusive=False)
    split = (F.col("_prev").isNull() | (F.col(time) - F.col("_prev") > int(gap_minutes * MINUTE_US))).cast("long")
    return running_sum(own, by, order, split, "segment").drop("_prev", "_b")


def recording_breaks(df: DataFrame, gap_minutes: float, time: str = "t", tie: Sequence[str] = (), bucket_us: int = DAY_US) -> DataFrame:
    """``block`` numbers over all rows, whatever the platform; only day totals meet in one task."""
    return segments(df.withColumn("_all", F.lit(0)), gap_minutes, ("_all",), time, tie, bucket_us).withColumnRenamed("segment", "block").drop("_all")


def segment_summary(df: DataFrame, measures: Sequence[str], by: Sequence[str] = ("platform",), time: str = "t", tie: Sequence[str] = (), decimals: int = 3) -> DataFrame:
    """One row for each segment of two points or more: span, mean measures (rounded), coordinates in order."""
    path = F.sort_array(F.collect_list(F.struct(time, *tie, "lon", "lat")))
    out = df.groupBy(*by, "segment").agg(
        F.count("*").alias("n_points"), F.min(time).alias("t_start"), F.max(time).alias("t_end"),
        *[F.round(F.avg(m), decimals).alias(f"mean_{m}") for m in measures],
        F.transform(path, lambda p: F.array(p["lon"], p["lat"])).alias("coordinates"),
    )
    return out.where("n_points > 1")


def along_track(df: DataFrame, by: Sequence[str] = ("platform",), time: str = "t", tie: Sequence[str] = (), bucket_us: int = DAY_US) -> DataFrame:
    """``step_nmi`` from the row before (0 where either position is NULL) and ``distance_nmi``, their running sum."""
    order = [time, *tie]
    own = with_bucket(df, time, bucket_us)
    own = nearest_known(own, by, order, F.struct("lat", "lon"), "_p", inclusive=False)
    step = F.coalesce(great_circle_nmi(F.col("_p.lat"), F.col("_p.lon"), F.col("lat"), F.col("lon")), F.lit(0.0))
    return running_sum(own.withColumn("step_nmi", step), by, order, F.col("step_nmi"), "distance_nmi").drop("_p", "_b")


def speed_filter(df: DataFrame, most_knots: float = 100, by: Sequence[str] = ("platform",), time: str = "t", tie: Sequence[str] = ()) -> DataFrame:
    """Keep rows slower than ``most_knots`` by planar degrees times 60; a track's first row and steps of no time stay."""
    own = nearest_known(with_bucket(df, time), by, [time, *tie], F.struct("lat", "lon", time), "_p", inclusive=False)
    hours = (F.col(time) - F.col(f"_p.{time}")) / 3.6e9
    miles = 60 * F.sqrt(F.pow(F.col("lat") - F.col("_p.lat"), 2) + F.pow(F.col("lon") - F.col("_p.lon"), 2))
    knots = F.when(hours > 0, miles / hours)
    return own.withColumn("speed_knots", knots).where(F.col("speed_knots").isNull() | (F.col("speed_knots") < most_knots)).drop("_p", "_b")


def arrows(df: DataFrame, per_segment: int = 4, least_points: int = 5, by: Sequence[str] = ("platform", "segment"), time: str = "t", tie: Sequence[str] = ()) -> DataFrame:
    """Evenly spaced points of each segment with the course from the point before to the one after, one decimal."""
    order = [time, *tie]
    own = numbered(df, by, order, "_rn").join(df.groupBy(*by).agg(F.count("*").alias("_n")), list(by))
    own = with_bucket(own, time)
    own = nearest_known(own, by, order, F.struct("lat", "lon"), "_a", inclusive=False)
    own = nearest_known(own, by, order, F.struct("lat", "lon"), "_z", forward=True, inclusive=False)
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / (per_segment + 1)))
    pick = (F.col("_n") >= least_points) & (F.col("_rn") > 0) & (F.col("_rn") < F.col("_n") - 1) & (F.col("_rn") % step == 0) & (F.col("_rn") <= step * per_segment)
    course = F.round(bearing(F.col("_a.lat"), F.col("_a.lon"), F.col("_z.lat"), F.col("_z.lon")), 1)
    return own.where(pick).withColumn("bearing", course % 360).drop("_n", "_rn", "_a", "_z", "_b")


def day_markers(df: DataFrame, time: str = "t", tie: str = "event_id", day: str = "day") -> DataFrame:
    """First and last time and position of each platform and day."""
    at, place = F.struct("lon", "lat"), F.struct(time, tie)
    return df.groupBy("platform", day).agg(F.min(time).alias("t_first"), F.max(time).alias("t_last"), F.min_by(at, place).alias("first"), F.max_by(at, place).alias("last"))


def every_nth(df: DataFrame, n: int, by: Sequence[str] = ("platform",), order: Sequence[str] = ("t",)) -> DataFrame:
    """Rows 0, n, 2n, ... of each track in time order."""
    return numbered(df, by, order, "_rn").where(F.col("_rn") % n == 0).drop("_rn")


def endpoints(df: DataFrame, by: Sequence[str] = ("platform",), time: str = "t", tie: str = "event_id") -> DataFrame:
    """First and last valid coordinate of each track."""
    valid = df.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    return valid.groupBy(*by).agg(F.min_by(F.struct("lat", "lon"), F.struct(time, tie)).alias("start"), F.max_by(F.struct("lat", "lon"), F.struct(time, tie)).alias("end"))


def position_outliers(df: DataFrame, most_degrees: float = 0.5, by: Sequence[str] = ("platform",), order: Sequence[str] = ("t",), each_side: int = 4) -> DataFrame:
    """``outlier``: farther than ``most_degrees`` in either axis from the median of up to eight neighbours."""
    w = Window.partitionBy(*by, "_block").orderBy("_rn")

    def median(c: str) -> Column:
        around = F.concat(F.collect_list(c).over(w.rowsBetween(-each_side, -1)), F.collect_list(c).over(w.rowsBetween(1, each_side)))
        s, n = F.array_sort(around), F.size(around)
        middle = (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2
        return F.when(n > 0, middle)

    own = in_blocks(numbered(df, by, order, "_rn"), "_rn", each_side)
    own = own.withColumn("_mlat", median("lat")).withColumn("_mlon", median("lon")).where("_mine")
    off = F.greatest(F.abs(F.col("lat") - F.col("_mlat")), F.abs(F.col("lon") - F.col("_mlon"))) > most_degrees
    return own.withColumn("outlier", F.coalesce(off, F.lit(False))).drop("_mlat", "_mlon", "_rn", "_block", "_mine")


def capped_points(df: DataFrame, most: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """At most ``most`` evenly spaced rows of each group, its first and last among them."""
    own = numbered(df, by, order, "_rn").join(df.groupBy(*by).agg(F.count("*").alias("_n")), list(by))
    # Row r is floor(i (n - 1) / (m - 1)) for some i: the next i does not start before r + 1.
    i = F.ceil(F.col("_rn") * (most - 1) / (F.col("_n") - 1))
    hit = (F.col("_n") <= most) | (F.floor(i * (F.col("_n") - 1) / (most - 1)) == F.col("_rn"))
    return own.where(hit).drop("_rn", "_n")


def decimate(df: DataFrame, seconds: float, by: Sequence[str] = ("platform",), time: str = "t", tie: Sequence[str] = (), bucket_us: int = DAY_US) -> DataFrame:
    """The middle row of each chained bucket: a bucket starts at the first row that is ``seconds`` or more after the start of the one before it.

    Each row points to the first row an interval later; the buckets' starts are the chain of pointers from a track's first row, and a bucket's rows are those
    from its start to the next. Rows stay as they are where ``seconds`` is not above 0."""
    if seconds <= 0:
        return df
    own = numbered(df, by, [time, *tie], "_i", bucket_us)
    rows = staged(own.select(*by, time, "_i"), "places")
    pointers = staged(chains.first_at_least_later(rows, int(seconds * 1e6), by, time, "_i", bucket_us), "next")
    starts = chains.chain(pointers, rows.where("_i = 0"), by, "_i")
    ends = rows.groupBy(*by).agg((F.max("_i") + 1).alias("_n"))
    spans = starts.join(pointers, [*by, "_i"], "left").join(ends, list(by))
    middle = spans.select(*by, (F.col("_i") + F.floor((F.coalesce("next", "_n") - F.col("_i")) / 2)).alias("_i"))
    return own.join(middle, [*by, "_i"], "left_semi").drop("_i")


#: Rows of an open chord that a task finishes by itself, and rows that are searched together for the next one far enough away.
CHORD_ROWS, SPACED_ROWS = 20_000, 4096


def _far(chord_lon: Column | np.ndarray, chord_lat: Column | np.ndarray, lon: Column | np.ndarray, lat: Column | np.ndarray, sqrt) -> tuple:
    """The chord's length, a point's distance from the line through it, and from its start; points count from the start."""
    length = sqrt(chord_lon * chord_lon + chord_lat * chord_lat)
    cross = chord_lon * lat - chord_lat * lon
    return length, cross, sqrt(lon * lon + lat * lat)


def _split_here(rows: pd.DataFrame, first: np.ndarray, epsilon: float) -> np.ndarray:
    """Which rows of open chords' insides (in order, with the chord's ends; ``first`` says where each begins) are kept by splitting on to the end. All chords are split at once, level by level."""
    lon, lat = (rows[c].to_numpy(float) for c in ("lon", "lat"))
    ends = [rows[c].to_numpy(float)[first] for c in ("_alon", "_alat", "_zlon", "_zlat")]
    kept, low, high = np.zeros(len(rows), bool), first, np.append(first[1:], len(rows))
    while len(low):
        alon, alat, zlon, zlat = ends
        size = high - low
        begin = np.cumsum(size) - size
        of = np.repeat(np.arange(len(low)), size)
        row = np.arange(len(of)) + (low - begin)[of]
        with np.errstate(all="ignore"):
            length, cross, near = _far((zlon - alon)[of], (zlat - alat)[of], lon[row] - alon[of], lat[row] - alat[of], np.sqrt)
            far = np.where(length != 0, np.abs(cross) / length, near)
            most = np.maximum.reduceat(far, begin)
            split = np.flatnonzero(most > epsilon)
        hit = np.flatnonzero(far == most[of])
        at = row[hit[np.searchsorted(of[hit], split)]]  # the first of rows equally far
        kept[at] = True
        left = [alon[split], alat[split], lon[at], lat[at]]
        right = [lon[at], lat[at], zlon[split], zlat[split]]
        low, high = np.concatenate((low[split], at + 1)), np.concatenate((at, high[split]))
        go = np.flatnonzero(high > low)
        low, high, ends = low[go], high[go], [np.concatenate(x)[go] for x in zip(left, right, strict=True)]
    return kept


def shape_points(df: DataFrame, epsilon: float, by: Sequence[str], place: str, chord_rows: int = CHORD_ROWS) -> DataFrame:
    """``by``, ``place``, ``lon``, ``lat`` of the rows that recursive splitting at the point farthest from the chord keeps; ``place`` numbers each group's rows from 0.

    Rounds: an aggregate finds the farthest row of every open chord of more than ``chord_rows`` rows, and the rows left are a written table. Shorter chords
    are finished in one task each. Of rows equally far the first splits. Groups of one or two rows stay."""
    point = F.struct(F.col(place).alias("i"), "lon", "lat")
    ends = df.groupBy(*by).agg(F.min_by(point, place).alias("_a"), F.max_by(point, place).alias("_z"))
    kept = [df.join(ends.select(*by, F.explode(F.array("_a.i", "_z.i")).alias(place)).distinct(), [*by, place], "left_semi").select(*by, place, "lon", "lat")]
    flat = [F.col(f"{e}.{c}").alias(f"{e}{c}") for e in ("_a", "_z") for c in ("i", "lon", "lat")]
    inner = df.select(*by, place, "lon", "lat").join(ends, list(by)).where(F.col(place).between(F.col("_a.i") + 1, F.col("_z.i") - 1)).select(*by, place, "lon", "lat", *flat)
    rows, key = staged(inner, "chords"), [*by, "_ai"]
    length, cross, near = _far(F.col("_zlon") - F.col("_alon"), F.col("_zlat") - F.col("_alat"), F.col("lon") - F.col("_alon"), F.col("lat") - F.col("_alat"), F.sqrt)
    far = F.when(length > 0, F.abs(cross) / length).otherwise(near)
    small = F.col("_zi") - F.col("_ai") - 1 <= chord_rows

    def finish(own: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        return own[_split_here(own, first, epsilon)][[*by, place, "lon", "lat"]]

    schema = ", ".join(f"`{n}` {t}" for n, t in kept[0].dtypes)
    while not rows.isEmpty():
        kept.append(staged(by_batches(rows.where(small), key, [place], finish, schema), "kept"))
        rows = rows.where(~small)
        split = rows.withColumn("_d", far).groupBy(*key).agg(F.max("_d").alias("_d"), F.min_by(point, F.struct(-F.col("_d"), place)).alias("_m")).where(F.col("_d") > epsilon)
        split = staged(split.select(*key, "_m"), "split")
        kept.append(split.select(*by, F.col("_m.i").alias(place), "_m.lon", "_m.lat"))
        left = F.col(place) < F.col("_m.i")
        parts = [F.when(left, F.col(f"_a{c}")).otherwise(F.col(f"_m.{c}")).alias(f"_a{c}") for c in ("i", "lon", "lat")] + [F.when(left, F.col(f"_m.{c}")).otherwise(F.col(f"_z{c}")).alias(f"_z{c}") for c in ("i", "lon", "lat")]
        rows = staged(rows.join(split, key).where(F.col(place) != F.col("_m.i")).select(*by, place, "lon", "lat", *parts), "chords")
    return reduce(lambda a, b: a.unionByName(b), kept)


def _first_away(lat: np.ndarray, lon: np.ndarray, lats: np.ndarray, lons: np.ndarray, begin: np.ndarray, end: np.ndarray, spacing_nmi: float) -> np.ndarray:
    """For each point the first of ``lats, lons``, from its ``begin`` on and before its ``end``, that is ``spacing_nmi`` or more away; -1 without any."""
    found, at = np.full(len(lat), -1), begin.copy()
    live = np.flatnonzero(at < end)
    while len(live):
        j = at[live]
        h = np.sin((lats[j] - lat[live]) / 2) ** 2 + np.cos(lats[j]) * np.cos(lat[live]) * np.sin((lons[j] - lon[live]) / 2) ** 2
        away = 2 * 3440.065 * np.arcsin(np.minimum(1.0, np.sqrt(h))) >= spacing_nmi
        found[live[away]] = j[away]
        live = live[~away]
        at[live] += 1
        live = live[at[live] < end[live]]
    return found


#: Marks in ``next``: none found yet, and a kept row of a group that a task finished by itself.
_PENDING, _KEPT = -1, -2


def spaced(df: DataFrame, spacing_nmi: float, by: Sequence[str], place: str, block: int = SPACED_ROWS) -> DataFrame:
    """``by`` and ``place`` of the rows kept going along each group: its first, then always the next one ``spacing_nmi`` or more from the last kept.

    Each row points to the first row behind it that is so far away; it is looked for in the row's own block of ``block`` rows, then in the blocks behind it, by the
    rows that have not found theirs: in one block, then in two, in four and so on, so rounds grow with the logarithm of a group's blocks. The rows kept are the chain of pointers from each group's first row. A group that does not fill its
    first block is followed to its end where it is searched. ``place`` numbers the rows from 0."""
    rows = staged(df.select(*by, F.col(place).alias("_i"), F.radians("lat").alias("_lat"), F.radians("lon").alias("_lon"), F.floor(F.col(place) / block).alias("_b")), "points")
    kind = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kind[c]}" for c in (*by, "_i")) + ", next long, _lat double, _lon double, _b long"

    def search(own: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        """Of many groups' blocks at once; rows that ask in a block that their group does not have are left out."""
        there, size = own["_there"].to_numpy(bool), np.diff(np.append(first, len(own)))
        upto = np.cumsum(there)  # rows to be searched up to each row, so the number of the first one behind it
        end = np.repeat(upto[first + size - 1], size)
        none = np.repeat(upto[first + size - 1] == upto[first] - there[first], size)
        asks = np.flatnonzero(own["_asks"].to_numpy(bool) & ~none)
        lat, lon, places = own["_lat"].to_numpy(), own["_lon"].to_numpy(), np.flatnonzero(there)
        found = _first_away(lat[asks], lon[asks], lat[there], lon[there], upto[asks], end[asks], spacing_nmi)
        ahead = np.full(len(own), -1)
        ahead[asks[found >= 0]] = places[found[found >= 0]]  # rows of ``own``
        pointer = np.where(ahead >= 0, own["_i"].to_numpy()[ahead], _PENDING)
        whole = first[(own["_b"].to_numpy()[first] == 0) & (size < block) & there[first]]
        open_ = np.ones(len(own), bool)
        open_[np.flatnonzero(np.repeat(np.isin(first, whole), size))] = False
        last = whole
        while len(last):
            pointer[last] = _KEPT
            last = ahead[last]
            last = last[last >= 0]
        out = own.assign(next=pointer, _b=own["_b"] + 1)[[*by, "_i", "next", "_lat", "_lon", "_b"]]
        asking = np.zeros(len(own), bool)
        asking[asks] = True
        return out[asking & (open_ | (pointer == _KEPT))]

    keys, done, blocks = [*by, "_b"], [], 1
    both = rows.withColumns({"_asks": F.lit(True), "_there": F.lit(True)})
    while True:
        found = by_batches(both, keys, ["_i"], search, schema)
        if blocks > 1:  # a row has asked in several blocks
            nearest = F.coalesce(F.min(F.when(F.col("next") >= 0, F.col("next"))), F.lit(_PENDING).cast("long"))
            found = found.groupBy(*by, "_i").agg(nearest.alias("next"), F.first("_lat").alias("_lat"), F.first("_lon").alias("_lon"), F.max("_b").alias("_b"))
        done.append(staged(found, "away"))
        pending = done[-1].where(F.col("next") == _PENDING).drop("next")
        if pending.isEmpty():
            break
        pending = pending.withColumn("_b", F.explode(F.sequence(F.col("_b"), F.col("_b") + blocks - 1)))
        there = rows.join(pending.select(*keys).distinct(), keys, "left_semi").withColumns({"_asks": F.lit(False), "_there": F.lit(True)})
        both = pending.withColumns({"_asks": F.lit(True), "_there": F.lit(False)}).unionByName(there)
        blocks *= 2
    kept = done[0].where(F.col("next") == _KEPT).select(*by, "_i")
    starts = done[0].where((F.col("_i") == 0) & (F.col("next") != _KEPT))
    if not starts.isEmpty():
        pointers = reduce(lambda a, b: a.unionByName(b), [found.where("next >= 0").select(*by, "_i", "next") for found in done])
        kept = kept.unionByName(chains.chain(pointers, starts, by, "_i"))
    return kept.withColumnRenamed("_i", place)


def simplify(df: DataFrame, epsilon: float = 1e-5, spacing_nmi: float = 0.01, by: Sequence[str] = ("platform", "day"), time: str = "t", row_id: str = "event_id", chord_rows: int = CHORD_ROWS, block: int = SPACED_ROWS) -> DataFrame:
    """Rows kept by recursive splitting at the point farthest from the chord, then at least ``spacing_nmi`` apart. A track-day is the group; it may be of any size."""
    own = numbered(df.select(*by, time, row_id, "lon", "lat"), by, [time, row_id], "_at")
    own = staged(own, "fixes")
    shape = staged(shape_points(own.select(*by, "_at", "lon", "lat"), epsilon, by, "_at", chord_rows), "shape")
    order = numbered(shape, by, ["_at"], "_place", 1 << 16)
    order = staged(order, "shape")
    kept = spaced(order, spacing_nmi, by, "_place", block).join(order, [*by, "_place"])
    return own.join(kept.select(*by, "_at"), [*by, "_at"], "left_semi").select(*by, row_id)


def back_matched(full: DataFrame, kept: DataFrame, keys: Sequence[str] = ("platform", "event_id")) -> DataFrame:
    """The rows of ``full`` that a simplifier kept, with all their columns, times among them."""
    return full.join(kept.select(*keys).distinct(), list(keys), "left_semi")


def in_time_order(df: DataFrame, by: Sequence[str] = ("platform",), order: Sequence[str] = ("t", "event_id")) -> DataFrame:
    """``place``: each row's number, from 0, in the time order of its track."""
    return numbered(df, by, order, "place")
