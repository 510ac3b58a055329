"""Navigation scans: positions under one of several names or as points, and file records that hold lists of positions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from .files import json_objects

# Names that latitude, longitude and time go by, the likelier first; upper and lower case make no difference.
LATITUDES = ("lat", "latitude", "lat_deg")
LONGITUDES = ("lon", "longitude", "lng", "lon_deg")
TIMES = ("time", "dt", "datetime", "timestamp", "date_time")
RECORD = "source_path string, file_name string"
POSITION = "lat double, lon double, dt string, knt double"


def _sniffed(columns: Sequence[str], names: Sequence[str]) -> str | None:
    low = {c.lower(): c for c in columns}
    return next((low[n] for n in names if n in low), None)


def _ordinate(wkb: pa.Array, at: int) -> pa.Array:
    """The double ``at`` so many bytes into each point, in either byte order; NULL for what is too short for a point."""
    own = wkb.cast(pa.large_binary())
    size = pc.fill_null(pc.binary_length(own), 0).to_numpy(zero_copy_only=False)
    good = size >= 21
    if not good.any():
        return pa.nulls(len(wkb), pa.float64())
    begin = np.frombuffer(own.buffers()[1], np.int64, len(own) + 1 + own.offset)[own.offset : -1][good]
    data = np.frombuffer(own.buffers()[2], np.uint8)
    out = np.full(len(wkb), np.nan)
    little, big = (np.ndarray((len(data) - 7,), kind, data, strides=(1,))[begin + at].astype(float) for kind in ("<f8", ">f8"))
    out[good] = np.where(data[begin] == 1, little, big)
    return pa.array(out, mask=~good)


def point_x(wkb: Column) -> Column:
    def x(column: pa.Array) -> pa.Array:
        return _ordinate(column, 5)

    return F.arrow_udf(x, "double")(wkb)


def point_y(wkb: Column) -> Column:
    def y(column: pa.Array) -> pa.Array:
        return _ordinate(column, 13)

    return F.arrow_udf(y, "double")(wkb)


def navigation(df: DataFrame) -> DataFrame:
    """``lat``, ``lon`` and ``dt`` (UTC) from whichever columns hold them, or from a ``geometry`` of points; rows without any of the three go, and of
    equal times one row stays, the southernmost. Without such columns there is no row."""
    lat, lon, time = (_sniffed(df.columns, names) for names in (LATITUDES, LONGITUDES, TIMES))
    geometry = (lat is None or lon is None) and "geometry" in df.columns
    if time is None or (not geometry and (lat is None or lon is None)):
        return df.sparkSession.createDataFrame([], "lat double, lon double, dt timestamp")
    y, x = (point_y(F.col("geometry")), point_x(F.col("geometry"))) if geometry else tuple(F.col(f"`{c}`").cast("string").try_cast("double") for c in (lat, lon))
    when = F.col(f"`{time}`")
    when = when.cast("string").try_cast("timestamp") if dict(df.dtypes)[time] == "string" else when.cast("timestamp")
    own = df.select(F.nanvl(y, F.lit(None)).alias("lat"), F.nanvl(x, F.lit(None)).alias("lon"), when.alias("dt")).dropna("any")
    return own.groupBy("dt").agg(F.min(F.struct("lat", "lon")).alias("p")).select("p.lat", "p.lon", "dt")


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """A row for each position of JSON files that hold an array of file records, with its record's ``file_name`` and ``source_path``.

    Files are cut into records across input splits (``files.json_objects``), so an array may be larger than a task. Records without positions give no row."""
    found = staged(json_objects(spark, path), "objects")
    record = found.where("depth = 1").select("path", "record", F.from_json("text", RECORD).alias("r"))
    place = found.where("depth = 2").select("path", "record", F.from_json("text", POSITION).alias("l"))
    own = place.join(record, ["path", "record"])
    return own.select("r.source_path", "r.file_name", "l.lat", "l.lon", F.col("l.dt").try_cast("timestamp").alias("dt"), "l.knt")
