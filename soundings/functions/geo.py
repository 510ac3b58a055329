"""Positions: distance, bearing, bins, names and shapes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Earth's mean radius in nautical miles.
EARTH_NMI = 3440.065


def great_circle_nmi(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    """Haversine distance; the square of the half chord is clipped to [0, 1]."""
    a, b = F.sin(F.radians(lat1 - lat0) / 2), F.sin(F.radians(lon1 - lon0) / 2)
    h = a * a + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * b * b
    return 2 * EARTH_NMI * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), h))))


def bearing(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    """Initial course in degrees, 0 to 360."""
    d = F.radians(lon1 - lon0)
    y = F.sin(d) * F.cos(F.radians(lat1))
    x = F.cos(F.radians(lat0)) * F.sin(F.radians(lat1)) - F.sin(F.radians(lat0)) * F.cos(F.radians(lat1)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def edge_text(x: Column) -> Column:
    """An edge with six decimals, trailing zeros cut, and no negative zero."""
    t = F.regexp_replace(F.regexp_replace(F.format_string("%.6f", x), r"0+$", ""), r"\.$", "")
    return F.when(x.isNotNull(), F.when(t == "-0", "0").otherwise(t))


def right_closed_bin(x: Column, edges: Sequence[float], clip: bool = True, lowest: bool = True) -> Column:
    """Index of the bin (edges[i], edges[i + 1]] that holds ``x``; ``lowest`` lets the first bin hold its low edge."""
    x = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(edges[0]))), F.lit(float(edges[-1])))) if clip else x
    found = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        low = (x >= edges[i]) if i == 0 and lowest else (x > edges[i])
        found = F.when(low & (x <= edges[i + 1]), F.lit(i)).otherwise(found)
    return found


def bin_label(prefix: str, index: Column, edges: Sequence[float]) -> Column:
    """``prefix_low_high`` of a bin; rows without one get ``nan``."""
    ends = F.array(*[F.lit(float(e)) for e in edges])
    return F.coalesce(F.concat(F.lit(prefix + "_"), edge_text(F.get(ends, index)), F.lit("_"), edge_text(F.get(ends, index + 1))), F.lit("nan"))


def points(lon: pa.Array, lat: pa.Array) -> pa.Array:
    """21-byte little-endian points for whole columns; NULL where either coordinate is."""
    x, y = (np.asarray(c.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False), "<f8") for c in (lon, lat))
    table = np.zeros((len(x), 21), np.uint8)
    table[:, :5] = np.frombuffer(b"\x01\x01\x00\x00\x00", np.uint8)
    table[:, 5:13], table[:, 13:] = x[:, None].view(np.uint8), y[:, None].view(np.uint8)
    offsets = np.arange(len(x) + 1, dtype=np.int32) * 21
    whole = pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(table)])
    return pc.if_else(pc.and_(pc.is_valid(lon), pc.is_valid(lat)), whole, pa.scalar(None, pa.binary()))


def point_wkb(lon: Column, lat: Column) -> Column:
    """A point in 21 bytes; NULL where either coordinate is. Doubles have no bytes in SQL, so whole columns go through Arrow."""

    def make(x: pa.Array, y: pa.Array) -> pa.Array:
        return points(x, y)

    return F.arrow_udf(make, "binary")(lon.cast("double"), lat.cast("double"))


def bbox_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    return F.array(F.array(west, south), F.array(east, south), F.array(east, north), F.array(west, north), F.array(west, south))


def iso_utc(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
