"""The campaign store: partitioned tables that only grow, a ledger of files, and products written from them."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.geo import bin_label, right_closed_bin
from ..functions.text import name_date
from . import keyindex
from .files import listed

# Fixed value: the columns that identify an observation, those present counting.
KEY = ("time", "latitude", "longitude", "trajectory")


def with_bins(df: DataFrame, lat_edges: Sequence[float], lon_edges: Sequence[float], lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.withColumns({"lat_bin": bin_label("lat", right_closed_bin(F.col(lat), lat_edges), lat_edges), "lon_bin": bin_label("lon", right_closed_bin(F.col(lon), lon_edges), lon_edges)})


def write_observations(df: DataFrame, path: str, lat_edges: Sequence[float], lon_edges: Sequence[float], units: dict[str, str] | None = None, mode: str = "append", rows_per_file: int = 5_000_000) -> None:
    """Partitioned by position bins; one shuffle brings a partition's rows together, hot partitions are dealt out by AQE's rebalance.

    Units travel as column metadata, which Parquet keeps."""
    own = with_bins(df, lat_edges, lon_edges)
    own = own.select(*[F.col(c).alias(c, metadata={"units": units[c]}) if units and c in units else F.col(c) for c in own.columns])
    own.hint("rebalance", "lat_bin", "lon_bin").write.option("maxRecordsPerFile", rows_per_file).mode(mode).partitionBy("lat_bin", "lon_bin").parquet(path)


def write_density(df: DataFrame, path: str, size: float = 1.0, mode: str = "append") -> None:
    own = df.withColumns({"lat_bin": (F.floor(F.col("lat") / size) * size).cast("int"), "lon_bin": (F.floor(F.col("lon") / size) * size).cast("int")})
    own.hint("rebalance", "campaign_id", "lat_bin", "lon_bin").write.mode(mode).partitionBy("campaign_id", "lat_bin", "lon_bin").parquet(path)


def read_density(spark: SparkSession, path: str, bbox: tuple[float, float, float, float] | None = None, campaign_id: str | None = None, channel: str | None = None, size: float = 1.0) -> DataFrame:
    """Partition pruning on integer bins first, then the exact box (west, south, east, north)."""
    out = spark.read.parquet(path)
    if campaign_id is not None:
        out = out.where(F.col("campaign_id") == campaign_id)
    if channel is not None:
        out = out.where(F.col("channel") == channel)
    if bbox:
        w, s, e, n = bbox
        low = lambda x: int(x // size * size)
        out = out.where(F.col("lat_bin").between(low(s), low(n)) & F.col("lon_bin").between(low(w), low(e)) & F.col("lat").between(s, n) & F.col("lon").between(w, e))
    return out


def read_campaign(spark: SparkSession, path: str, columns: Sequence[str] | None = None, skip: Sequence[str] = ("stac",)) -> DataFrame:
    """All Parquet files of a campaign, schemas merged; folders named in ``skip`` (catalogues) are left out wherever they stand below ``path``.

    Files are listed by name first, so folders that are no partitions don't meet partition discovery. A campaign without files gives an empty frame."""
    found = listed(spark, path, "*.parquet")
    inside = F.split(F.element_at(F.split("path", re.escape("/" + path.rstrip("/").split("/")[-1] + "/"), 2), 2), "/")
    paths = [r[0] for r in found.where(~F.arrays_overlap(inside, F.array(*[F.lit(s) for s in skip]))).select("path").collect()]  # as many as the scan itself lists
    if not paths:
        return spark.createDataFrame([], StructType())
    out = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*paths)
    return out.select(*[c for c in columns if c in out.columns]) if columns else out


def read_environment(df: DataFrame, mapping: dict[str, str], time_range: tuple | None = None, lat_range: tuple | None = None, lon_range: tuple | None = None, platforms: Sequence[str] | None = None, time: str = "time", lat: str = "latitude", lon: str = "longitude", platform: str = "platform_id") -> DataFrame:
    """Renamed columns of the rows in range; the filters and the column list reach the scan."""
    for c, r in ((time, time_range), (lat, lat_range), (lon, lon_range)):
        if r:
            df = df.where(F.col(c).between(*r))
    if platforms:
        df = df.where(F.col(platform).isin(*platforms))
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items() if a in df.columns])


def write_product(df: DataFrame, path: str, keys: Sequence[str] = ("day", "category")) -> None:
    """A product table; running a day again replaces that day's partitions only."""
    df.hint("rebalance", *keys).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*keys).parquet(path)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in a stated order; NULL keys are equal."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def new_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows to append: the first of each key among ``new`` that ``existing`` does not have; NULL keys are equal."""
    first = distinct_on(new, keys, order)
    have = existing.select(*[F.col(k).alias(f"_{k}") for k in keys])
    cond = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}"))
        cond = same if cond is None else cond & same
    return first.join(have, cond, "left_anti")


def write_routed(df: DataFrame, path: str, campaign: str = "campaign_id") -> None:
    """Rows to the folder of their campaign, those without one left out; one shuffle, hot campaigns dealt out by AQE's rebalance."""
    df.where(F.col(campaign).isNotNull()).hint("rebalance", campaign).write.mode("append").partitionBy(campaign).parquet(path)


def file_frequencies(files: DataFrame, rows: DataFrame, file: str, frequency: str) -> DataFrame:
    """Every file with ``frequencies``, the sorted distinct ones of its rows (empty without any), and ``n_rows``."""
    per = rows.groupBy(file).agg(F.sort_array(F.collect_set(frequency)).alias("_f"), F.count("*").alias("_n"))
    own = files.join(per, file, "left")
    return own.withColumns({"frequencies": F.coalesce("_f", F.array().cast(dict(per.dtypes)["_f"])), "n_rows": F.coalesce("_n", F.lit(0))}).drop("_f", "_n")


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str | Column] = ("time",)) -> list[str]:
    """Append only rows whose key is new; nothing that is stored is rewritten. Returns the stored files that were read for it.

    A key index beside the table (``keyindex``) says which files may hold a key of ``new``, so one late row opens the files around it and no others.
    A table without an index, or with files that it lacks, gets it at the end of the run."""
    try:
        have = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        used = [k for k in keys if k in new.columns]
        distinct_on(new, used, order).write.parquet(path)
        keyindex.update(spark, path, used)
        return []
    used = [k for k in keys if k in new.columns and k in have.columns]
    files = keyindex.may_hold(spark, path, new, used)
    if files:
        # Only stored rows in the range of the new ones can have their keys; the range of the first key prunes row groups.
        low, high = new.agg(F.min(used[0]), F.max(used[0])).first()
        near = spark.read.option("basePath", path).schema(have.schema).parquet(*files)
        near = near.where(F.col(used[0]).between(F.lit(low), F.lit(high)) | F.col(used[0]).isNull())
        add = new_rows(near.select(*used), new, used, order)
    else:
        add = distinct_on(new, used, order)
    add.write.mode("append").parquet(path)
    keyindex.update(spark, path, used)
    return files


def manifest(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Names, sizes and times of files; their bytes are not read. ``day`` is the date in the name; with ``since`` or ``until`` only files dated so stay."""
    out = listed(spark, path).withColumn("day", name_date(F.col("name")))
    if since is not None:
        out = out.where(F.col("day") >= F.lit(since).cast("date"))
    return out.where(F.col("day") <= F.lit(until).cast("date")) if until is not None else out


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose name and hash the ledger does not have; each is judged on its own."""
    return files.join(ledger.select("name", "sha256"), ["name", "sha256"], "left_anti")


def schema_issues(have: StructType, new: StructType, critical: Sequence[str] = ("time", "latitude", "longitude", "geometry")) -> list[str]:
    """What keeps two tables from being put together: critical columns missing, or kinds that differ."""

    def kind(t: str) -> str:
        return "number" if t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal") else "time" if t.startswith(("timestamp", "date")) else t

    a, b = ({f.name: f.dataType.simpleString() for f in s} for s in (have, new))
    out = [f"{c}: missing" for c in critical if (c in a) != (c in b)]
    return out + [f"{c}: {a[c]} and {b[c]}" for c in a if c in b and kind(a[c]) != kind(b[c])]


def geojson(df: DataFrame, geometry: Column, properties: Sequence[str]) -> DataFrame:
    """``value``: one GeoJSON feature for each row, ready for a text sink."""
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("value"))


def line_string(coordinates: Column) -> Column:
    return F.struct(F.lit("LineString").alias("type"), coordinates.alias("coordinates"))


def point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def track_features(segments: DataFrame, arrows: DataFrame, markers: DataFrame, measures: Sequence[str] = (), image: Column | None = None) -> DataFrame:
    """``value``: newline GeoJSON of a campaign's track: segments as lines with their mean measures, arrows as points with their course, and the first and last point of each day.

    ``segments``: platform, segment, day, n_points, t_start, t_end, coordinates; ``arrows``: platform, segment, lon, lat, bearing; ``markers``: platform, day, t_first, t_last, first, last.
    ``image`` names a segment's product image. Empty properties are left out of a feature."""
    links = [image.alias("image")] if image is not None else []
    lines = segments.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("segment").alias("type"), "platform", "segment", *[c for c in ("day",) if c in segments.columns], "n_points", "t_start", "t_end", *measures, *links).alias("properties"), line_string(F.col("coordinates")).alias("geometry"))).alias("value"))
    heads = geojson(arrows.withColumn("type", F.lit("arrow")), point(F.col("lon"), F.col("lat")), ["type", "platform", "segment", "bearing"])
    ends = markers.select("platform", "day", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(t).alias("t"), F.col(f"{at}.lon").alias("lon"), F.col(f"{at}.lat").alias("lat")) for k, t, at in (("start", "t_first", "first"), ("end", "t_last", "last"))])).alias("e"))
    ends = geojson(ends.select(F.lit("day_marker").alias("type"), "platform", "day", "e.*"), point(F.col("lon"), F.col("lat")), ["type", "platform", "day", "kind", "t"])
    return lines.unionByName(heads).unionByName(ends)


def density_features(df: DataFrame, values: dict[str, int], keys: Sequence[str] = ("channel", "t")) -> DataFrame:
    """``value``: newline GeoJSON of density points (``lon``, ``lat`` to six decimals) with ``keys`` and each of ``values`` rounded to so many decimals; points without a position or any value are left out."""
    own = df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.coalesce(*[F.col(v).cast("double") for v in values]).isNotNull())
    own = own.withColumns({v: F.round(F.col(v).cast("double"), d) for v, d in values.items()})
    return geojson(own, point(F.round(F.col("lon").cast("double"), 6), F.round(F.col("lat").cast("double"), 6)), [*keys, *values])


def save_metadata(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def schema_json(df: DataFrame) -> str:
    return json.dumps({f.name: dict(f.metadata) for f in df.schema if f.metadata})
