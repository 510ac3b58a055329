"""Catalogue records of a store: a collection, and an item for each partition or product, as rows of JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import bbox_ring
from ..operators.statistics import measurement_statistics

# Fixed value: the version of the catalogue specification.
VERSION = "1.0.0"


def _iso(time: Column) -> Column:
    return F.date_format(F.timestamp_micros(time), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _extent(df: DataFrame, keys: Sequence[str], lat: str, lon: str, time: str) -> DataFrame:
    box = [F.min(lon).alias("west"), F.min(lat).alias("south"), F.max(lon).alias("east"), F.max(lat).alias("north")]
    return (df.groupBy(*keys) if keys else df.groupBy()).agg(*box, F.min(time).alias("t0"), F.max(time).alias("t1"), F.count("*").alias("n_rows"))


def items(df: DataFrame, collection: str, keys: Sequence[str], lat: str = "lat", lon: str = "lon", time: str = "t", properties: Sequence[Column] = ()) -> DataFrame:
    """``id`` and ``value`` (JSON): an item for each value of ``keys``, with the box and times of its own rows. ``properties``: aggregates that items hold too. ``time`` in microseconds."""
    own = _extent(df, keys, lat, lon, time)
    if properties:
        own = own.join(df.groupBy(*keys).agg(*properties), list(keys))
    more = [c for c in own.columns if c not in (*keys, "west", "south", "east", "north", "t0", "t1", "n_rows")]
    name = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys])
    ring = F.array(bbox_ring(F.col("west"), F.col("south"), F.col("east"), F.col("north")))
    record = F.struct(
        F.lit("Feature").alias("type"), F.lit(VERSION).alias("stac_version"), F.concat(F.lit(f"{collection}/"), name).alias("id"), F.lit(collection).alias("collection"),
        F.array("west", "south", "east", "north").alias("bbox"), F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"),
        F.struct(_iso(F.col("t0")).alias("start_datetime"), _iso(F.col("t1")).alias("end_datetime"), "n_rows", *more).alias("properties"),
        F.struct(F.struct(F.concat(F.lit("../"), name).alias("href"), F.lit("application/x-parquet").alias("type"), F.array(F.lit("data")).alias("roles")).alias("data")).alias("assets"),
        F.array(F.struct(F.lit("collection").alias("rel"), F.lit("../collection.json").alias("href"))).alias("links"),
    )
    return own.select(record["id"].alias("id"), F.to_json(record).alias("value"))


def collection(df: DataFrame, name: str, provider: str, measures: Sequence[str] = (), platform: str | None = "platform", keywords: Sequence[str] = (), lat: str = "lat", lon: str = "lon", time: str = "t") -> DataFrame:
    """``value``: one row of JSON, the collection with its extent, and summaries of platforms (sorted) and of the measures."""
    own = _extent(df, [], lat, lon, time)
    if platform:
        own = own.join(df.agg(F.sort_array(F.collect_set(F.col(platform).cast("string"))).alias("platforms")))
    else:
        own = own.withColumn("platforms", F.array().cast("array<string>"))
    if measures:
        stats = measurement_statistics(df, measures).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("variable", F.struct("min", "max", "mean"))))).alias("measurements"))
        own = own.join(stats)
    else:
        own = own.withColumn("measurements", F.lit(None).cast("map<string,double>"))
    record = F.struct(
        F.lit("Collection").alias("type"), F.lit(VERSION).alias("stac_version"), F.lit(name).alias("id"), F.lit(f"Observations of provider {provider!r}.").alias("description"), F.lit("MIT").alias("license"),
        F.array(*[F.lit(k) for k in sorted(set(keywords))]).cast("array<string>").alias("keywords"),
        F.struct(F.struct(F.array(F.array("west", "south", "east", "north")).alias("bbox")).alias("spatial"), F.struct(F.array(F.array(_iso(F.col("t0")), _iso(F.col("t1")))).alias("interval")).alias("temporal")).alias("extent"),
        F.array(F.struct(F.lit(provider).alias("name"), F.array(F.lit("producer")).alias("roles"))).alias("providers"), F.struct("platforms", "measurements").alias("summaries"),
        F.array(F.struct(F.lit("items").alias("rel"), F.lit("items/").alias("href"))).alias("links"),
    )
    return own.select(F.to_json(record).alias("value"))


def write_catalogue(path: str, whole: DataFrame, parts: DataFrame) -> None:
    """The collection under ``collection`` and items, a line each, under ``items``."""
    whole.select("value").write.mode("overwrite").text(f"{path}/collection")
    parts.select("value").write.mode("overwrite").text(f"{path}/items")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``description``, ``license``, ``platforms`` of a catalogue's collection and ``n_items``, the number of its items."""
    j = lambda p: F.get_json_object("value", p)
    own = spark.read.text(f"{path}/collection").select(j("$.id").alias("id"), j("$.description").alias("description"), j("$.license").alias("license"), F.from_json(j("$.summaries.platforms"), "array<string>").alias("platforms"))
    return own.join(spark.read.text(f"{path}/items").agg(F.count("*").alias("n_items")))
