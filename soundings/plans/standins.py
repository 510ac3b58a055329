"""Tables of the driver seen as ocean tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import micros


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as fixes: the user is the platform, positions follow from the event's id."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("platform"), "event_id", micros("ts").alias("t"), F.to_date("ts").alias("day"), "value", "event_type",
        ((F.col("event_id") * 37) % 12000 / 100.0 - 60).alias("lat"), ((F.col("event_id") * 91) % 36000 / 100.0 - 180).alias("lon"),
    )


TRACK = """track as (select user_id as platform, event_id, epoch_us(ts) as t, cast(ts as date) as day, value, event_type,
 ((event_id * 37) % 12000) / 100.0 - 60 as lat, ((event_id * 91) % 36000) / 100.0 - 180 as lon from events)"""


#: Events of a task of ``samples``, which are fifty times as many rows in it.
EVENTS = 16_384


def sample_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Into how many tasks ``samples`` are dealt by channel."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "events").count() // EVENTS))  # from footers


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty echo samples for each event: each platform is a channel, its events are the pings.

    Dealt by channel to as many tasks as the events ask for: exchanges are sized before events become samples, and what follows by channel needs no other one."""
    own = track(spark, sf_dir).withColumnRenamed("platform", "channel")
    w = Window.partitionBy("channel").orderBy("t", "event_id")
    p = own.repartition(sample_tasks(spark, sf_dir), "channel").select("channel", (F.row_number().over(w) - 1).alias("ping_idx"), "t", "day", "event_id")
    s = p.withColumn("sample_idx", F.explode(F.sequence(F.lit(0), F.lit(49))))
    return s.select("*", (F.col("sample_idx") * 10.0).alias("depth"), (-90.0 + (F.col("event_id") * 7 + F.col("sample_idx") * 13) % 60).alias("sv"))


SAMPLES = TRACK + """,
pings as (select platform as channel, row_number() over (partition by platform order by t, event_id) - 1 as ping_idx, t, day, event_id from track),
samples as (select channel, ping_idx, t, day, event_id, s as sample_idx, s * 10.0::double as depth, (-90 + ((event_id * 7 + s * 13) % 60))::double as sv
 from pings, (select unnest(range(50)) as s))"""


def haversine(lat0: str, lon0: str, lat1: str, lon1: str) -> str:
    return f"(2 * 3440.065 * asin(sqrt(least(1.0, greatest(0.0, pow(sin(radians({lat1} - {lat0}) / 2), 2) + cos(radians({lat0})) * cos(radians({lat1})) * pow(sin(radians({lon1} - {lon0}) / 2), 2))))))"
