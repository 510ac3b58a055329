"""Session conventions: UTC, NaN as NULL, and places that all executors can reach."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def session(name: str = "soundings", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names; under one of our own only where it is unset in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        os.makedirs("/tmp/checkpoints", exist_ok=True)
        root = "file://" + tempfile.mkdtemp(prefix="soundings-", dir="/tmp/checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write and read back: cuts lineage, and gives later joins a scan that AQE can split."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    kinds = (DoubleType, FloatType)
    return df.withColumns({f.name: F.nanvl(F.col(f.name), F.lit(None)) for f in df.schema if isinstance(f.dataType, kinds)})


def micros(time: str) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone, by its UTC clock."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({time} as timestamp_ntz))")
