"""Places that every executor can reach, and small helpers used by several operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where it is unset in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        os.makedirs("/tmp/checkpoints", exist_ok=True)
        found = "file://" + tempfile.mkdtemp(prefix="soundings-", dir="/tmp/checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Tables written inside a ``with`` block: all but those kept are deleted at its end, and single ones before, when nothing is to be read from them again.

    What was made from a deleted table has been written itself, so a lost executor needs none of them."""

    _open: list[Scratch] = []

    def __enter__(self) -> Scratch:
        self.paths: dict[str, SparkSession] = {}
        Scratch._open.append(self)
        return self

    def __exit__(self, *_: object) -> None:
        Scratch._open.remove(self)
        for path, spark in self.paths.items():
            _delete(spark, path)

    def keep(self, *frames: DataFrame) -> None:
        """Tables that the result still reads; they belong to the block around this one, if there is any."""
        for df in frames:
            spark = self.paths.pop(df._scratch, None)
            around = Scratch._open[: Scratch._open.index(self)]
            if spark is not None and around:
                around[-1].paths[df._scratch] = spark


def dropped(*frames: DataFrame) -> None:
    """Delete the tables of frames that ``staged`` gave."""
    for df in frames:
        _delete(df.sparkSession, df._scratch)
        for scope in Scratch._open:
            scope.paths.pop(df._scratch, None)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, tidy: bool = True) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there,
    a lost executor loses nothing, and later joins see an unpartitioned scan that AQE can split. With ``tidy`` its shuffle files go with the write (a setting of Spark 4; others keep them until the driver collects)."""
    path, conf = new_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true" if tidy else before)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    if Scratch._open:
        Scratch._open[-1].paths[path] = df.sparkSession
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*cols: str):
    """A key for rows whose id may be null or repeated: rows equal in ``cols`` share it."""
    return F.xxhash64(*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols])


def bit_tables(*keys: DataFrame, bits: int = 25) -> list[np.ndarray]:
    """For each frame with a column ``key`` a bit table of fixed size (4 MB) with two bits for each key, for tasks to hold; all are made by one job.

    A table lets all its keys through, and the fewer others the emptier it is. It only saves rows: what it lets through is for joins to settle."""
    mask, size, each = F.lit((1 << bits) - 1), 1 << 13, 1 << (bits - 5)
    rows = None
    for i, own in enumerate(keys):
        own = own.select(F.col("key"), F.lit(i << bits).cast("long").alias("base"))
        rows = own if rows is None else rows.unionByName(own)
    at = rows.select("base", F.explode(F.array(F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", bits).bitwiseAND(mask))).alias("x"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("x").bitwiseAND(F.lit(31)).cast("int"))
    words = at.groupBy(F.shiftright(F.col("base") + F.col("x"), 5).alias("w")).agg(F.bit_or(bit).alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, w, v = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("part", "w", "v"))
            for k in np.unique(part):
                own, marks = part == k, np.zeros(size, np.uint32)
                marks[w[own] % size] = v[own].astype(np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([marks.tobytes()], pa.binary())], names=["part", "bits"])

    parts = words.withColumn("part", F.floor(F.col("w") / size)).repartition("part").sortWithinPartitions("part").select("part", "w", "v").mapInArrow(pack, "part long, bits binary")
    table = np.zeros(each * len(keys), np.uint32)
    got = parts.toArrow()
    for part, marks in zip(got.column("part").to_pylist(), got.column("bits").to_pylist(), strict=True):
        table[part * size : (part + 1) * size] |= np.frombuffer(marks, np.uint32)
    return [table[i * each : (i + 1) * each] for i in range(len(keys))]


def bit_table(keys: DataFrame, key: str) -> np.ndarray:
    return bit_tables(keys.select(F.col(key).alias("key")))[0]


def passes(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of the uint64 ``keys`` the bit table lets through."""
    bits = (len(table) * 32).bit_length() - 1
    mask = np.uint64((1 << bits) - 1)

    def marked(x: np.ndarray) -> np.ndarray:
        return (table[(x >> np.uint64(5)).view(np.int64)] >> (x & np.uint64(31)).astype(np.uint32) & np.uint32(1)).view(np.int32) != 0

    out = marked(keys & mask)
    on = np.flatnonzero(out)  # the others have been settled
    out[on] = marked((keys[on] >> np.uint64(bits)) & mask)
    return out
