"""Which stored files may hold a key: the range of the first key and a Bloom filter of whole keys for each file, as tables beside the data.

The filter is kept as rows of (file, word, bits), so a batch of keys finds its files by joins: first by ranges, in buckets of the first key, then by the
words its bits lie in. Files that the index does not know yet are always read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged

#: Bits of a filter for each row at least, bits that a key sets, and bits of a filter at most.
BITS_EACH, PROBES, MOST_BITS = 10, 4, 1 << 26
#: Buckets that the whole range of the first key is cut into.
BUCKETS = 1024
#: Rows that a file counts for at least, when it is weighed whether to test it.
LEAST_ROWS = 4096
#: For rows whose first key is NULL.
NO_RANGE = -(1 << 62)


def index_path(path: str) -> str:
    return path.rstrip("/") + ".keys"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys], *[F.col(k).isNull() for k in keys])


def _probes(h: Column, bits: Column) -> Column:
    at, step = F.pmod(h, bits), F.pmod(F.shiftrightunsigned(h, 17).bitwiseOR(F.lit(1)), bits)  # reduced first: sums stay small
    return F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: F.pmod(at + i * step, bits))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))


def _number(df: DataFrame, key: str) -> Column | None:
    """The first key as a number in the same order; None for kinds without one."""
    kind = dict(df.dtypes)[key]
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.col(key).cast("double")
    if kind == "date":
        return F.datediff(F.col(key), F.lit("1970-01-01").cast("date")).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(key).cast("timestamp")).cast("double")
    return None


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    try:
        return spark.read.parquet(index_path(path) + "/files"), spark.read.parquet(index_path(path) + "/bits")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
            return None
        raise


def _plain(file: str) -> str:
    """A file's name without what scans and listings write differently."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", unquote(file))


def stored(spark: SparkSession, path: str) -> list[str]:
    """The table's files, as the scan of it lists them."""
    return [str(f) for f in spark.read.parquet(path).inputFiles()]


def update(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Add the files that the index does not know. Bits come first, so a file that ``files`` lists has all of them, whenever a run ends."""
    have = _tables(spark, path)
    known = {_plain(r[0]) for r in have[0].where(F.col("keys") == ",".join(keys)).select("file").collect()} if have else set()
    new = [f for f in stored(spark, path) if _plain(f) not in known]
    if not new:
        return
    rows = spark.read.option("basePath", path).parquet(*new)
    first = _number(rows, keys[0])
    own = rows.select(F.col("_metadata.file_path").alias("file"), (F.lit(None).cast("double") if first is None else first).alias("first"), _hash(keys).alias("h"))
    files = own.groupBy("file").agg(F.min("first").alias("lo"), F.max("first").alias("hi"), F.bool_or(F.col("first").isNull()).alias("nulls"), F.count("*").alias("n_rows"))
    size = F.least(F.lit(MOST_BITS), F.greatest(F.lit(64), F.pow(2, F.ceil(F.log2(F.col("n_rows") * BITS_EACH))).cast("long")))
    files = files.withColumns({"bits": size.cast("long"), "keys": F.lit(",".join(keys))})
    places = own.join(files.select("file", "bits"), "file").select("file", F.explode(_probes(F.col("h"), F.col("bits"))).alias("place"))
    words = places.groupBy("file", F.floor(F.col("place") / 64).alias("word")).agg(F.bit_or(_bit(F.col("place"))).alias("set"))
    words.withColumn("keys", F.lit(",".join(keys))).write.mode("append").parquet(index_path(path) + "/bits")
    files.write.mode("append").parquet(index_path(path) + "/files")


def may_hold(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """The stored files that may hold any key of ``batch``: exact as to leaving out, since ranges and filters miss no key.

    A file is tested where that costs less than to read it. One whose range holds more keys of the batch, each of which asks for ``PROBES`` rows, than the
    file has rows is named untested; so a batch never makes more rows than the table has, however many files its keys lie across."""
    files = stored(spark, path)
    have, first = _tables(spark, path), _number(batch, keys[0])
    if have is None or first is None:
        return files
    of = F.col("keys") == ",".join(keys)
    index, bits = have[0].where(of).select("file", "lo", "hi", "nulls", "bits", "n_rows"), have[1].where(of)
    lo, hi, known = index.agg(F.min("lo"), F.max("hi"), F.collect_set("file")).first()  # the names of the table's files, as above
    lo, hi = (0.0, 0.0) if lo is None else (lo, hi)
    width = max((hi - lo) / BUCKETS, 1e-9)
    bucket = lambda c: F.least(F.greatest(F.floor((c - lo) / width), F.lit(-1)), F.lit(BUCKETS + 1))
    spans = F.when(F.col("lo").isNotNull(), F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))).otherwise(F.array().cast("array<long>"))
    spans = F.concat(spans, F.when(F.col("nulls"), F.array(F.lit(NO_RANGE).cast("long"))).otherwise(F.array().cast("array<long>")))
    there = index.withColumn("b", F.explode(spans))
    own = batch.select(first.alias("first"), _hash(keys).alias("h")).withColumn("b", F.when(F.col("first").isNull(), F.lit(NO_RANGE)).otherwise(bucket(F.col("first"))))
    load = there.join(own.groupBy("b").agg(F.count("*").alias("asked")), "b").groupBy("file").agg((F.sum("asked") * PROBES > F.greatest(F.max("n_rows"), F.lit(LEAST_ROWS))).alias("untested"))
    load = staged(load, "load")
    found = {_plain(r[0]) for r in load.where("untested").select("file").collect()}
    few = load.where("not untested")
    if not few.isEmpty():
        near = own.distinct().join(there.join(few, "file", "left_semi"), "b").where(F.col("first").isNull() | F.col("first").between(F.col("lo"), F.col("hi")))
        probes = near.select("file", "h", F.explode(F.array_distinct(_probes(F.col("h"), F.col("bits")))).alias("place"))
        probes = probes.withColumn("word", F.floor(F.col("place") / 64))
        tested = probes.join(bits.select("file", "word", "set"), ["file", "word"], "left")
        hit = F.coalesce(F.col("set").bitwiseAND(_bit(F.col("place"))) != 0, F.lit(False))
        found |= {_plain(r[0]) for r in tested.groupBy("file", "h").agg(F.bool_and(hit).alias("all")).where("all").select("file").distinct().collect()}
    names = {_plain(f) for f in known or ()}
    return [f for f in files if _plain(f) not in names or _plain(f) in found]
