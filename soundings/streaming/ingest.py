"""Incremental ingest: a file source whose checkpoint is the ledger, and an upsert for each batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import upsert


def append_new_files(spark: SparkSession, source: str, schema, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], fmt: str = "parquet") -> StreamingQuery:
    """Take in all files not seen before and stop; each file is read once, whatever the number of runs.

    A batch that is repeated after a failure finds its keys in the table, so rows are written once."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert(batch.sparkSession, target, batch, keys, order)

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_within(stream: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """Streaming distinct with bounded state; rows later than ``late`` are dropped. An option, as the upsert takes rows of any age."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))
