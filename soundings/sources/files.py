"""Files as streams inside tasks: hashing of files of any size, and JSON arrays cut into records across input splits."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bucketed import running_sums
from ..session import staged

#: Bytes of a file that a task holds while it reads it.
CHUNK = 8 << 20
#: What stands for a whole string when structure is counted.
_STRING = r'"(?:[^"\\]++|\\.)*+"'

#: The last brace that opens outside of strings: what stands before it, and after it.
_LAST = r'(?s)^(.*)\{((?:[^"{}]++|"(?:[^"\\]++|\\.)*+")*+)$'


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the place in it; a path is no encoded address, so its percent signs are its own."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path):
        return pafs.FileSystem.from_uri(quote(re.sub("^file:/+", "file:///", path), safe="/:@=,+~!$&'()*;"))
    return pafs.LocalFileSystem(), path


def listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path``, ``name``, ``length`` and ``modificationTime`` of all files below ``path``; their bytes are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``name``, ``sha256`` and ``length`` of files of any size: each is read as a stream in its task, a few megabytes at a time. Scans list no empty files, so these have no row."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for p in batch.column("path").to_pylist():
                fs, at = opened(p)
                own = hashlib.sha256()
                with fs.open_input_stream(at, compression=None, buffer_size=0) as stream:
                    while part := stream.read(CHUNK):
                        own.update(part)
                found.append(own.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("name"), pa.array(found, pa.string()), batch.column("length")], names=["path", "name", "sha256", "length"])

    files = listed(spark, path).select("path", "name", "length")
    return files.repartition(F.col("path")).mapInArrow(digest, "path string, name string, sha256 string, length long")


def write_text_files(df: DataFrame, path: str, file: str, order: Sequence[str], value: str = "value") -> int:
    """A text file below ``path`` for each ``file`` (its place there), a line for each row in ``order``; returns the number of lines.

    For very many small files: a partitioned write makes a folder, a checksum and a move for each. Files are written as streams; a task that runs again
    writes its files anew."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(path)
        last, stream, folders = None, None, set()
        try:
            for batch in batches:
                names = np.array(batch.column(0).to_pylist(), object)
                values = batch.column(1).to_pylist()
                starts = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, int)
                for a, z in zip(starts, np.append(starts[1:], len(names)), strict=True):
                    if names[a] != last:
                        if stream is not None:
                            stream.close()
                        last, at = names[a], f"{root}/{names[a]}"
                        folder = at.rsplit("/", 1)[0]
                        if folder not in folders:
                            fs.create_dir(folder, recursive=True)
                            folders.add(folder)
                        stream = fs.open_output_stream(at)
                    stream.write(("\n".join(v or "" for v in values[a:z]) + "\n").encode())
                yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], names=["n"])
        finally:
            if stream is not None:
                stream.close()

    own = df.repartition(file).sortWithinPartitions(file, *order).select(F.col(file).cast("string"), F.col(value).cast("string"))
    return own.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def _quotes(text: Column) -> Column:
    """Quotes that open or close a string."""
    bare = F.regexp_replace(text, r"\\.", "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).cast("long")


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """The objects of JSON files that hold arrays of records, however large: ``path``, ``record`` (its number in the file), ``depth`` (1: what stands in the record itself, 2: an
    object inside it), ``at`` and ``text``.

    Files are read by input splits and cut at closing braces. Running counts along each file, in buckets of its splits, tell braces in strings from others and
    how deep each object lies; so neither a file nor a record has to fit in a task. Records hold objects of one level, such as lists of positions."""
    meta = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_b")]
    pieces = spark.read.option("lineSep", "}").text(path).select(*meta, F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    pieces = staged(pieces.withColumn("q", _quotes(F.col("text"))), "pieces")
    if pieces.where("q % 2 = 1").isEmpty():
        whole = pieces.drop("q")
    else:  # a brace inside a string: what it cut goes together again
        own = running_sums(pieces, ["path"], ["at"], {"so_far": F.col("q")})
        own = staged(own.withColumn("real", (F.col("so_far") % 2 == 0).cast("long")), "pieces")
        own = running_sums(own, ["path"], ["at"], {"k": F.col("real")}).withColumn("k", F.col("k") - F.col("real"))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "at", "text"))), lambda x: x["text"]), "}")
        whole = own.groupBy("path", "k").agg(F.min(F.struct("_b", "at")).alias("first"), joined.alias("text")).select("path", "first.*", "text")
    # A piece without a brace that opens, in the order of the file, closes its record; the tail of a file closes nothing.
    bare = F.regexp_replace("text", _STRING, '""')
    opens = (F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit("")))).cast("long")
    whole = staged(whole.withColumn("opens", opens), "pieces")
    own = staged(running_sums(whole, ["path"], ["at"], {"depth": F.col("opens") - 1}), "pieces")
    own = own.where("depth >= 0").withColumn("closed", (F.col("depth") == 0).cast("long"))
    own = running_sums(own, ["path"], ["at"], {"record": F.col("closed")}).withColumn("record", F.col("record") - F.col("closed"))
    outer = F.when(F.col("opens") == 0, F.col("text")).otherwise(F.regexp_extract("text", _LAST, 1))
    last = F.regexp_extract("text", _LAST, 2)
    # Of a record without objects inside, the one piece is both what opens and what closes it.
    alone = (F.col("depth") == 0) & (F.col("opens") > 0)
    inside = own.where((F.col("opens") > 0) & ~alone).select("path", "record", F.lit(2).alias("depth"), "at", F.concat(F.lit("{"), last, F.lit("}")).alias("text"))
    shell = own.select("path", "record", "_b", "at", F.when(alone, F.concat(F.lit("{"), last)).otherwise(outer).alias("text")).where(F.regexp_replace("text", r"[\s,]+", "") != "")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "at", "text"))), lambda x: x["text"]), " ")
    whole_shell = shell.groupBy("path", "record").agg(F.min("at").alias("at"), text.alias("text"))
    return inside.unionByName(whole_shell.select("path", "record", F.lit(1).alias("depth"), "at", F.concat(F.regexp_replace("text", r"(?s)^[^{]*", ""), F.lit("}")).alias("text")))
