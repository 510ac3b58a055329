"""Parquet with keys in the footer, which Spark's own writer cannot set: a Python data source with commit and abort.

Each task writes files of its rows into a folder of its attempt beside the table; the commit moves those of the successful attempts into place, and an
abort deletes them all. Files are found in the folder of their partition, as in Spark's own tables.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.geo import points
from .files import listed, opened

#: Rows of a file at most.
ROWS_PER_FILE = 5_000_000
SCRATCH = "_writing"
ESCAPED = r"""["#%'*/:=?\\\x7f{\[\]^\x00-\x1f]"""


def _folder(key: str, value: object) -> str:
    """A partition's folder; characters that paths cannot have are put as Spark does."""
    return f"{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else re.sub(ESCAPED, lambda m: f'%{ord(m[0]):02X}', str(value))}"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Sink(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.keys = json.loads(options.get("keys", "[]"))
        self.footer = json.loads(options.get("footer", "{}"))
        self.lat, self.lon = options.get("latitude", "latitude"), options.get("longitude", "longitude")
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = opened(self.path)
        attempt, files, at, writer, box, rows = uuid.uuid4().hex, [], None, None, None, 0

        def close() -> None:
            nonlocal writer
            if writer is not None:
                column = {"encoding": "WKB", "geometry_types": ["Point"]} | ({"bbox": box} if box[0] <= box[2] else {})
                geo = {"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": column}}
                writer.add_key_value_metadata({"geo": json.dumps(geo), **{k: v if isinstance(v, str) else json.dumps(v) for k, v in self.footer.items()}})
                writer.close()
                writer = None

        for batch in iterator:
            values = [batch.column(k).to_pylist() for k in self.keys]
            names = ["/".join(_folder(k, v) for k, v in zip(self.keys, row, strict=True)) for row in zip(*values, strict=True)] if self.keys else [""] * batch.num_rows
            cut = [i for i in range(batch.num_rows) if not i or names[i] != names[i - 1]] + [batch.num_rows]
            body = pa.Table.from_batches([batch]).drop_columns(self.keys)
            body = body.append_column("geometry", points(batch.column(self.lon), batch.column(self.lat)))
            for a, z in zip(cut[:-1], cut[1:], strict=True):
                if writer is None or names[a] != at or rows >= ROWS_PER_FILE:
                    close()
                    at, rows, box = names[a], 0, [np.inf, np.inf, -np.inf, -np.inf]
                    name = f"part-{len(files):05d}-{attempt}.parquet"
                    scratch = f"{root}/{SCRATCH}/{self.run}/{attempt}/{len(files)}"
                    fs.create_dir(scratch, recursive=True)
                    files.append((f"{scratch}/{name}", f"{root}/{at}/{name}" if at else f"{root}/{name}"))
                    writer = pq.ParquetWriter(fs.open_output_stream(f"{scratch}/{name}"), body.schema, compression="zstd")
                writer.write_table(body.slice(a, z - a))
                rows += z - a
                x, y = (pc.min_max(batch.column(c).slice(a, z - a)).as_py() for c in (self.lon, self.lat))
                if x["min"] is not None and y["min"] is not None:
                    box = [min(box[0], x["min"]), min(box[1], y["min"]), max(box[2], x["max"]), max(box[3], y["max"])]
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)) if i.type == pafs.FileType.File and f"/{SCRATCH}/" not in i.path] if self.overwrite else []
        for scratch, final in [f for m in messages if m is not None for f in m.files]:
            fs.create_dir(final.rsplit("/", 1)[0], recursive=True)
            fs.move(scratch, final)
        for path in old:
            fs.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing of this run stays in the scratch folder; without a commit the table is as it was."""
        fs, root = opened(self.path)
        if fs.get_file_info(f"{root}/{SCRATCH}/{self.run}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{SCRATCH}/{self.run}")


class GeoParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geoparquet_points"

    def schema(self) -> StructType:
        raise NotImplementedError("written only; its files are plain Parquet")

    def writer(self, schema: StructType, overwrite: bool) -> _Sink:
        return _Sink(dict(self.options), overwrite)


def write_geoparquet(df: DataFrame, path: str, keys: Sequence[str] = ("lat_bin", "lon_bin"), units: dict[str, str] | None = None, aliases: dict[str, str] | None = None, standard_names: dict[str, str] | None = None, more: dict[str, str] | None = None, latitude: str = "latitude", longitude: str = "longitude", mode: str = "append") -> None:
    """Rows with a ``geometry`` column of points, in a folder for each value of ``keys``; every file's footer has ``geo`` (with the box of its rows), ``units``, ``aliases``,
    ``cf_standard_names`` and the keys of ``more``. NULL positions have a NULL geometry; NULL keys go to the default partition.

    One shuffle brings a partition's rows together, hot partitions are dealt out by AQE's rebalance, so a file holds rows of one partition."""
    footer = {"units": units, "aliases": aliases, "cf_standard_names": standard_names} | (more or {})
    df.sparkSession.dataSource.register(GeoParquet)
    own = df.hint("rebalance", *keys).sortWithinPartitions(*keys) if keys else df
    options = {"path": path, "keys": json.dumps(list(keys)), "footer": json.dumps({k: v for k, v in footer.items() if v}), "latitude": latitude, "longitude": longitude}
    own.write.format("geoparquet_points").options(**options).mode(mode).save()


def footers(spark: SparkSession, path: str) -> DataFrame:
    """``file`` (below ``path``), ``n_rows`` and ``keys``, a map of what each file's footer has, Arrow's own schema left out; only footers are read."""
    top = "/" + path.rstrip("/").split("/")[-1] + "/"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows, keys = [], [], []
            for p in batch.column("path").to_pylist():
                fs, at = opened(p)
                found = pq.read_metadata(fs.open_input_file(at))
                names.append(p.split(top, 1)[-1])
                rows.append(found.num_rows)
                keys.append([(k.decode(), v.decode()) for k, v in (found.metadata or {}).items() if k != b"ARROW:schema"])
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(rows, pa.int64()), pa.array(keys, pa.map_(pa.string(), pa.string()))], names=["file", "n_rows", "keys"])

    return listed(spark, path, "*.parquet").select("path").repartition(F.col("path")).mapInArrow(read, "file string, n_rows long, keys map<string,string>")
