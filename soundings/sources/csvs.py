"""Landed CSV files: all text first, types decided once by what most rows hold."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, csv_cells, named_cells, platform_of

POSITION = ("latitude", "longitude")
SHIP_POSITION = ("ship_latitude", "ship_longitude")


def _numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line with its file's ``path`` and ``file`` name, the ``block`` of the file it is read from, and an ``id`` that rises within a block."""
    meta = [F.col(f"_metadata.{name}").alias(to) for name, to in (("file_path", "path"), ("file_name", "file"), ("file_block_start", "block"))]
    return spark.read.text(path).select(*meta, F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path``, ``file`` (its name), ``line_no`` (from 0, within the file) and ``line``; empty lines count and are left out.

    Files are read by blocks, so no file has to fit in a task: a block's first line number is the count of lines in the file's blocks before it."""
    own = _numbered(spark, path)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = own.groupBy("path", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    blocks = blocks.select("path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return own.join(blocks.hint("shuffle_hash"), ["path", "block"]).select("path", "file", (F.col("id") + F.col("shift")).alias("line_no"), "line").where("line <> ''")


def _names(header: str) -> list[str]:
    """The column names of a header line; a repeated one gets a number."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for name in next(csv.reader([header.removeprefix("\ufeff")])):
        low = name.lower()
        out.append(name if low not in seen else f"{name}.{seen[low]}")
        seen[low] = seen.get(low, 0) + 1
    return out


class Headed:
    """Files of any number of headers, read together: ``rows`` has ``file``, ``header`` (the line) and ``cells`` (an array), ``headers`` the names of each distinct header."""

    def __init__(self, spark: SparkSession, path: str | list[str]) -> None:
        """The header is a file's first line that is not blank and not of a ``#`` block at its top. A record is one line, parsed once to as many
        cells as the widest header has, and one more for lines with too many fields, which are dropped. Only distinct headers come to the driver.
        A header meets its file's lines block by block, so a large file is no task's own."""
        lines = _numbered(spark, path).where(F.trim("line") != "")
        here = F.when((F.col("block") == 0) & ~F.ltrim("line").startswith("#"), F.struct("id", "line"))
        blocks = lines.groupBy("path", "block").agg(F.min(here).alias("first"))
        top = F.first("first").over(Window.partitionBy("path").orderBy("block"))
        heads = blocks.select("path", "block", top.alias("top")).where("top is not null").select("path", "block", F.col("top.line").alias("header"), F.col("top.id").alias("at"))
        self.spark = spark
        self.headers = {h: _names(h) for h in sorted(r[0] for r in heads.where("block = 0").select("header").distinct().collect())}
        most = max(map(len, self.headers.values()), default=0)
        data = lines.join(heads.hint("shuffle_hash"), ["path", "block"]).where((F.col("block") > 0) | (F.col("id") > F.col("at")))
        schema = ", ".join(f"c{i} string" for i in range(most + 1))
        self.rows = data.select("file", "header", F.from_csv("line", schema).alias("r")).select("file", "header", F.array(*[blank_to_null(F.col(f"r.c{i}")) for i in range(most + 1)]).alias("cells"))

    def named(self, headers: Sequence[str], marks: dict[str, bool] | None = None) -> DataFrame:
        """Rows below these headers, a text column for each name that any of them has, ``platform_id`` and ``_spatial``, the header's mark; a row's cells are found by its header's row of a table of (header, places)."""
        names = list(dict.fromkeys(n for h in headers for n in self.headers[h]))
        if not names:
            return self.spark.createDataFrame([], "platform_id string, _spatial boolean")
        places = [(h, (marks or {}).get(h, False), len(self.headers[h]), [self.headers[h].index(n) if n in self.headers[h] else None for n in names]) for h in headers]
        table = self.spark.createDataFrame(places, "header string, _spatial boolean, _many int, _places array<int>")
        own = self.rows.join(F.broadcast(table), "header").where(F.get("cells", F.col("_many")).isNull())
        kept = [n for n in names if n not in ("file", "platform_id")]
        cells = [F.get("cells", F.get("_places", F.lit(names.index(n)))).alias(n) for n in kept]
        return own.select(*cells, platform_of(F.col("file")).alias("platform_id"), "_spatial")


def _read(found: Headed, other: Callable[[list[str]], bool]) -> DataFrame:
    """Rows of files with standard positions, which must be numbers there, and of the files whose names ``other`` takes as they are."""
    spatial = {h: all(c in names for c in POSITION) for h, names in found.headers.items()}
    out = found.named([h for h, names in found.headers.items() if spatial[h] or other(names)], spatial)
    if any(spatial.values()):
        out = out.withColumns({c: F.col(c).try_cast("double") for c in POSITION}).where(~F.col("_spatial") | (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()))
    return out.drop("_spatial")


def read_csv_directory(spark: SparkSession, path: str | list[str], skip_non_spatial: bool = True) -> DataFrame:
    """Every CSV file under ``path`` as text columns by its own header, ``platform_id`` from the file's name; one scan for the headers and one for the rows.

    Files without latitude and longitude are left out, or with ``skip_non_spatial`` off kept; rows of the others need both as numbers."""
    return _read(Headed(spark, path), lambda names: not skip_non_spatial)


def read_validated(spark: SparkSession, path: str | list[str], allow_non_spatial: bool = False) -> DataFrame:
    """CSV and GeoCSV files of observations, each judged by its own header: it needs a position, under the standard names or those of a ship.

    Standard positions must be numbers; a ship's are left for the provider's names to settle. Rows without any value go."""
    out = _read(Headed(spark, path), lambda names: allow_non_spatial or all(c in names for c in SHIP_POSITION))
    return out.dropna("all", subset=[c for c in out.columns if c != "platform_id"]) if len(out.columns) > 1 else out


def read_geocsv(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows after the ``#`` block at the top of each file as text, and ``path``, ``file``, ``metadata`` (map of the block's keys; of a repeated key the last value)."""
    found = Headed(spark, path)
    data = found.named(list(found.headers)).drop("_spatial", "platform_id")
    lines = read_text(spark, path)
    top = lines.where(~F.ltrim("line").startswith("#")).groupBy("path").agg(F.min("line_no").alias("top"))
    pair = F.split(F.regexp_replace(F.trim("line"), r"^#\s*", ""), ":", 2)
    head = lines.where(F.ltrim("line").startswith("#") & F.col("line").contains(":")).join(top, "path", "left").where("top is null or line_no < top")
    head = head.groupBy("path", "file", F.trim(pair[0]).alias("k")).agg(F.max_by(F.trim(pair[1]), "line_no").alias("v"))
    return data, head.groupBy("path", "file").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("metadata"))


def numeric_share(df: DataFrame, skip: Sequence[str] = ()) -> dict[str, float]:
    """Share of all rows (NULLs count against) whose text casts to a number, in one pass."""
    names = [f.name for f in df.schema if f.dataType.simpleString() == "string" and f.name not in skip]
    if not names:
        return {}
    row = df.agg(*[F.avg(F.trim(f"`{c}`").try_cast("double").isNotNull().cast("double")).alias(c) for c in names]).first()
    return {c: row[c] or 0.0 for c in names}


def coerce_by_majority(df: DataFrame, least: float = 0.6, skip: Sequence[str] = ("latitude", "longitude", "time", "platform_id")) -> DataFrame:
    """Text columns become doubles where at least ``least`` of the rows cast (0.6 on reading, 0.5 on writing); ``time`` a timestamp."""
    share = numeric_share(df, skip)
    out = df.withColumns({c: F.trim(f"`{c}`").try_cast("double") for c, s in share.items() if s >= least})
    return out.withColumn("time", F.col("time").try_cast("timestamp")) if "time" in df.columns and dict(df.dtypes)["time"] == "string" else out


def union_all(frames: Sequence[DataFrame], ignore: Sequence[str] = ("platform_id",)) -> DataFrame:
    """Frames of drifting schemas as one; rows with nothing but ignored columns and columns with no value are dropped."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    out = out.dropna("all", subset=[c for c in out.columns if c not in ignore])
    row = out.agg(*[F.count(f"`{c}`").alias(c) for c in out.columns]).first()
    return out.drop(*[c for c in out.columns if not row[c]])


def read_units_csv(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From numbered lines of files whose second line holds units: data rows as ``file``, ``line_no``, ``fields`` (map), and the units of each file.

    Quoted cells may hold commas; short lines have NULLs and cells beyond the header are left out."""
    parts = lines.select("file", "line_no", csv_cells(F.col("line")).alias("f"))
    head = parts.groupBy("file").agg(F.min_by("f", F.when(F.col("line_no") == 0, 0)).alias("names"), F.min_by("f", F.when(F.col("line_no") == 1, 0)).alias("units"))
    data = parts.where("line_no > 1").join(head, "file").select("file", "line_no", named_cells(F.col("names"), F.col("f")).alias("fields"))
    return data, head.select("file", named_cells(F.col("names"), F.col("units")).alias("units"))


def first_snapshot(lines: DataFrame, renames: dict[str, str], site: tuple[float, float], text: Sequence[str] = ()) -> DataFrame:
    """The first data row of each file, columns renamed and but for time and ``text`` numbers, the site's position added; files without a time give no row.

    Quoted cells may hold commas; a short row has NULLs and cells beyond the header are left out."""
    parts = lines.select("file", "line_no", csv_cells(F.col("line")).alias("f"))
    row = parts.groupBy("file").agg(F.min_by("f", F.when(F.col("line_no") == 0, 0)).alias("names"), F.min_by("f", F.when(F.col("line_no") > 0, F.col("line_no"))).alias("v"))
    fields = named_cells(F.col("names"), F.col("v"))
    out = row.where("v is not null").select("file", *[blank_to_null(fields[a]).alias(b) for a, b in renames.items()], F.lit(site[0]).alias("latitude"), F.lit(site[1]).alias("longitude"))
    return out.withColumns({b: F.col(b).try_cast("double") for b in renames.values() if b != "time" and b not in text}).where("time is not null")


def normalise(df: DataFrame, renames: dict[str, str], codes: dict[str, dict[str, str]] | None = None, defaults: dict[str, object] | None = None) -> DataFrame:
    """Provider columns under canonical names, code lists mapped (unknown codes pass), fixed values for absent columns."""
    out = df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns and b not in df.columns})
    for column, table in (codes or {}).items():
        pairs = [F.lit(x) for kv in table.items() for x in kv]
        out = out.withColumn(column, F.coalesce(F.create_map(*pairs)[F.col(column)], F.col(column)))
    return out.withColumns({c: F.lit(v) for c, v in (defaults or {}).items() if c not in out.columns})


def valid_positions(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    own = df.withColumns({lat: F.col(lat).cast("string").try_cast("double"), lon: F.col(lon).cast("string").try_cast("double")})
    return own.where(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))


def typed(df: DataFrame) -> DataFrame:
    """``time`` to a timestamp, ``depth`` to a number, ids to text; what does not parse is NULL."""
    found: dict[str, Column] = {}
    if "time" in df.columns:
        found["time"] = F.col("time").try_cast("timestamp")
    if "depth" in df.columns:
        found["depth"] = F.col("depth").try_cast("double")
    found |= {c: F.col(c).cast("string") for c in ("platform_id", "campaign_id") if c in df.columns}
    return df.withColumns(found)


def units_mapping(names: Sequence[str], units_row: Sequence[str] | None = None, metadata: dict[str, str] | None = None, standard: dict[str, str] | None = None) -> dict[str, str]:
    """The unit of each column: from the row of units below a header or the ``field_unit`` list of a ``#`` block; standard units of columns that are there win."""
    given = list(units_row or [u for u in (metadata or {}).get("field_unit", "").split(",")])
    out = {n: u.strip() for n, u in zip(names, given, strict=False) if u.strip() and u.strip() != "(unitless)"}
    return out | {n: u for n, u in (standard or {}).items() if n in names}


def with_units(df: DataFrame, units: dict[str, str]) -> DataFrame:
    """Units as metadata of the columns, which Parquet keeps."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"units": units[c]}) if c in units else F.col(f"`{c}`") for c in df.columns])
