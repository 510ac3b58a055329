"""Instrument text logs as column expressions over numbered lines; no parsing function for each row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOT_MS = 0.514444
SENTENCE = r"^(\S+)\s+\$(?:[A-Z]{2})(GGA|RMC|GNS|VTG|ZDA),"


def checksum_holds(sentence: Column) -> Column:
    """Whether the XOR of the bytes between ``$`` and ``*`` is the two hex digits after it; TRUE without any."""
    body, given = F.regexp_extract(sentence, r"\$([^*]*)", 1), F.regexp_extract(sentence, r"\*([0-9A-Fa-f]{2})", 1)
    codes = F.transform(F.split(body, ""), lambda c: F.ascii(c))
    total = F.aggregate(codes, F.lit(0), lambda a, x: a.bitwiseXOR(x))
    return (given == "") | (F.lpad(F.hex(total), 2, "0") == F.upper(given))


def _degrees(value: Column, side: Column) -> Column:
    """ddmm.mmm with a hemisphere to signed degrees."""
    x = value.try_cast("double")
    whole = F.floor(x / 100)
    return (whole + (x - whole * 100) / 60) * F.when(side.isin("S", "W"), -1).otherwise(1)


def read_nmea(lines: DataFrame, sentence_types: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """One row for each sentence of lines ``<ISO time> <sentence>``: position, quality, speed (m/s), course, UTC clock."""
    kind = F.regexp_extract("line", SENTENCE, 2)
    own = lines.where(F.col("line").rlike(SENTENCE)).withColumn("kind", kind).withColumn("f", F.split(F.regexp_replace(F.regexp_replace("line", r"^\S+\s+", ""), r"\*.*$", ""), ","))
    if sentence_types:
        own = own.where(F.col("kind").isin(*sentence_types))
    if strict:
        own = own.where(checksum_holds(F.col("line")))

    def at(**where: int) -> Column:
        out = F.lit(None).cast("string")
        for k, i in where.items():
            out = F.when(F.col("kind") == k, F.get("f", F.lit(i))).otherwise(out)
        return F.nullif(out, F.lit(""))

    num = lambda **w: at(**w).try_cast("double")
    clock = F.when(F.col("kind") == "ZDA", F.concat_ws("-", at(ZDA=4), at(ZDA=3), at(ZDA=2), at(ZDA=1)))
    out = own.select(
        "file", "line_no", F.regexp_extract("line", r"^(\S+)", 1).try_cast("timestamp").alias("time"), "kind",
        _degrees(at(GGA=2, GNS=2, RMC=3), at(GGA=3, GNS=3, RMC=4)).alias("latitude"), _degrees(at(GGA=4, GNS=4, RMC=5), at(GGA=5, GNS=5, RMC=6)).alias("longitude"),
        num(GGA=6).alias("quality"), num(GGA=7, GNS=7).alias("satellites"), num(GGA=8, GNS=8).alias("hdop"), num(GGA=9, GNS=9).alias("height"),
        (num(RMC=7, VTG=5) * KNOT_MS).alias("speed_ms"), num(RMC=8, VTG=1).alias("course"), clock.alias("gps_utc"),
    )
    whole = F.when(F.col("kind").isin("GGA", "GNS", "RMC"), F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).otherwise(True)
    return out.where(F.col("time").isNotNull() & whole)


def merge_sentences(rows: DataFrame, keys: Sequence[str] = ("file", "time"), order: str = "line_no") -> DataFrame:
    """One row for each time: of every field the last value known."""
    fields = [c for c in rows.columns if c not in (*keys, order, "kind")]
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields])


def nmea_files(lines: DataFrame, leading: int = 50) -> DataFrame:
    """``file``, ``is_nmea``: whether any of a file's leading lines holds a sentence."""
    return lines.where(F.col("line_no") < leading).groupBy("file").agg(F.max(F.col("line").rlike(r"\$[A-Z]{2}(GGA|RMC|GNS|VTG|ZDA),")).alias("is_nmea"))


def read_sound_velocity(lines: DataFrame) -> DataFrame:
    """``MM/DD/YYYY,HH:MM:SS.sss,v``; fewer parts or no number, and the line goes."""
    f = F.split("line", ",")
    own = lines.where(F.size(f) >= 3).select("file", "line_no", F.try_to_timestamp(F.concat_ws(" ", F.trim(f[0]), F.trim(f[1])), F.lit("MM/dd/yyyy HH:mm:ss[.SSS]")).alias("time"), F.trim(f[2]).try_cast("double").alias("velocity"))
    return own.dropna("any", subset=["time", "velocity"])


def read_fluorometer(lines: DataFrame) -> DataFrame:
    """A comma pair, then a tab record of date, clock and three values, NULs removed; all kept as text."""
    f = F.split(F.regexp_replace("line", "\\x00", ""), ",", 3)
    own = lines.where(F.size(f) == 3).select("file", "line_no", F.trim(f[0]).alias("date"), F.trim(f[1]).alias("clock"), F.split(F.trim(f[2]), "\t").alias("r"))
    return own.where(F.size("r") == 5).select("file", "line_no", "date", "clock", *[F.col("r")[i].alias(n) for i, n in enumerate(("sensor_date", "sensor_clock", "value_1", "value_2", "value_3"))])


def read_winch(lines: DataFrame) -> DataFrame:
    """Log time, control characters, device, device time and readings; wire out in metres."""
    rx = r"^(\S+Z)\s[\x01-\x1f]*(\w+),([^,]+),([-+]?\d+),([-+]?\d+),([-+]?[\d.]+),(\d+)"
    g = lambda i: F.regexp_extract("line", rx, i)
    return lines.where(F.col("line").rlike(rx)).select("file", "line_no", g(1).try_cast("timestamp").alias("time"), g(2).alias("device"), g(3).alias("device_time"), (g(4).try_cast("double") / 1000).alias("wire_out_m"), g(5).try_cast("double").alias("speed"), g(6).try_cast("double").alias("tension"), g(7).alias("check"))


def read_cnv(lines: DataFrame) -> DataFrame:
    """``file``, ``row``, ``name``, ``value``: the named columns of whitespace rows after ``*END*``, long form (pivot by known names)."""
    rx = r"^#\s*name\s+(\d+)\s*=\s*([^:]+):"
    head = lines.where(F.col("line").rlike(rx)).select("file", F.regexp_extract("line", rx, 1).cast("int").alias("i"), F.trim(F.regexp_extract("line", rx, 2)).alias("name"))
    end = lines.where(F.col("line").startswith("*END*")).groupBy("file").agg(F.min("line_no").alias("end"))
    data = lines.join(end, "file").where(F.col("line_no") > F.col("end")).select("file", (F.col("line_no") - F.col("end") - 1).alias("row"), F.posexplode(F.split(F.trim("line"), r"\s+")).alias("i", "v"))
    return data.join(head, ["file", "i"]).select("file", "row", "name", F.col("v").try_cast("double").alias("value"))


def key_values(lines: DataFrame) -> DataFrame:
    """``file``, ``pairs``: a map of ``key: value`` lines, split at the first colon; later lines win."""
    f = F.split("line", ":", 2)
    own = lines.where(F.size(f) == 2).select("file", F.lower(F.trim(f[0])).alias("k"), F.trim(f[1]).alias("v"), "line_no")
    own = own.groupBy("file", "k").agg(F.max_by("v", "line_no").alias("v"))
    return own.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("pairs"))


def pick(pairs: Column, *names: str) -> Column:
    return F.coalesce(*[pairs[n] for n in names])


#: Text jobs by sensor type; each turns numbered lines into rows.
PROCESSORS: dict[str, Callable[[DataFrame], DataFrame]] = {"gnss": read_nmea, "ssv": read_sound_velocity, "fluorometer": read_fluorometer, "winch": read_winch, "ctd": read_cnv}


def register_processor(sensor: str, job: Callable[[DataFrame], DataFrame]) -> None:
    PROCESSORS[sensor] = job
