"""Descriptions of a data set: extents, statistics, rosters, pivots."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import category_of


def measurement_statistics(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """min, max, mean, count and valid percent of each column, a row each; one pass."""
    own = df.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot([], list(measures), "variable", "value")
    return own.groupBy("variable").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.count("value").alias("n_valid"), (100 * F.count("value") / F.count("*")).alias("valid_percent"))


def report(df: DataFrame, time: str = "t", day_us: int = 86_400_000_000) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"), F.floor((F.max(time) - F.min(time)) / day_us).alias("days"), F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"),
        F.countDistinct("platform").alias("n_platforms"), F.countDistinct(F.floor("lat"), F.floor("lon")).alias("n_bins"),
    )


def dataset_report(df: DataFrame, measures: Sequence[str], time: str = "t", platform: str = "platform") -> DataFrame:
    """A report as rows of ``section``, ``name``, ``n``, ``low``, ``high``, ``mean`` and ``percent``: rows, days and box of all (``overall``), rows of each platform, valid values of each
    measure, and measures of each category. Two aggregates over the data; the rows are as many as platforms, measures and categories."""
    number = lambda c: F.col(c).cast("double")
    row = lambda section, name, n, low, high, mean, percent: F.struct(
        F.lit(section).alias("section"), (F.lit(name) if isinstance(name, str) else name).alias("name"), n.cast("long").alias("n"),
        low.cast("double").alias("low"), high.cast("double").alias("high"), mean.cast("double").alias("mean"), percent.cast("double").alias("percent"))
    none, all_ = F.lit(None), F.count("*")
    parts = [row("overall", c, F.count(c), F.min(number(c)), F.max(number(c)), none, 100 * F.count(c) / F.greatest(all_, F.lit(1))) for c in (time, "lat", "lon")]
    parts += [row("variable", m, F.count(number(m)), F.min(number(m)), F.max(number(m)), F.avg(number(m)), 100 * F.count(number(m)) / F.greatest(all_, F.lit(1))) for m in measures]
    whole = df.agg(F.array(row("overall", "rows", all_, none, none, none, none), *parts).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    by = df.groupBy(F.col(platform).cast("string").alias("_p")).agg(F.count("*").alias("_k"), F.min(number(time)).alias("_lo"), F.max(number(time)).alias("_hi"))
    by = by.select(row("platform", F.coalesce("_p", F.lit("none")), F.col("_k"), F.col("_lo"), F.col("_hi"), none, none).alias("r")).select("r.*")
    kinds = df.sparkSession.createDataFrame([(m,) for m in measures], "m string").groupBy(category_of(F.col("m")).alias("_c")).agg(F.count("*").alias("_k"))
    return whole.unionByName(by).unionByName(kinds.select(row("category", F.col("_c"), F.col("_k"), none, none, none, none).alias("r")).select("r.*"))


def report_markdown(report: DataFrame, title: str) -> DataFrame:
    """``place`` and ``value``: the report's lines in order, a table for each section. The report is small by construction."""
    order = F.array_position(F.array(*[F.lit(x) for x in ("overall", "platform", "variable", "category")]), F.col("section"))
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    lines = report.select(order.alias("a"), F.lit(3).alias("b"), "name", F.concat(F.lit("| "), F.concat_ws(" | ", "name", *[cell(c) for c in ("n", "low", "high", "mean", "percent")]), F.lit(" |")).alias("value"))
    head = report.select("section", order.alias("a")).distinct()
    heads = head.select("a", F.posexplode(F.array(F.concat(F.lit("## "), F.initcap("section")), F.lit("| name | n | low | high | mean | percent |"), F.lit("|-|-|-|-|-|-|"))).alias("b", "value")).select("a", "b", F.lit("").alias("name"), "value")
    top = report.sparkSession.createDataFrame([(0, 0, "", f"# {title}")], "a long, b int, name string, value string")
    return top.unionByName(heads).unionByName(lines).select(F.struct("a", "b", "name").alias("place"), "value")


def extents(df: DataFrame, keys: Sequence[str], time: str = "t") -> DataFrame:
    """Position and time extent overall and for each key, in one pass; ``level`` 0 is a key's, the rest overall."""
    own = df.groupingSets([[F.col(k) for k in keys], []], *keys) if keys else df.groupBy()
    out = own.agg(F.grouping_id().alias("level"), F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"), F.min(time).alias("t0"), F.max(time).alias("t1"), F.count("*").alias("n"))
    return out


def grid_suggestion(df: DataFrame, step: float = 2.0, clamp_lat: float | None = None, margin: float = 1.0) -> DataFrame:
    """Outward-rounded edges around the data; ``clamp_lat`` limits latitude unless that leaves nothing."""
    own = df.agg(*[(F.min(c) - margin).alias(f"{c}0") for c in ("lat", "lon")], *[(F.max(c) + margin).alias(f"{c}1") for c in ("lat", "lon")])
    if clamp_lat is not None:
        lo, hi = F.greatest("lat0", F.lit(-clamp_lat)), F.least("lat1", F.lit(clamp_lat))
        own = own.withColumns({"lat0": F.when(lo < hi, lo).otherwise(F.col("lat0")), "lat1": F.when(lo < hi, hi).otherwise(F.col("lat1"))})

    def edges(c: str, limit: float):
        lo, hi = F.greatest(F.floor(F.col(f"{c}0") / step) * step, F.lit(-limit)), F.least(F.ceil(F.col(f"{c}1") / step) * step, F.lit(limit))
        return F.transform(F.sequence(F.lit(0), F.round((hi - lo) / step).cast("int")), lambda i: lo + i * step).alias(f"{c}_edges")

    return own.select(edges("lat", 90.0), edges("lon", 180.0))


def roster(df: DataFrame) -> DataFrame:
    return df.groupBy("platform").agg(F.count("*").alias("n_rows"), F.min("campaign_id").alias("campaign_id"))


def pivot_quality(df: DataFrame, index: Sequence[str], variables: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Long to wide: of each variable the first value and its quality flag; rows with a NULL key are left out."""
    own = df
    for c in index:
        own = own.where(F.col(c).isNotNull())
    place = F.struct(*order)
    out = []
    for v in variables:
        hit = F.when(F.col("variable") == v, place)
        out += [F.min_by("value", hit).alias(v), F.min_by("value_qc", hit).alias(f"{v}_qc")]
    return own.groupBy(*index).agg(*out)


# Columns of every table that are no measurements, and patterns of names (whole, any case) that repeat others or vary them.
SYSTEM_COLUMNS = ("time", "latitude", "longitude", "geometry", "platform_id", "campaign_id", "trajectory", "lat_bin", "lon_bin")
LEFT_OUT = (r".*_STDDEV", r".*_STD", r".*_MIN", r".*_MAX", r".*_PEAK", r"UWND_.*", r"VWND_.*", r"WWND_.*", r".*_WING_.*", r"WING_.*", r"HDG", r"SOG", r"COG")


def measurement_columns(df: DataFrame, system: Sequence[str] = SYSTEM_COLUMNS, exclude: Sequence[str] = LEFT_OUT) -> list[str]:
    """Columns that hold measurements, sorted: none of the system's, none all in lower case, and no name that a pattern fits as a whole. Schema only."""
    return sorted(c for c in df.columns if c not in system and not c.islower() and not any(re.fullmatch(p, c, re.IGNORECASE) for p in exclude))


def top_variables(names: Sequence[str], priority: Sequence[str], most: int) -> list[str]:
    """Those on the priority list in its order, then the rest as they come."""
    first = [p for p in priority if p in names]
    return [*first, *[n for n in names if n not in first]][:most]


def by_day_window(df: DataFrame, time: str, days: int, category: str) -> DataFrame:
    """``window_start``, ``category`` and ``n``: rows of each window of ``days`` days, counted from the first day of year 1, and category."""
    day = F.to_date(time)
    start = F.date_sub(day, F.pmod(F.datediff(day, F.lit("0001-01-01").cast("date")), F.lit(days)).cast("int"))
    return df.groupBy(start.alias("window_start"), F.col(category).alias("category")).agg(F.count("*").alias("n"))


def inspection(df: DataFrame, keys: Sequence[str], time: str = "t", day: str = "day") -> DataFrame:
    """Rows, columns, time span and days of each campaign."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.min(time).alias("t0"), F.max(time).alias("t1"), F.countDistinct(day).alias("n_days"))
