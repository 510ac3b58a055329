"""Joins on time: as-of, nearest and interpolated, by brackets of the fixes before and after each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bucketed import DAY_US, nearest_known, numbered, running_sums, with_bucket


def brackets(left: DataFrame, right: DataFrame, by: Sequence[str], cols: Sequence[str], time: str = "t", tie: str | None = None, bucket_us: int = DAY_US) -> DataFrame:
    """``left`` with ``before`` (last row of ``right`` at or before) and ``after`` (first at or after), structs of time and ``cols``.

    One union and one shuffle on (key, time bucket); of equal times in ``right`` the one of largest ``cols`` (``tie`` first) counts."""
    fix = F.struct(F.col(time).alias("t"), *([F.col(tie).alias("tie")] if tie else []), *cols)
    own = left.select(*by, F.col(time), F.struct("*").alias("row"), F.lit(None).cast(right.select(fix.alias("f")).schema["f"].dataType).alias("fix"))
    ref = right.where(F.col(time).isNotNull()).select(*by, F.col(time), F.lit(None).cast(own.schema["row"].dataType).alias("row"), fix.alias("fix"))
    both = with_bucket(own.unionByName(ref), time, bucket_us)
    both = both.withColumn("_side", F.col("fix").isNull().cast("int"))
    back = nearest_known(both, by, [time, "_side", "fix"], F.col("fix"), "before")
    ahead = nearest_known(back.withColumn("_side", 1 - F.col("_side")), by, [time, "_side", "fix"], F.col("fix"), "after", forward=True)
    return ahead.where("row is not null").select("row.*", "before", "after")


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], cols: Sequence[str], direction: str = "backward", tolerance_us: int | None = None, time: str = "t", tie: str | None = None, bucket_us: int = DAY_US) -> DataFrame:
    """``match``: the row of ``right`` that ``direction`` (backward, forward, nearest) picks, NULL beyond ``tolerance_us`` (inclusive). Exact ties of nearest go backward."""
    own = brackets(left, right, by, cols, time, tie, bucket_us)
    t, b, a = F.col(time), F.col("before"), F.col("after")
    near = F.when(a.isNull() | (t - b["t"] <= a["t"] - t), b).otherwise(a)
    match = {"backward": b, "forward": a, "nearest": near}[direction]
    if tolerance_us is not None:
        match = F.when(F.abs(t - match["t"]) <= tolerance_us, match)
    return own.withColumn("match", match).drop("before", "after")


def interpolated(left: DataFrame, right: DataFrame, by: Sequence[str], cols: Sequence[str], tolerance_us: int | None = None, time: str = "t", bucket_us: int = DAY_US) -> DataFrame:
    """Each of ``cols`` by time-weighted interpolation over its own non-NULL fixes; ends are held. With ``tolerance_us``, NULL where the nearer fix is farther."""
    # One union and one shuffle for all columns; each has its own brackets.
    fix = F.struct(F.col(time).alias("t"), *cols)
    own = left.select(*by, F.col(time), F.struct("*").alias("row"), F.lit(None).cast(right.select(fix.alias("f")).schema["f"].dataType).alias("fix"))
    ref = right.where(F.col(time).isNotNull()).select(*by, F.col(time), F.lit(None).cast(own.schema["row"].dataType).alias("row"), fix.alias("fix"))
    both = with_bucket(own.unionByName(ref), time, bucket_us)
    both = both.withColumns({"_side": F.col("fix").isNull().cast("int"), "_back": F.col("fix").isNotNull().cast("int")})
    out = {}
    for i, c in enumerate(cols):
        known = F.when(F.col(f"fix.`{c}`").isNotNull(), F.struct(F.col("fix.t").alias("t"), F.col(f"fix.`{c}`").alias("_v")))
        both = both.withColumn(f"_k{i}", known)
        both = nearest_known(both, by, [time, "_side", f"_k{i}"], F.col(f"_k{i}"), f"_before{i}")
        both = nearest_known(both, by, [time, "_back", f"_k{i}"], F.col(f"_k{i}"), f"_after{i}", forward=True)
        out[c] = between(F.col(time), F.col(f"_before{i}"), F.col(f"_after{i}"), tolerance_us)
    return both.where("row is not null").select(*[F.col(f"row.`{c}`").alias(c) for c in left.columns if c not in cols], *[v.alias(c) for c, v in out.items()])


def between(t: Column, before: Column, after: Column, tolerance_us: int | None = None) -> Column:
    """The value at ``t`` on the line through two fixes (structs t, _v); of one alone, its value."""
    span = after["t"] - before["t"]
    line = F.when(span > 0, before["_v"] + (after["_v"] - before["_v"]) * (t - before["t"]) / span).otherwise(before["_v"])
    value = F.coalesce(line, before["_v"], after["_v"])
    if tolerance_us is None:
        return value
    near = F.least(F.abs(t - before["t"]), F.abs(after["t"] - t))
    return F.when(near <= tolerance_us, value)


def interpolated_by_position(left: DataFrame, right: DataFrame, by: Sequence[str], cols: Sequence[str], time: str = "t") -> DataFrame:
    """Interpolation by row number among all distinct times of both sides, ends held (kept for comparison with time weights)."""
    times = left.select(*by, time).unionByName(right.select(*by, time)).distinct()
    place = numbered(times, by, [time], "_p")
    own, ref = left.join(place, [*by, time]), right.join(place, [*by, time])
    return interpolated(own, ref, by, cols, time="_p", bucket_us=1 << 20).drop("_p")


def extrapolated(left: DataFrame, right: DataFrame, by: Sequence[str], col: str, time: str = "t", bucket_us: int = DAY_US) -> DataFrame:
    """As ``interpolated``, but beyond the ends on the line through the two outer fixes; a single fix is held both ways."""
    ref = right.where(F.col(col).isNotNull()).select(*by, time, F.col(col).alias("_v"))
    at = F.struct(F.col(time).alias("t"), "_v")
    ends = ref.groupBy(*by).agg(F.min_by(at, F.struct(time, "_v")).alias("_first"), F.max_by(at, F.struct(time, "_v")).alias("_last"))
    inner = ref.join(ends, list(by))
    second = inner.groupBy(*by).agg(F.min_by(at, F.when(F.col(time) > F.col("_first.t"), F.struct(time, "_v"))).alias("_second"), F.max_by(at, F.when(F.col(time) < F.col("_last.t"), F.struct(time, "_v"))).alias("_inner"))
    own = brackets(left, ref, by, ["_v"], time, None, bucket_us).join(ends, list(by), "left").join(second, list(by), "left")

    def line(p: Column, q: Column, end: Column) -> Column:
        return F.coalesce(p["_v"] + (q["_v"] - p["_v"]) * (F.col(time) - p["t"]) / (q["t"] - p["t"]), end["_v"])

    first, last = F.col("_first"), F.col("_last")
    value = F.when(F.col("before").isNull(), line(first, F.col("_second"), first)).when(F.col("after").isNull(), line(F.col("_inner"), last, last)).otherwise(between(F.col(time), F.col("before"), F.col("after")))
    return own.withColumn(col, value).drop("before", "after", "_first", "_last", "_second", "_inner")


def first_source(left: DataFrame, sources: Sequence[tuple[str, DataFrame, int | None]], by: Sequence[str], cols: Sequence[str], time: str = "t") -> DataFrame:
    """``cols`` from the first source that has a row near enough in time, and ``source``, its name."""
    out, picks = left, []
    for name, right, tolerance in sources:
        out = asof(out, right, by, cols, "nearest", tolerance, time).withColumnRenamed("match", f"_{name}")
        picks.append((name, F.col(f"_{name}")))
    source = F.coalesce(*[F.when(m.isNotNull(), F.lit(n)) for n, m in picks])
    return out.select(*left.columns, *[F.coalesce(*[m[c] for _, m in picks]).alias(c) for c in cols], source.alias("source"))


def mean_before(left: DataFrame, right: DataFrame, by: Sequence[str], cols: Sequence[str], span_us: int, time: str = "t", bucket_us: int = DAY_US) -> DataFrame:
    """Rows of ``left`` with the means of ``cols`` over the rows of ``right`` in the ``span_us`` up to each (both ends count); NULL where there is none.

    Time is cut into spans: what a row asks for is the end of the span before and the beginning of its own, a running sum each, worked out in buckets of
    ``bucket_us``. No sums of long histories are subtracted, and no series sits in one task."""
    sums = {f"_s{i}": F.coalesce(F.col(f"_v.{c}").cast("double"), F.lit(0.0)) for i, c in enumerate(cols)} | {f"_n{i}": F.col(f"_v.{c}").isNotNull().cast("long") for i, c in enumerate(cols)}
    rows = right.select(*by, F.col(time).alias("_t"), F.struct(*cols).alias("_v"))
    out = left.withColumn("_row", F.struct("*"))

    def running(own: DataFrame, at: Column, ahead: bool, names: str) -> DataFrame:
        """The sums of the rows of ``right`` in the span of ``at``, up to it (``ahead``: from it on)."""
        sign = -1 if ahead else 1
        asked = own.select(*by, at.alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(rows.schema["_v"].dataType).alias("_v"), F.struct("*").alias("_own"))
        both = rows.select(*by, "_t", F.lit(0).alias("_kind"), "_v", F.lit(None).cast(asked.schema["_own"].dataType).alias("_own")).unionByName(asked)
        both = both.withColumns({"_span": F.floor(F.col("_t") / span_us), "_o": F.col("_t") * sign})
        both = running_sums(with_bucket(both, "_o", bucket_us), [*by, "_span"], ["_o", "_kind"], {names + name: value for name, value in sums.items()})
        return both.where("_kind = 1").select("_own.*", *[names + name for name in sums])

    out = running(out.select(*by, F.col(time).alias("_at"), "_row"), F.col("_at"), False, "_p")
    out = running(out, F.col("_at") - span_us, True, "_q")
    mean = lambda i: (F.col(f"_p_s{i}") + F.col(f"_q_s{i}")) / F.nullif(F.col(f"_p_n{i}") + F.col(f"_q_n{i}"), F.lit(0))
    return out.select("_row.*", *[mean(i).alias(c) for i, c in enumerate(cols)])


def with_fallback(left: DataFrame, in_situ: DataFrame, model: DataFrame, by: Sequence[str], cols: Sequence[str], tolerance_us: int, span_us: int = 10 * DAY_US, time: str = "t") -> DataFrame:
    """``cols`` of the nearest in-situ row within ``tolerance_us``, else the model's means over the ``span_us`` before; ``source`` says which, or ``none``."""
    own = asof(left, in_situ, by, cols, "nearest", tolerance_us, time)
    model = model.select(*by, time, *[F.col(c).alias(f"_m_{c}") for c in cols])
    own = mean_before(own, model, by, [f"_m_{c}" for c in cols], span_us, time)
    some = F.coalesce(*[F.col(f"_m_{c}") for c in cols]).isNotNull()
    source = F.when(F.col("match").isNotNull(), "in_situ").when(some, "model_mean").otherwise("none")
    return own.select(*left.columns, *[F.when(F.col("match").isNotNull(), F.col(f"match.{c}")).otherwise(F.col(f"_m_{c}")).alias(c) for c in cols], source.alias("source"))
