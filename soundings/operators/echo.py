"""Noise, seabed and schools on echo samples: long rows (channel, ping_idx, sample_idx, depth, sv), masks as columns."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import WindowSpec

from ..functions.acoustics import time_varied_gain, to_db, to_linear
from ..session import staged
from .bucketed import DAY_US, by_runs, in_frames, nearest_known, with_bucket

PING, SAMPLE = "ping_idx", "sample_idx"


#: Pings of a block: series over pings are worked out block by block, with as many pings beside it as a frame reaches.
PINGS = 4096


def _median_of(value: str, half: int) -> Callable[[WindowSpec], Column]:
    return lambda w: F.percentile(value, F.lit(0.5)).over(w.rowsBetween(-half, half))


def along_pings(keys: Sequence[str] = ("channel", SAMPLE)) -> Window:
    return Window.partitionBy(*keys).orderBy(PING)


def along_samples(keys: Sequence[str] = ("channel", PING)) -> Window:
    return Window.partitionBy(*keys).orderBy(SAMPLE)


def band_statistics(samples: DataFrame, low: float, high: float) -> DataFrame:
    """Median and 75th percentile of Sv between two depths, for each ping and channel."""
    band = F.when(F.col("depth").between(low, high), F.col("sv"))
    return samples.groupBy("channel", PING).agg(F.percentile(band, F.lit(0.5)).alias("p50"), F.percentile(band, F.lit(0.75)).alias("p75"))


def attenuated_pings(samples: DataFrame, low: float, high: float, half: int = 15, below_db: float = 6, block: int = PINGS) -> DataFrame:
    """Pings whose band median lies more than ``below_db`` under the median of a full centred block; others near the ends are ``unfeasible``."""
    per = band_statistics(samples, low, high)
    own = in_frames(per, ["channel"], PING, half, {"block": _median_of("p50", half), "_k": lambda w: F.count("p50").over(w.rowsBetween(-half, half))}, block, PINGS)
    own = own.withColumn("_full", F.col("_k") == 2 * half + 1)
    return own.select("channel", PING, "p50", "block", F.coalesce(F.col("_full") & (F.col("p50") - F.col("block") < -below_db), F.lit(False)).alias("attenuated"), (~F.col("_full")).alias("unfeasible"))


def impulse_mask(samples: DataFrame, lags: Sequence[int] = (1,), over_db: float = 10, pool: int = 1, votes: int = 1) -> DataFrame:
    """Samples louder than both neighbours at a lag by more than ``over_db``, for ``votes`` of the lags. Missing neighbours count as silent; edge pings never, they are ``impulse_unfeasible``."""
    own = samples
    if pool > 1:
        own = own.withColumn("_v", to_db(F.avg(to_linear(F.col("sv"))).over(Window.partitionBy("channel", PING, F.floor(F.col(SAMPLE) / pool)))))
    else:
        own = own.withColumn("_v", F.col("sv"))
    w, silent = along_pings(), F.lit(-1e9)
    hits = F.lit(0)
    for k in lags:
        back, ahead = F.coalesce(F.lag("_v", k).over(w), silent), F.coalesce(F.lead("_v", k).over(w), silent)
        hits = hits + ((F.col("_v") - back > over_db) & (F.col("_v") - ahead > over_db)).cast("int")
    most = max(lags)
    span = samples.groupBy("channel").agg((F.min(PING) + most).alias("_first"), (F.max(PING) - most).alias("_last"))  # a row for each channel
    own = own.withColumn("_hits", hits).join(span, "channel", "left")  # an inner join may broadcast the samples
    inner = F.coalesce(F.col(PING).between(F.col("_first"), F.col("_last")), F.lit(False))
    return own.withColumns({"impulse": F.coalesce((F.col("_hits") >= votes) & inner, F.lit(False)), "impulse_unfeasible": ~inner}).drop("_v", "_hits", "_first", "_last")


def transient_below(samples: DataFrame, deep: tuple[float, float], step_m: float, half: int = 5, over_db: float = 3, until_db: float = 1, exclude_above: float = 250, block: int = PINGS) -> DataFrame:
    """Pings with a loud deep band lose their samples from the depth where, going up, the excess over the block falls below ``until_db``."""
    per = band_statistics(samples, *deep).select("channel", PING, "p50")
    loud = in_frames(per, ["channel"], PING, half, {"block": _median_of("p50", half)}, block, PINGS).where(F.col("p50") - F.col("block") > over_db).select("channel", PING)
    step = samples.where((F.col("depth") >= exclude_above) & (F.col("depth") <= deep[1])).groupBy("channel", PING, F.floor(F.col("depth") / step_m).alias("s")).agg(F.percentile("sv", F.lit(0.5)).alias("m"))
    step = in_frames(step, ["channel", "s"], PING, half, {"_around": _median_of("m", half)}, block, PINGS)
    step = step.withColumn("excess", F.col("m") - F.col("_around")).join(loud, ["channel", PING], "left_semi")
    calm = step.where(F.col("excess") < until_db).groupBy("channel", PING).agg(((F.max("s") + 1) * step_m).alias("from"))
    cut = loud.join(calm, ["channel", PING], "left").select("channel", PING, F.coalesce("from", F.lit(float(exclude_above))).alias("_from"))
    own = samples.join(cut, ["channel", PING], "left")
    return own.withColumn("transient", F.coalesce((F.col("depth") >= F.col("_from")) & (F.col("depth") >= exclude_above), F.lit(False))).drop("_from")


def _over_quantile(grid: np.ndarray, pings: int, depth: int, share: float, over_db: float) -> np.ndarray:
    """Cells over the ``share`` quantile of their centred block by more than ``over_db``; FALSE where the block is cut off or has a missing cell.

    How many cells of a block are that much lower tells nearly all; where the quantile lies between two that straddle the limit it is worked out."""
    shape, size = grid.shape, (2 * pings + 1, 2 * depth + 1)
    out = np.zeros(shape, bool)
    if shape[0] < size[0] or shape[1] < size[1]:
        return out
    inner = out[pings : shape[0] - pings, depth : shape[1] - depth]
    middle, n = grid[pings : shape[0] - pings, depth : shape[1] - depth], size[0] * size[1]
    asked = np.ones(middle.shape, bool)
    if np.isfinite(grid).all():
        k, limit = int(share * (n - 1)), middle * 10 ** (-(over_db + 1e-9) / 10)
        counts = []
        for edge in (limit * (1 - 1e-12), limit * (1 + 1e-12)):
            lower = np.zeros(middle.shape, np.uint16)
            for i in range(size[0]):
                for j in range(size[1]):
                    lower += grid[i : i + middle.shape[0], j : j + middle.shape[1]] < edge
            counts.append(lower)
        inner[:] = counts[0] >= min(k + 2, n)
        asked = ~inner & (counts[1] > k)
    rows, cols = np.nonzero(asked)
    view = np.lib.stride_tricks.sliding_window_view(grid, size)
    step = max(1, (8 << 20) // n)  # so that the copies of all windows stay under some 64 MB
    for at in range(0, len(rows), step):
        r, c = rows[at : at + step], cols[at : at + step]
        floor = 10 * np.log10(np.quantile(view[r, c].reshape(len(r), -1), share, axis=-1))
        inner[r, c] = 10 * np.log10(middle[r, c]) - floor > over_db + 1e-9
    return out


def transient_block(samples: DataFrame, pings: int = 5, depth: int = 3, share: float = 0.15, over_db: float = 6, below_m: float = 250, block: int = 200, beside: DataFrame | None = None) -> DataFrame:
    """Samples over the ``share`` quantile of their centred ping x sample block by more than ``over_db``; a full block is needed.

    Two-dimensional frames have no built-in form: blocks of pings with a halo go to an Arrow kernel, one for each channel and block. ``beside`` has one row for
    a channel and ping, or none; its other columns are added to the ping's samples. It travels with them: a join would move every sample once more."""
    b = F.floor(F.col(PING) / block)
    low, high = F.floor((F.col(PING) - pings) / block), F.floor((F.col(PING) + pings) / block)
    ids = F.when(low == high, F.array(b)).otherwise(F.array_distinct(F.array(low, b, high)))
    dealt, result = samples.withColumn("_b", F.explode(ids)), samples.withColumn("transient", F.lit(False))
    more = [] if beside is None else [f for f in beside.schema if f.name not in ("channel", PING)]
    if more:
        result = result.withColumns({f.name: F.lit(None).cast(f.dataType) for f in more})
        own = [f for f in samples.schema if f.name not in ("channel", PING)]
        kinds = dict(zip(samples.columns, samples.schema, strict=True))
        rows = beside.where("channel is not null").select(
            *[F.col(c).cast(kinds[c].dataType).alias(c) for c in ("channel", PING)], *[F.lit(None).cast(f.dataType).alias(f.name) for f in own], b.alias("_b"), F.lit(True).alias("_beside"), *[f.name for f in more]
        )
        dealt = dealt.withColumns({"_beside": F.lit(False)} | {f.name: F.lit(None).cast(f.dataType) for f in more}).unionByName(rows)

    def mask(rows: pa.Table) -> pa.Table:
        values = None
        if more:
            other = rows.column("_beside")
            values = rows.filter(other).select([PING, *[f.name for f in more]]).sort_by(PING)
            rows = rows.filter(pc.invert(other)).drop_columns(["_beside", *[f.name for f in more]])
        if not rows.num_rows:  # only pings of ``beside``
            return empty.empty_table()
        at_ping, at_sample, sv, depths = (rows.column(c).to_numpy() for c in (PING, SAMPLE, "sv", "depth"))
        p, s = at_ping - at_ping.min(), at_sample - at_sample.min()
        grid = np.full((p.max() + 1, s.max() + 1), np.nan)
        grid[p, s] = 10 ** (sv.astype(float) / 10)
        hit = _over_quantile(grid, pings, depth, share, over_db)[p, s] & (depths >= below_m)
        own = at_ping // block == rows.column("_b").to_numpy()
        out = rows.drop_columns("_b").append_column("transient", pa.array(hit)).filter(pa.array(own))
        if values is not None:
            known, asked = values.column(PING).to_numpy(), at_ping[own]
            at = np.searchsorted(known, asked)
            found = at < len(known)
            found[found] = known[at[found]] == asked[found]
            take = pa.array(np.where(found, at, 0), mask=~found)
            for f in more:
                out = out.append_column(f.name, values.column(f.name).take(take))
        return out

    empty = to_arrow_schema(result.schema)
    # The kernel carries all columns: a join with its flags would move every sample twice more.
    return dealt.groupBy("channel", "_b").applyInArrow(mask, result.schema)


def background_noise(samples: DataFrame, alpha: Column, pings: int = 50, ranges: int = 20, share: float | None = None, most_db: float = -125) -> DataFrame:
    """Noise of each block of pings: gain taken off, mean linear power by block, then the least (or a quantile) over range, capped."""
    power = F.col("sv") - time_varied_gain(F.col("depth"), alpha)
    cell = samples.select("channel", F.floor(F.col(PING) / pings).alias("ping_block"), F.floor(F.col(SAMPLE) / ranges).alias("range_block"), to_linear(power).alias("p"))
    cell = cell.groupBy("channel", "ping_block", "range_block").agg(to_db(F.avg("p")).alias("p"))
    floor = F.min("p") if share is None else F.percentile("p", F.lit(share))
    return cell.groupBy("channel", "ping_block").agg(F.least(floor, F.lit(float(most_db))).alias("noise"))


def subtract_noise(samples: DataFrame, noise: DataFrame, alpha: Column, pings: int = 50, snr_db: float = 3) -> DataFrame:
    """``sv_clean`` (NULL where nothing is left) and ``low_snr``; each ping takes its block's noise with the gain put back."""
    own = samples.withColumn("ping_block", F.floor(F.col(PING) / pings)).join(noise, ["channel", "ping_block"], "left")
    return _less_noise(own, alpha, snr_db).drop("ping_block")


def _less_noise(own: DataFrame, alpha: Column, snr_db: float) -> DataFrame:
    """``sv_clean`` and ``low_snr`` of samples that have their ``noise``."""
    level = F.col("noise") + time_varied_gain(F.col("depth"), alpha)
    clean = to_db(to_linear(F.col("sv")) - to_linear(level))
    return own.withColumn("sv_clean", clean).withColumn("low_snr", F.coalesce(F.col("sv_clean") - level < snr_db, F.lit(True)))


def median_3x3(samples: DataFrame, value: str = "sv", name: str = "sv_median") -> DataFrame:
    """Median of a cell and its eight neighbours; edges are reflected onto the edge cell itself. NULL counts as more than any value.

    Each cell is put in order with its neighbours in the ping; the median of nine is then that of the greatest least, the middle of the middles and the least greatest of three pings."""
    ws, wp = along_samples(), along_pings()
    kind = dict(samples.dtypes)[value]
    if kind not in ("double", "float"):  # no value to stand for NULL that sorts last
        side = F.array(F.coalesce(F.lag(value).over(ws), F.col(value)), F.col(value), F.coalesce(F.lead(value).over(ws), F.col(value)))
        own = samples.withColumn("_col", side)
        nine = F.concat(F.coalesce(F.lag("_col").over(wp), F.col("_col")), F.col("_col"), F.coalesce(F.lead("_col").over(wp), F.col("_col")))
        return own.withColumn(name, F.element_at(F.array_sort(nine), 5)).drop("_col")
    nan = F.lit(float("nan")).cast(kind)
    # As NaN, which is the greatest of all; ``_k`` counts how many are NULL.
    own = samples.withColumns({"_v": F.coalesce(value, nan), "_k": F.col(value).isNull().cast("int")})

    def beside(c: str, w: WindowSpec) -> tuple[Column, Column, Column]:
        return F.coalesce(F.lag(c).over(w), F.col(c)), F.col(c), F.coalesce(F.lead(c).over(w), F.col(c))

    def middle(a: Column, b: Column, c: Column) -> Column:
        return F.greatest(F.least(a, b), F.least(F.greatest(a, b), c))

    own = own.withColumns({f"_v{i}": x for i, x in enumerate(beside("_v", ws))} | {"_k": sum(beside("_k", ws), F.lit(0))})
    three = [F.col(f"_v{i}") for i in range(3)]
    own = own.withColumns({"_lo": F.least(*three), "_mid": middle(*three), "_hi": F.greatest(*three)})
    around = {f"{c}{i}": x for c in ("_lo", "_mid", "_hi", "_k") for i, x in enumerate(beside(c, wp))}
    own = own.withColumns(around)
    of = lambda c: [F.col(f"{c}{i}") for i in range(3)]
    nine = middle(F.greatest(*of("_lo")), middle(*of("_mid")), F.least(*of("_hi")))
    nulls = of("_k")[0] + of("_k")[1] + of("_k")[2]
    return own.select(*[c for c in samples.columns if c != name], F.when(nulls < 5, nine).alias(name))


def morph(samples: DataFrame, mask: str, name: str, pings: int, depth: int, grow: bool) -> DataFrame:
    """Erosion or dilation (``grow``) of a mask by a rectangle of 2k + 1 cells each way; outside the grid is FALSE."""

    def pass_over(df: DataFrame, w: Window, k: int, c: str) -> DataFrame:
        if k == 0:  # the cell alone; no row has to be put in order for it
            alone = F.col(c).cast("int") == 1
            return df.withColumn(name, alone if grow else F.coalesce(alone, F.lit(False)))
        frame = w.rowsBetween(-k, k)
        v = F.max(F.col(c).cast("int")).over(frame) == 1 if grow else (F.min(F.col(c).cast("int")).over(frame) == 1) & (F.count(c).over(frame) == 2 * k + 1)
        return df.withColumn(name, v)

    return pass_over(pass_over(samples, along_samples(), depth, mask), along_pings(), pings, name)


def smooth_weights(window: int, order: int) -> np.ndarray:
    """Least-squares polynomial smoothing: row i holds the weights for position i of a window; the middle row is the interior's."""
    x = np.arange(window) - window // 2
    a = np.vander(x, order + 1, increasing=True)
    return a @ np.linalg.pinv(a)


def savitzky_golay(df: DataFrame, value: str, name: str, window: int, order: int, by: Sequence[str], time: str, block: int = PINGS, width: int = DAY_US) -> DataFrame:
    """Smoothing by a local polynomial; the first and last half windows use the end polynomials. Shorter groups stay as they are.

    Rows are numbered along their group (``width``: of the buckets of ``time`` that takes) and smoothed block by block; only a group's count is known to all its blocks."""
    half, reach = window // 2, window - 1
    weights = smooth_weights(window, order)
    own = in_frames(df, by, time, reach, {"_around": lambda w: F.collect_list(F.coalesce(value, F.lit(float("nan")))).over(w.rowsBetween(-reach, reach))}, block, width)
    own = own.join(df.groupBy(*by).agg(F.count("*").alias("_rows")), list(by))
    place = F.when(F.col("_at") < half, F.col("_at")).when(F.col("_at") >= F.col("_rows") - half, F.col("_at") - F.col("_rows") + window).otherwise(half)
    start = F.least(F.col("_at"), F.lit(reach)) - place  # where the window begins in ``_around``
    table = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in weights])
    total = F.aggregate(F.zip_with(F.slice("_around", (start + 1).cast("int"), window), F.get(table, place.cast("int")), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return own.withColumn(name, F.when(F.col("_rows") >= window, F.nanvl(total, F.lit(None).cast("double"))).otherwise(F.col(value))).drop("_at", "_rows", "_around")


def _raised(line: DataFrame, samples: DataFrame, offset_m: float) -> DataFrame:
    """A seabed line moved up by as many samples as the one nearest ``offset_m`` has above it."""
    if offset_m <= 0:
        return line
    near = samples.groupBy("channel").agg((F.min_by(SAMPLE, F.struct(F.abs(F.col("depth") - offset_m), SAMPLE)) - F.min(SAMPLE)).alias("_up"), F.min(SAMPLE).alias("_top"))
    return line.join(near, "channel").select("channel", PING, F.greatest(F.col("seabed") - F.col("_up"), F.col("_top")).alias("seabed"))


def box_mean(samples: DataFrame, value: str, name: str, pings: int, depth: int) -> DataFrame:
    """Mean over 2k + 1 cells each way; beyond the grid stands its edge cell."""

    def mean(w: Window, c: str, k: int) -> Column:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one value for a series: a frame that ends with it is gone through anew by every row
        first, last = F.first(c).over(whole), F.last(c).over(whole)
        cells = [F.col(c), *[F.coalesce(F.lag(c, i).over(w), first) for i in range(1, k + 1)], *[F.coalesce(F.lead(c, i).over(w), last) for i in range(1, k + 1)]]
        return sum(cells[1:], cells[0]) / (2 * k + 1)

    own = samples.withColumn(name, mean(along_samples(), value, depth))
    return own.withColumn(name, mean(along_pings(), name, pings))


def _maximum_cells(own: DataFrame, low: float, high: float, least_db: float = -40, stop_db: float = -60) -> tuple[DataFrame, Callable[[str], Column], Column]:
    """Median-filtered samples with the columns that ``seabed_maximum`` needs, and the seabed of a ping: an aggregate and where a sample is a candidate for it."""
    ping = along_samples().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = along_samples().rowsBetween(-5, -1)
    gate = F.col("depth").between(low, high) & (F.col("sv_median") >= least_db)
    own = own.withColumn("_linear", to_linear(F.col("sv_median")))  # once, not for each of the five rows below
    own = own.withColumns({"_m": F.avg("_linear").over(above), "_n": F.count("*").over(above), "_most": F.max(F.when(gate, F.col("sv_median"))).over(ping)})
    own = own.withColumn("_m", to_db(F.col("_m")))
    peak = F.min(F.when(gate & (F.col("sv_median") == F.col("_most")), F.col(SAMPLE))).over(ping)
    stop = (F.col("_n") < 5) | F.coalesce(F.col("_m") < stop_db, F.lit(True))
    return own.withColumn("_peak", peak), F.max, (F.col(SAMPLE) <= F.col("_peak")) & stop


def _gradient_cells(own: DataFrame, low: float, high: float, over_db: float = 20) -> tuple[DataFrame, Callable[[str], Column], Column]:
    """As ``_maximum_cells``, for ``seabed_gradient``."""
    own = own.withColumn("_d", F.col("sv_median") - F.lag("sv_median").over(along_samples()))
    return own, F.min, F.col("depth").between(low, high) & (F.col("_d") > over_db)


_CELLS: dict[str, Callable[..., tuple[DataFrame, Callable[[str], Column], Column]]] = {"maximum": _maximum_cells, "gradient": _gradient_cells}


def seabed_lines(samples: DataFrame, methods: dict[str, dict], low: float, high: float) -> DataFrame:
    """``channel``, ping, ``method`` and ``seabed`` by several methods that start from the same median ("maximum", "gradient"), in one pass: samples are filtered and put in order once for all."""
    own, found = median_3x3(samples), []
    for name, parameters in methods.items():
        own, pick, candidate = _CELLS[name](own, low, high, **parameters)
        own = own.withColumn(name, F.when(candidate, F.col(SAMPLE)))
        found.append(pick(name).alias(name))
    lines = own.where(F.coalesce(*methods).isNotNull()).groupBy("channel", PING).agg(*found)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("method"), F.col(n).alias("seabed")) for n in methods]))
    return lines.select("channel", PING, each.alias("_e")).select("channel", PING, "_e.*").where("seabed is not null")


def seabed_maximum(samples: DataFrame, low: float, high: float, least_db: float = -40, stop_db: float = -60, offset_m: float = 0) -> DataFrame:
    """The loudest sample of the median-filtered gate, if loud enough, then up while the linear mean of the five samples above is ``stop_db`` or more."""
    return _raised(seabed_lines(samples, {"maximum": {"least_db": least_db, "stop_db": stop_db}}, low, high).drop("method"), samples, offset_m)


def seabed_gradient(samples: DataFrame, low: float, high: float, over_db: float = 20, offset_m: float = 0) -> DataFrame:
    """The first sample of the median-filtered gate that is louder than the one before it by more than ``over_db``."""
    return _raised(seabed_lines(samples, {"gradient": {"over_db": over_db}}, low, high).drop("method"), samples, offset_m)


def seabed_morphological(
    samples: DataFrame, low: float, high: float, least_db: float = -40, erode: tuple[int, int] = (1, 1), dilate: tuple[int, int] = (1, 3), cycles: int = 3, offset_m: float = 0, smooth_window: int | None = 11, block: int = PINGS,
) -> DataFrame:
    """Median filter, threshold in the gate, one erosion, ``cycles`` dilations kept in the gate, the first TRUE of each ping, and smoothing over pings.

    Rectangles are (pings, samples) each way. The gate is a band, so dilating so many times in it is one dilation by as much more, cut to the gate.
    Lines of a channel with no more pings than the window are not smoothed."""
    inside = F.col("depth").between(low, high) & F.col("sv_median").isNotNull()
    own = median_3x3(samples).withColumn("_m", F.coalesce((F.col("sv_median") >= least_db) & inside, F.lit(False)))
    own = morph(morph(own, "_m", "_e", *erode, grow=False), "_e", "_d", cycles * dilate[0], cycles * dilate[1], grow=True)
    line = _raised(own.where(F.col("_d") & inside).groupBy("channel", PING).agg(F.min(SAMPLE).alias("seabed")), samples, offset_m)
    if not smooth_window:
        return line
    line = staged(line, "line")  # a row for each ping, read several times
    counts = line.groupBy("channel").agg(F.count("*").alias("_many"))
    line = savitzky_golay(line.withColumn("_v", F.col("seabed").cast("double")), "_v", "_s", smooth_window, 1, ["channel"], PING, block, PINGS).join(counts, "channel")
    many = F.col("_many") > smooth_window
    return line.select("channel", PING, F.when(many, F.greatest(F.round("_s", 6), F.lit(0.0)).cast("int")).otherwise(F.col("seabed").cast("int")).alias("seabed"))


def seabed_composite(
    samples: DataFrame, low: float, high: float, margin_db: float = 3, least_db: float = -40, share: float = 0.75, window: int = 5, least_pings: int = 2, smooth_window: int = 31, smooth_order: int = 1, jump: float = 5, block: int = PINGS,
) -> DataFrame:
    """Median filter; per-ping threshold (a quantile of the gate less a margin, floored); erosion and dilation, undone in pings they empty; pings
    with few neighbours that have candidates lose theirs; the deepest candidate, else the deepest sample over the threshold, else the bottom;
    smoothing; jumps replaced by interpolation. ``detected`` tells pings with a candidate of their own from the rest.

    Lines shorter than the smoothing window stay unsmoothed."""
    inside = F.col("depth").between(low, high)
    own, ping = median_3x3(samples), Window.partitionBy("channel", PING)
    limit = F.greatest(F.percentile(F.when(inside, F.col("sv_median")), F.lit(share)).over(ping) - margin_db, F.lit(float(least_db)))
    own = own.withColumn("_m", F.coalesce((F.col("sv_median") > limit) & inside, F.lit(False)))
    own = morph(morph(own, "_m", "_e", 0, 1, grow=False), "_e", "_d", 1, 2, grow=True)
    left = F.max(F.col("_d").cast("int")).over(ping) == 1
    own = own.withColumn("_c", F.when(left, F.col("_d")).otherwise(F.col("_m")) & inside)
    line = own.groupBy("channel", PING).agg(F.max(F.when(F.col("_c"), F.col(SAMPLE))).alias("_own"), F.max(F.when(F.col("_m"), F.col(SAMPLE))).alias("_loud"), F.max(SAMPLE).alias("_bottom"))
    line = staged(line.withColumn("_has", F.col("_own").isNotNull().cast("double")), "line")  # a row for each ping
    ends = line.groupBy("channel").agg(F.min_by("_has", PING).alias("_first"), F.max_by("_has", PING).alias("_last"), F.max("_bottom").alias("_deepest"))
    steps = [k for k in range(-(window // 2), window // 2 + 1) if k]
    line = in_frames(line, ["channel"], PING, window // 2, {f"_has{k}": (lambda w, k=k: F.lead("_has", k).over(w)) for k in steps}, block, PINGS).join(ends, "channel")
    line = line.withColumn("_near", sum([F.coalesce(f"_has{k}", "_first" if k < 0 else "_last") for k in steps], F.col("_has"))).withColumn("_own", F.when(F.col("_near") / window >= least_pings / window, F.col("_own")))
    line = line.select("channel", PING, F.col("_own").isNotNull().alias("detected"), F.coalesce("_own", "_loud", "_bottom").cast("double").alias("_v"), F.col("_deepest").alias("_bottom"), F.col("_at").alias("_n"))
    line = savitzky_golay(line, "_v", "_s", smooth_window, smooth_order, ["channel"], PING, block, PINGS)
    line = staged(line, "line")
    line = nearest_known(with_bucket(line, "_n", block), ["channel"], ["_n"], F.col("_s"), "_before", inclusive=False)
    known = F.when(F.coalesce(F.abs(F.col("_s") - F.col("_before")), F.lit(0.0)) <= jump, F.struct(F.col("_n").alias("n"), F.col("_s").alias("s")))
    line = nearest_known(line.withColumn("_k", known), ["channel"], ["_n"], F.col("_k"), "_a")
    line = nearest_known(line, ["channel"], ["_n"], F.col("_k"), "_b2", forward=True).drop("_b").withColumnRenamed("_b2", "_b")
    between = F.col("_a.s") + (F.col("_b.s") - F.col("_a.s")) * (F.col("_n") - F.col("_a.n")) / F.greatest(F.col("_b.n") - F.col("_a.n"), F.lit(1))
    index = F.coalesce(between, F.col("_a.s"), F.col("_b.s"), F.col("_s"))
    return line.select("channel", PING, F.least(F.greatest(F.round(index, 6), F.lit(0.0)).cast("int"), F.col("_bottom").cast("int")).alias("seabed"), "detected")


#: Fixed value: counts of an echosounder's electrical angle for each degree.
ANGLE_COUNTS = 22.0 * 128.0 / 180.0


def seabed_angle(samples: DataFrame, low: float, high: float, along: float = 5.0, athwart: float = 5.0, box: tuple[int, int] = (1, 1), angles: tuple[str, str] = ("angle_alongship", "angle_athwartship")) -> DataFrame:
    """The first sample in the gate where the box mean of either split-beam angle, in counts, is over its threshold. ``box``: cells each way of the two boxes."""
    own = samples
    for name, angle, k in zip(("_along", "_athwart"), angles, box, strict=True):
        own = box_mean(own.withColumn(name, F.col(angle) * ANGLE_COUNTS), name, name, k, k)
    hit = (F.col("_along") > along) | (F.col("_athwart") > athwart)
    return own.where(F.col("depth").between(low, high) & hit).groupBy("channel", PING).agg(F.min(SAMPLE).alias("seabed"))


SEABED: dict[str, Callable[..., DataFrame]] = {"maximum": seabed_maximum, "gradient": seabed_gradient, "morphological": seabed_morphological, "composite": seabed_composite, "angle": seabed_angle}


def seabed(samples: DataFrame, method: str = "morphological", **parameters) -> DataFrame:
    if method not in SEABED:
        raise ValueError(f"unknown method {method!r}; one of {', '.join(SEABED)}")
    return SEABED[method](samples, **parameters)


def seabed_statistics(line: DataFrame, pings: DataFrame, depth: str = "depth") -> DataFrame:
    """For each channel of ``pings`` (any rows with channel and ping): the share of pings with a seabed (``rate``), and mean, population deviation, least and greatest depth; NULL without any."""
    n = pings.groupBy("channel").agg(F.countDistinct(PING).alias("_n"))
    found = line.groupBy("channel").agg(F.count(depth).alias("_k"), F.avg(depth).alias("mean"), F.stddev_pop(depth).alias("std"), F.min(depth).alias("min"), F.max(depth).alias("max"))
    return n.join(found, "channel", "left").select("channel", (F.coalesce("_k", F.lit(0)) / F.col("_n")).alias("rate"), "mean", "std", "min", "max")


def school_statistics(schools: DataFrame, samples: DataFrame, silent_db: float = -900) -> DataFrame:
    """For each channel: ``n_schools``, and ``share``, their cells among the samples over ``silent_db``; channels without such samples are left out."""
    found = schools.groupBy("channel").agg(F.count("*").alias("_k"), F.sum("n_cells").alias("_cells"))
    valid = samples.where(F.col("sv") > silent_db).groupBy("channel").agg(F.count("*").alias("_valid"))
    return valid.join(found, "channel", "left").select("channel", F.coalesce("_k", F.lit(0)).alias("n_schools"), (F.coalesce("_cells", F.lit(0)) / F.col("_valid")).alias("share"))


def mask_below_seabed(samples: DataFrame, line: DataFrame, offset_m: float = 0) -> DataFrame:
    """Sv stays above ``seabed_depth`` less an offset; pings without a seabed keep all."""
    own = samples.join(line.select("channel", PING, "seabed_depth"), ["channel", PING], "left")
    keep = F.col("seabed_depth").isNull() | (F.col("depth") < F.col("seabed_depth") - offset_m)
    return own.withColumn("sv", F.when(keep, F.col("sv")))


def fill_gaps(samples: DataFrame, mask: str, name: str, vertical: int, horizontal: int) -> DataFrame:
    """FALSE runs between TRUE cells become TRUE if no longer than given: down each ping first, then along pings."""

    def fill(df: DataFrame, keys: Sequence[str], order: str, most: int, c: str) -> DataFrame:
        if most <= 0:
            return df.withColumn(name, F.coalesce(c, F.lit(False)))
        w = Window.partitionBy(*keys).orderBy(order)
        here = F.when(F.col(c), F.col(order))
        # The ends of a run that is short enough are both within ``most`` cells.
        before = F.last(here, True).over(w.rangeBetween(-most, 0))
        after = F.first(here, True).over(w.rangeBetween(0, most))
        return df.withColumn(name, F.coalesce(F.col(c) | (after - before - 1 <= most), F.lit(False)))

    return fill(fill(samples, ("channel", PING), SAMPLE, vertical, mask), ("channel", SAMPLE), PING, horizontal, name)


def vertical_runs(samples: DataFrame, mask: str) -> DataFrame:
    """Maximal TRUE runs of each ping: ``lo`` and ``hi`` sample, their depths ``d_lo`` and ``d_hi``, and an ``id`` that is unique and repeatable."""
    on = samples.where(F.col(mask))
    w = Window.partitionBy("channel", PING).orderBy(SAMPLE)
    runs = on.withColumn("_g", F.col(SAMPLE) - F.row_number().over(w)).groupBy("channel", PING, "_g").agg(F.min(SAMPLE).alias("lo"), F.max(SAMPLE).alias("hi"), F.min("depth").alias("d_lo"), F.max("depth").alias("d_hi"))
    return runs.select("channel", PING, "lo", "hi", "d_lo", "d_hi", F.concat_ws("/", F.col("channel").cast("string"), F.lpad(F.col(PING).cast("string"), 12, "0"), F.lpad(F.col("lo").cast("string"), 9, "0")).alias("id"))


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``id``, ``label``: the least id reachable. Labels spread to neighbours and jump to their labels' labels; each round is a written table."""
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = staged(nodes.select("id", F.col("id").alias("label")), "label")
    while True:
        near = both.join(label.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = staged(label.join(near, "id", "left").select("id", F.least("label", "near").alias("next"), "label"), "step")
        jump = step.select(F.col("id").alias("next"), F.col("next").alias("far"))
        new = staged(step.join(jump, "next", "left").select("id", F.least("next", "far").alias("label"), F.col("label").alias("old")), "label")
        label, done = new.select("id", "label"), new.where("label <> old").isEmpty()
        if done:
            return label


def _local_labels(runs: DataFrame, wide: int, block: int) -> DataFrame:
    """Runs with ``label``, the least id of what is linked with them inside their block ``_k`` of pings."""
    kind = {f.name: f.dataType.simpleString() for f in runs.schema}

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        p, lo, hi = (rows[c].to_numpy() for c in (PING, "lo", "hi"))
        up = np.arange(len(rows))

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        j = 0
        for i in range(len(rows)):
            # ``j``: the first run of the ping before that does not end above this one.
            while j < i and (p[j] < p[i] - 1 or (p[j] == p[i] - 1 and hi[j] + wide < lo[i])):
                j += 1
            at = j
            while at < i and p[at] == p[i] - 1 and lo[at] <= hi[i] + wide:
                a, b = root(i), root(at)
                up[max(a, b)] = min(a, b)
                at += 1
        return rows.assign(label=rows["id"].groupby([root(i) for i in range(len(rows))]).transform("min").to_numpy())

    own = runs.withColumn("_k", F.floor(F.col(PING) / block))
    schema = ", ".join(f"{c} {kind[c]}" for c in runs.columns) + ", _k long, label string"
    return by_runs(own, ["channel", "_k"], [PING, "lo"], link, schema, int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def schools(samples: DataFrame, mask: str, diagonal: bool = False, block: int = 256) -> DataFrame:
    """Runs with the ``label`` of their connected component: runs of neighbouring pings that overlap (or, ``diagonal``, touch corners) are linked.

    Components are found inside blocks of pings first; only those that meet at a border between blocks go into rounds."""
    wide = 1 if diagonal else 0
    runs = staged(_local_labels(vertical_runs(samples, mask), wide, block), "runs")
    left = runs.where(F.pmod(F.col(PING), F.lit(block)) == block - 1).select("channel", (F.col(PING) + 1).alias("p2"), "lo", "hi", F.col("label").alias("a"))
    right = runs.where(F.pmod(F.col(PING), F.lit(block)) == 0).select("channel", F.col(PING).alias("p2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("label").alias("b"))
    near = staged(left.join(right, ["channel", "p2"]).where((F.col("lo") <= F.col("hi2") + wide) & (F.col("lo2") <= F.col("hi") + wide)).select("a", "b").distinct(), "borders")
    runs = runs.drop("_k")
    if near.isEmpty():
        return runs
    meet = connected(near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), near).select(F.col("id").alias("label"), F.col("label").alias("_label"))
    return runs.join(meet, "label", "left").withColumn("label", F.coalesce("_label", "label")).drop("_label")


def _weill_runs(samples: DataFrame, least_db: float, vertical_gap: int, horizontal_gap: int) -> DataFrame:
    own = samples.withColumn("_m", F.coalesce(F.col("sv") > least_db, F.lit(False)))
    return schools(fill_gaps(own, "_m", "_f", vertical_gap, horizontal_gap), "_f")


def schools_weill(samples: DataFrame, least_db: float = -70, vertical_gap: int = 5, horizontal_gap: int = 0, least_height: int = 0, least_length: int = 0) -> DataFrame:
    """Schools over a threshold, by gap filling, 4-connected components and least extents in samples and pings: ``label``, bounding box, ``n_cells``."""
    box = boxes(_weill_runs(samples, least_db, vertical_gap, horizontal_gap))
    return box.where((F.col("s_hi") - F.col("s_lo") + 1 >= least_height) & (F.col("p_hi") - F.col("p_lo") + 1 >= least_length))


def boxes(runs: DataFrame) -> DataFrame:
    return runs.groupBy("channel", "label").agg(F.min(PING).alias("p_lo"), F.max(PING).alias("p_hi"), F.min("lo").alias("s_lo"), F.max("hi").alias("s_hi"), F.min("d_lo").alias("d_lo"), F.max("d_hi").alias("d_hi"), F.sum(F.col("hi") - F.col("lo") + 1).alias("n_cells"))


def _spans(samples: DataFrame) -> DataFrame:
    """A row for each channel: first and last ping, sample and depth, and the depth of a sample."""
    out = samples.groupBy("channel").agg(F.min(PING).alias("p0"), F.max(PING).alias("p1"), F.min(SAMPLE).alias("s0"), F.max(SAMPLE).alias("s1"), F.min("depth").alias("d0"), F.max("depth").alias("d1"))
    return out.withColumn("step", (F.col("d1") - F.col("d0")) / F.greatest(F.col("s1") - F.col("s0"), F.lit(1)))


def _large(box: DataFrame, least: tuple[float, float]) -> Column:
    """Height in metres and length in pings, each to the next cell where there is one."""
    height = F.col("d_hi") - F.col("d_lo") + F.when(F.col("s_hi") < F.col("s1"), F.col("step")).otherwise(0.0)
    length = F.col("p_hi") - F.col("p_lo") + (F.col("p_hi") < F.col("p1")).cast("int")
    return (height >= least[0]) & (length >= least[1])


def _three_stage_runs(samples: DataFrame, least_db: float, candidate: tuple[float, float], link: tuple[float, float], least: tuple[float, float]) -> tuple[DataFrame, DataFrame]:
    own = samples.withColumn("_m", F.coalesce(F.col("sv") > least_db, F.lit(False)))
    spans = staged(_spans(samples), "spans")
    runs = staged(schools(own, "_m", diagonal=True).withColumnRenamed("id", "run"), "runs")
    box = boxes(runs).join(spans, "channel")
    box = staged(box.where(_large(box, candidate)).withColumnRenamed("label", "id"), "boxes")
    runs = staged(runs.withColumnRenamed("label", "id").join(box.select("id"), "id", "left_semi"), "candidates")
    # A candidate is linked with all that have a cell in its widened box. Boxes and runs are dealt to blocks of pings, so only near ones are compared.
    block = 64
    wide = box.select("channel", "id", (F.col("p_lo") - link[1] - 1).alias("a"), (F.col("p_hi") + link[1] + 1).alias("b"), (F.col("d_lo") - link[0] - 1 - F.col("step") / 2).alias("top"), (F.col("d_hi") + link[0] + 1 + F.col("step") / 2).alias("bottom"))
    wide = wide.withColumn("_k", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor(F.col("b") / block))))
    other = runs.select("channel", F.floor(F.col(PING) / block).alias("_k"), F.col("id").alias("id2"), F.col(PING).alias("p"), "d_lo", "d_hi")
    meet = wide.join(other, ["channel", "_k"]).where((F.col("id") != F.col("id2")) & F.col("p").between(F.col("a"), F.col("b")) & (F.col("d_lo") <= F.col("bottom")) & (F.col("d_hi") >= F.col("top")))
    linked = connected(box, meet.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct())
    runs = staged(runs.join(linked, "id").select("channel", PING, "lo", "hi", "d_lo", "d_hi", "label"), "linked")
    large = boxes(runs).join(spans, "channel")
    return runs, large.where(_large(large, least)).select("channel", "label", "p_lo", "p_hi", "s_lo", "s_hi", "d_lo", "d_hi", "n_cells")


def schools_three_stage(samples: DataFrame, least_db: float = -70, candidate: tuple[float, float] = (3, 10), link: tuple[float, float] = (3, 15), least: tuple[float, float] = (3, 15)) -> DataFrame:
    """8-connected candidates of some size; those with a cell in another's box widened by ``link`` are one school; small schools go. Pairs are (metres, pings)."""
    return _three_stage_runs(samples, least_db, candidate, link, least)[1]


def school_mask(samples: DataFrame, method: str = "weill", **parameters) -> DataFrame:
    """The samples with ``school`` (inside one) and ``school_edge`` (so near the border of the grid that a school may be cut off there)."""
    spans = _spans(samples)
    if method == "weill":
        parameters = {"least_db": -70, "vertical_gap": 5, "horizontal_gap": 0, "least_height": 0, "least_length": 0} | parameters
        runs = staged(_weill_runs(samples, parameters["least_db"], parameters["vertical_gap"], parameters["horizontal_gap"]), "runs")
        found = boxes(runs).where((F.col("s_hi") - F.col("s_lo") + 1 >= parameters["least_height"]) & (F.col("p_hi") - F.col("p_lo") + 1 >= parameters["least_length"]))
        v, h = parameters["least_height"], parameters["least_length"]
        edge = (F.col(SAMPLE) < F.col("s0") + v) | (F.col(PING) < F.col("p0") + h) | ((F.col(SAMPLE) > F.col("s1") - v) & (v > 0)) | ((F.col(PING) > F.col("p1") - h) & (h > 0))
    elif method == "three_stage":
        parameters = {"least_db": -70, "candidate": (3, 10), "link": (3, 15), "least": (3, 15)} | parameters
        runs, found = _three_stage_runs(samples, **parameters)
        v, h = (float(max(parameters[k][i] for k in ("candidate", "link", "least"))) for i in (0, 1))
        edge = (F.col("depth") < F.col("d0") + v) | (F.col("depth") > F.col("d1") - v) | (F.col(PING) < F.col("p0") + h) | (F.col(PING) > F.col("p1") - h)
    else:
        raise ValueError(f"unknown method {method!r}; one of {', '.join(SCHOOLS)}")
    cells = runs.join(found.select("channel", "label"), ["channel", "label"], "left_semi").select("channel", PING, F.explode(F.sequence("lo", "hi")).alias(SAMPLE), F.lit(True).alias("school"))
    own = samples.join(cells.hint("merge"), ["channel", PING, SAMPLE], "left").join(spans, "channel", "left")
    return own.select(*samples.columns, F.coalesce("school", F.lit(False)).alias("school"), edge.alias("school_edge"))


SCHOOLS: dict[str, Callable[..., DataFrame]] = {"weill": schools_weill, "three_stage": schools_three_stage}

def attenuation_stage(samples: DataFrame, **parameters) -> DataFrame:
    """``attenuation`` for all samples of attenuated pings, and ``attenuation_unfeasible`` where no full block stands around a ping."""
    return samples.join(_attenuation_of_pings(samples, **parameters), ["channel", PING], "left")


def _attenuation_of_pings(samples: DataFrame, **parameters) -> DataFrame:
    return attenuated_pings(samples, **parameters).select("channel", PING, F.col("attenuated").alias("attenuation"), F.col("unfeasible").alias("attenuation_unfeasible"))


def background_stage(samples: DataFrame, alpha: float = 0.01, snr_db: float = 3, **parameters) -> DataFrame:
    """``background`` where, the block's noise taken off, too little is left."""
    noise = background_noise(samples, F.lit(alpha), **parameters)
    own = subtract_noise(samples, noise, F.lit(alpha), parameters.get("pings", 50), snr_db)
    return own.select(*samples.columns, F.col("low_snr").alias("background"))


def _noise_of_pings(samples: DataFrame, alpha: float = 0.01, snr_db: float = 3, **parameters) -> DataFrame:
    """``noise`` for every ping number of a block of pings, as ``background_stage`` takes it."""
    pings = parameters.get("pings", 50)
    block = background_noise(samples, F.lit(alpha), **parameters)
    first = F.col("ping_block") * pings
    return block.select("channel", F.explode(F.sequence(first, first + (pings - 1))).alias(PING), "noise").withColumn(PING, F.col(PING).cast(samples.schema[PING].dataType))


def fielding_stage(samples: DataFrame, **parameters) -> DataFrame:
    return transient_below(samples, **parameters).withColumnRenamed("transient", "fielding")


#: Stages by name: each adds one boolean column of its own name to the sample table, and may add ``<name>_unfeasible``.
STAGES: dict[str, Callable[..., DataFrame]] = {"background": background_stage, "impulse": impulse_mask, "transient": transient_block, "fielding": fielding_stage, "attenuation": attenuation_stage}


def register_stage(name: str, stage: Callable[..., DataFrame]) -> None:
    """Make ``stage(samples, **parameters)`` available to ``denoise``; it must add a boolean column ``name``."""
    STAGES[name] = stage


#: The stages of the library, which read no column of each other, and what two of them know of each ping. A stage registered under one of the names is not among them.
_OWN: dict[str, Callable[..., DataFrame]] = dict(STAGES)
_OF_PINGS: dict[str, Callable[..., DataFrame]] = {"attenuation": _attenuation_of_pings, "background": _noise_of_pings}


def denoise(samples: DataFrame, stages: Iterable[tuple[str, dict]], mask_unfeasible: bool = False, tasks: int | None = None) -> DataFrame:
    """Run stages on the same samples; ``masked`` is their OR where Sv is known, ``sv_clean`` what is left.

    With ``mask_unfeasible`` samples that a stage can't judge count as flagged by it. An unknown stage, or one that can't be planned
    (a wrong parameter, a missing column), is left out with a warning; its column is then FALSE.

    Where only stages of the library run and ``transient`` is one, ``attenuation`` and ``background`` are worked out for pings from the samples as given and go through
    its kernel with the samples: it runs once, and no join moves the samples. ``tasks``: how many tasks the samples are dealt to by channel, and what is said of pings with them."""
    stages, names, added, beside, late = list(stages), [], [], {}, None
    own = samples = samples.repartition(tasks, "channel") if tasks else samples
    once = len({n for n, _ in stages}) == len(stages) and all(STAGES.get(n) is _OWN.get(n) for n, _ in stages) and "transient" in dict(stages)
    once = once and not {"noise", "low_snr", "sv_clean", *_OWN} & set(samples.columns)
    for name, parameters in stages:
        apart = once and name in ("transient", *_OF_PINGS)
        try:
            more = STAGES[name](own, **parameters)
            more.select(name)
            of_pings = _OF_PINGS[name](samples, **parameters) if apart and name in _OF_PINGS else None
        except Exception as e:  # noqa: BLE001  (a stage may be anyone's code)
            warnings.warn(f"stage {name!r} left out: {str(e).splitlines()[0] if str(e) else type(e).__name__}", stacklevel=2)
            added += [name] if name not in own.columns else []
            own = own.withColumn(name, F.lit(False))
            continue
        names.append(name)
        added += [c for c in more.columns if c not in own.columns]
        if of_pings is not None:
            beside[name] = of_pings
        elif apart:
            late = parameters
        else:
            own = _judged(more, name, mask_unfeasible)
    if late is not None or beside:
        own = _with_pings(own, late, beside, dict(stages), tasks)
        for name in ("transient", *_OF_PINGS):
            own = _judged(own, name, mask_unfeasible)
        own = own.select(*samples.columns, *added)
    any_ = F.lit(False)
    for n in names:
        any_ = any_ | F.coalesce(F.col(n), F.lit(False))
    return own.withColumn("masked", F.col("sv").isNotNull() & any_).withColumn("sv_clean", F.when(~F.col("masked"), F.col("sv")))


def _judged(own: DataFrame, name: str, mask_unfeasible: bool) -> DataFrame:
    """Flagged where the stage can't judge, too, if so asked."""
    if mask_unfeasible and f"{name}_unfeasible" in own.columns:
        return own.withColumn(name, F.coalesce(F.col(name), F.lit(False)) | F.coalesce(f"{name}_unfeasible", F.lit(False)))
    return own


def _with_pings(own: DataFrame, transient: dict | None, of_pings: dict[str, DataFrame], parameters: dict[str, dict], tasks: int | None) -> DataFrame:
    """Samples with ``transient`` (if its parameters are given) and with the stages of ``of_pings``."""
    beside = None
    for rows in of_pings.values():
        beside = rows if beside is None else beside.join(rows, ["channel", PING], "full")
    if beside is not None and tasks:
        beside = beside.repartition(tasks, "channel")
    if transient is not None:
        own = transient_block(own, **transient, beside=beside)
    else:
        own = own.join(beside, ["channel", PING], "left")
    if "background" in of_pings:
        alpha, snr_db = (parameters["background"].get(k, v) for k, v in (("alpha", 0.01), ("snr_db", 3)))
        own = _less_noise(own, F.lit(alpha), snr_db).withColumnRenamed("low_snr", "background").drop("noise", "sv_clean")
    return own


def flag_shares(samples: DataFrame, masks: Sequence[str]) -> DataFrame:
    """Share of samples flagged by each mask, in percent."""
    return samples.groupBy("channel").agg(*[(100 * F.avg(F.col(m).cast("double"))).alias(m) for m in masks])


def adaptive_level(samples: DataFrame, pings: int = 10) -> DataFrame:
    """Mean level over pings around each sample; frames are cut at the ends."""
    return samples.withColumn("level", F.avg("sv").over(along_pings().rowsBetween(-(pings // 2), pings - pings // 2 - 1)))


def apply_masks(samples: DataFrame, masks: DataFrame, value: str = "sv") -> DataFrame:
    """``value`` becomes NULL where ``masks`` (channel, ping, sample and a boolean ``mask``) is TRUE; samples without a mask keep theirs."""
    # Samples beside samples: never broadcast, however small the plan takes them to be.
    own = samples.join(masks.select("channel", PING, SAMPLE, "mask").hint("merge"), ["channel", PING, SAMPLE], "left")
    return own.withColumn(value, F.when(~F.coalesce("mask", F.lit(False)), F.col(value))).drop("mask")


def surface_excluded(samples: DataFrame, above_m: float, value: str = "sv") -> DataFrame:
    """``value`` stays from ``above_m`` down."""
    return samples.withColumn(value, F.when(F.col("depth") >= above_m, F.col(value)))


def clipped(samples: DataFrame, most: float, value: str = "sv") -> DataFrame:
    """Values over ``most`` are no echo and become NULL."""
    return samples.withColumn(value, F.when(F.col(value) <= most, F.col(value)))


def depth_from_range(samples: DataFrame, transducer_m: float = 0.0, rng: str = "echo_range") -> DataFrame:
    """``depth``: the range, or the sample's number where there is none, below the transducer."""
    return samples.withColumn("depth", F.coalesce(F.col(rng), F.col(SAMPLE)) + transducer_m)


def resampled_nearest(fine: DataFrame, coarse: DataFrame, value: str, steps: tuple[float, float], keys: Sequence[str] = ("channel",), axes: tuple[str, str] = ("t", "depth")) -> DataFrame:
    """``value`` of the nearest cell of a coarser regular grid (left edges ``axes``, widths ``steps``) for every cell of a finer one; a tie goes to the lower cell."""
    places = [F.ceil((F.col(a) / s).cast("double") - 0.5).cast("long").alias(f"_{i}") for i, (a, s) in enumerate(zip(axes, steps, strict=True))]
    cells = coarse.select(*keys, *[F.round(F.col(a) / s).cast("long").alias(f"_{i}") for i, (a, s) in enumerate(zip(axes, steps, strict=True))], value)
    return fine.select("*", *places).join(cells, [*keys, "_0", "_1"], "left").drop("_0", "_1")


def rolling(df: DataFrame, value: str, name: str, half: int, reduce: Callable[[Column], Column], by: Sequence[str], order: str, block: int = PINGS, width: int = DAY_US) -> DataFrame:
    """``name``: any reducer of the values, an array, in a centred frame of 2 x ``half`` + 1 rows; NULL values are left out of the array. Series are worked out block by block."""
    return in_frames(df, by, order, half, {name: lambda w: reduce(F.collect_list(value).over(w.rowsBetween(-half, half)))}, block, width).drop("_at")
