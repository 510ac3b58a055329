"""Echo operators on small cubes with planted signals, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundings.operators import echo, grid


def cube(spark, sv, channel="38", step=1.0):
    rows = [(channel, int(p), int(s), float(s * step), float(p) * 1e6, None if np.isnan(sv[p, s]) else float(sv[p, s])) for p in range(sv.shape[0]) for s in range(sv.shape[1])]
    return spark.createDataFrame(rows, "channel string, ping_idx int, sample_idx int, depth double, t double, sv double")


def noise(seed=42, pings=24, depth=40):
    return np.random.default_rng(seed).normal(-70, 3, (pings, depth))


def back(df, value, shape):
    out = np.full(shape, np.nan)
    for r in df.select("ping_idx", "sample_idx", value).collect():
        out[r[0], r[1]] = r[2]
    return out


def test_median_filter(spark):
    x = noise()
    pad = np.pad(x, 1, mode="symmetric")
    want = np.median(np.lib.stride_tricks.sliding_window_view(pad, (3, 3)).reshape(*x.shape, 9), axis=-1)
    assert np.allclose(back(echo.median_3x3(cube(spark, x)), "sv_median", x.shape), want)


def test_morphology(spark):
    m = np.zeros((12, 14), bool)
    m[3:8, 4:10] = True
    df = cube(spark, np.where(m, -40.0, -90.0)).withColumn("m", F.col("sv") > -60)
    small = back(echo.morph(df, "m", "e", 1, 2, grow=False).withColumn("e", F.col("e").cast("int")), "e", m.shape)
    large = back(echo.morph(df, "m", "e", 1, 2, grow=True).withColumn("e", F.col("e").cast("int")), "e", m.shape)
    want = np.zeros_like(m)
    want[4:7, 6:8] = True
    assert (small == want).all()
    want[2:9, 2:12] = True
    assert (large == want).all()


def test_impulse_is_found_and_masks_shrink_with_the_threshold(spark):
    x = noise()
    x[10, 5:20] += 40
    hit = back(echo.impulse_mask(cube(spark, x)).withColumn("impulse", F.col("impulse").cast("int")), "impulse", x.shape)
    assert hit[10, 5:20].all() and hit[0].sum() == hit[-1].sum() == 0
    few = echo.impulse_mask(cube(spark, x), over_db=20).where("impulse").count()
    assert few <= hit.sum()


def test_transient_block_equals_numpy_across_blocks(spark):
    x = noise(depth=20)
    x[7, 8:12] += 25
    want = np.zeros(x.shape, bool)
    lin = 10 ** (x / 10)
    for p in range(2, x.shape[0] - 2):
        for s in range(2, 18):
            want[p, s] = x[p, s] - 10 * np.log10(np.quantile(lin[p - 2 : p + 3, s - 2 : s + 3], 0.15)) > 6
    for block in (5, 1000):
        got = echo.transient_block(cube(spark, x), 2, 2, 0.15, 6, 0, block)
        assert (back(got.withColumn("transient", F.col("transient").cast("int")), "transient", x.shape) == want).all()


def test_background_noise(spark):
    x = noise(pings=20, depth=41)
    r = np.arange(41.0)
    gain = np.where(r > 0, 20 * np.log10(np.where(r > 0, r, 1)) + 0.02 * r, np.nan)
    p = 10 ** ((x - gain) / 10)
    got = {r["ping_block"]: r["noise"] for r in echo.background_noise(cube(spark, x), F.lit(0.01), 10, 10, most_db=0).collect()}
    for b in range(2):
        cells = [10 * np.log10(np.nanmean(p[10 * b : 10 * b + 10, c : c + 10])) for c in range(0, 41, 10)]
        assert abs(got[b] - min(cells)) < 1e-9


def _planted(pings=40, depth=60):
    x = noise(pings=pings, depth=depth)
    top = 30 + np.round(2 * np.sin(np.arange(pings) / 4)).astype(int)
    for p in range(pings):
        x[p, top[p] : top[p] + 8] = -30
    return x, top


def _median(x):
    y = np.pad(x, 1, mode="symmetric")
    return np.median(np.stack([y[i : i + x.shape[0], j : j + x.shape[1]] for i in range(3) for j in range(3)]), axis=0)


def _rectangle(mask, pings, depth, grow):
    y = np.pad(mask, ((pings, pings), (depth, depth)))
    parts = [y[i : i + mask.shape[0], j : j + mask.shape[1]] for i in range(2 * pings + 1) for j in range(2 * depth + 1)]
    return np.any(parts, axis=0) if grow else np.all(parts, axis=0)


def _line(v, window):
    """Straight lines of least squares through windows; the first and last windows serve the ends."""
    out = np.empty(len(v))
    for i in range(len(v)):
        a = min(max(i - window // 2, 0), len(v) - window)
        out[i] = np.polyval(np.polyfit(np.arange(window), v[a : a + window], 1), i - a)
    return out


@pytest.mark.parametrize(("method", "parameters"), [("maximum", {}), ("gradient", {})])
def test_planted_seabed_is_found(spark, method, parameters):
    x, top = _planted()
    got = {r["ping_idx"]: r["seabed"] for r in echo.seabed(cube(spark, x), method, low=10, high=55, **parameters).collect()}
    assert len(got) == len(top)
    if method == "gradient":
        assert all(abs(got[p] - top[p]) <= 1 for p in got)
    else:  # where the mean of the five samples above falls below the threshold
        assert all(top[p] <= got[p] <= top[p] + 7 for p in got)
    up = echo.seabed(cube(spark, x), method, low=10, high=55, offset_m=3, **parameters).collect()
    assert {r["ping_idx"]: r["seabed"] + 3 for r in up} == got


def test_morphological_seabed_equals_numpy(spark):
    """One erosion, three dilations that stay in the gate, the first cell, smoothing: the line runs up to eight samples over the echo."""
    x, top = _planted()
    gate = np.zeros(x.shape, bool)
    gate[:, 24:56] = True
    mask = _rectangle((_median(x) >= -50) & gate, 1, 1, False)
    for _ in range(3):
        mask = _rectangle(mask, 1, 3, True) & gate
    first = mask.argmax(axis=1)
    for window, want in ((None, first), (11, np.round(_line(first, 11), 6).astype(int))):
        got = {r["ping_idx"]: r["seabed"] for r in echo.seabed(cube(spark, x), "morphological", low=24, high=55, least_db=-50, smooth_window=window).collect()}
        assert [got[p] for p in range(len(top))] == want.tolist()
    assert first.min() == 24  # never above the gate


def test_composite_seabed_equals_numpy(spark):
    x, top = _planted()
    x[5:8, 10:55] = -90  # no candidate: the bottom, a jump, is replaced
    gate = np.zeros(x.shape, bool)
    gate[:, 10:56] = True
    m = _median(x)
    limit = np.maximum(np.array([np.quantile(row[10:56], 0.75) for row in m]) - 3, -40)[:, None]
    loud = (m > limit) & gate
    mask = _rectangle(_rectangle(loud, 0, 1, False), 1, 2, True)
    none = ~mask.any(axis=1)
    mask[none] = loud[none]
    mask &= gate
    has = np.pad(mask.any(axis=1).astype(float), 2, mode="edge")
    near = np.array([has[i : i + 5].sum() for i in range(len(top))]) >= 2
    deepest = lambda row: np.flatnonzero(row)[-1]
    own = [near[p] and mask[p].any() for p in range(len(top))]
    index = np.array([deepest(mask[p]) if own[p] else deepest(loud[p]) if loud[p].any() else x.shape[1] - 1 for p in range(len(top))])
    smooth = _line(index, 31)
    jump = np.abs(np.diff(smooth, prepend=smooth[0])) > 5
    smooth[jump] = np.interp(np.flatnonzero(jump), np.flatnonzero(~jump), smooth[~jump])
    out = {r["ping_idx"]: r for r in echo.seabed(cube(spark, x), "composite", low=10, high=55).collect()}
    assert [out[p]["seabed"] for p in range(len(top))] == np.round(smooth, 6).astype(int).tolist()
    assert [out[p]["detected"] for p in range(len(top))] == own


def test_angle_seabed_takes_either_angle(spark):
    x = noise(pings=6, depth=30)
    along, athwart = np.zeros(x.shape), np.zeros(x.shape)
    along[:3, 15:], athwart[3:, 20:] = 1.0, 1.0
    own = cube(spark, x)
    for name, values in (("angle_alongship", along), ("angle_athwartship", athwart)):
        own = own.join(cube(spark, values).select("channel", "ping_idx", "sample_idx", F.col("sv").alias(name)), ["channel", "ping_idx", "sample_idx"])
    got = {r["ping_idx"]: r["seabed"] for r in echo.seabed(own, "angle", low=5, high=29).collect()}
    y = lambda v: np.stack([np.pad(v, 1, mode="edge")[i : i + 6, j : j + 30] for i in range(3) for j in range(3)]).mean(axis=0) * 22 * 128 / 180
    want = {p: int(np.flatnonzero(((y(along) > 5) | (y(athwart) > 5))[p] & (np.arange(30) >= 5))[0]) for p in range(6)}
    assert got == want


def test_schools(spark):
    x = np.full((30, 40), -90.0)
    x[5:12, 10:20] = -50
    x[8, 14] = -90
    x[20:24, 30:36] = -50
    x[12, 20] = -50  # touches the first by a corner only
    found = {(r["p_lo"], r["p_hi"], r["s_lo"], r["s_hi"], r["n_cells"]) for r in echo.schools_weill(cube(spark, x), -70, 1, 0, 2, 2).collect()}
    assert found == {(5, 11, 10, 19, 70), (20, 23, 30, 35, 24)}
    joined = {(r["p_lo"], r["p_hi"]) for r in echo.schools_three_stage(cube(spark, x), -70, (1, 1), (0, 0), (2, 2)).collect()}
    assert joined == {(5, 12), (20, 23)}
    linked = {(r["p_lo"], r["p_hi"]) for r in echo.schools_three_stage(cube(spark, x), -70, (1, 1), (9, 7), (2, 2)).collect()}
    assert linked == {(5, 23)}  # the second has a cell in the first's box widened by 10 m and 8 pings
    assert echo.schools_three_stage(cube(spark, x), -70, (20, 1), (0, 0), (2, 2)).isEmpty()
    mask = echo.school_mask(cube(spark, x), "weill", least_db=-70, vertical_gap=1, least_height=2, least_length=2)
    assert mask.where("school").count() == 94 and mask.where("school_edge").count() == 30 * 40 - 26 * 36
    assert echo.school_mask(cube(spark, x), "three_stage", candidate=(1, 1), link=(0, 0), least=(2, 2)).where("school").count() == 69 + 1 + 24


def test_a_school_just_at_the_threshold_is_none(spark):
    x = np.full((4, 4), -70.0)
    assert echo.schools_weill(cube(spark, x), -70).isEmpty() and echo.schools_three_stage(cube(spark, x), -70, (0, 0), (0, 0), (0, 0)).isEmpty()


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError, match="unknown method"):
        echo.seabed(cube(spark, noise()), "nothing")


def test_a_registered_stage_takes_part(spark):
    echo.register_stage("shallow", lambda df, below: df.withColumn("shallow", F.col("depth") < below))
    x = noise()
    own = echo.denoise(cube(spark, x), [("impulse", {"over_db": 1000}), ("shallow", {"below": 5})])
    assert own.where("depth < 5 and sv_clean is not null").isEmpty() and not own.where("depth >= 5 and sv_clean is not null").isEmpty()


def test_a_failing_stage_is_left_out_and_unfeasible_samples_may_count(spark):
    x = noise()
    echo.register_stage("broken", lambda df: df.withColumn("broken", F.col("nothing")))
    with pytest.warns(UserWarning, match="'broken' left out"):
        own = echo.denoise(cube(spark, x), [("broken", {}), ("unknown", {}), ("impulse", {"over_db": 1000})])
    assert own.where("masked").isEmpty() and {"broken", "unknown", "impulse"} <= set(own.columns)
    own = echo.denoise(cube(spark, x), [("impulse", {"over_db": 1000}), ("attenuation", {"low": 0, "high": 100, "half": 3})], mask_unfeasible=True)
    pings = x.shape[0]
    assert {r["ping_idx"] for r in own.where("masked").select("ping_idx").distinct().collect()} >= {0, 1, 2, pings - 3, pings - 2, pings - 1}
    assert own.where("masked and not (impulse or attenuation)").isEmpty()


def test_stages_at_once_equal_one_after_the_other(spark):
    """With missing pings and samples, missing values, channels without a name and a short one; the kernel runs once and no join moves samples."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(-70, 12, (70, 12)))
    x[rng.random(x.shape) < 0.02] = np.nan
    own = cube(spark, x, "a", 10.0).where("not (ping_idx between 20 and 24) and (ping_idx + sample_idx) % 29 <> 0")
    own = own.unionByName(cube(spark, x[:3], None, 10.0)).unionByName(cube(spark, x[:8], "b", 10.0))
    stages = [
        ("impulse", {"lags": [1]}), ("transient", {"pings": 2, "depth": 2, "over_db": 20, "below_m": 20, "block": 16}),
        ("attenuation", {"low": 10, "high": 90, "half": 3, "below_db": 2}), ("background", {"pings": 10, "ranges": 5, "most_db": -75}),
    ]
    want, flags = own, F.lit(False)
    for name, parameters in stages:
        want = echo.STAGES[name](want, **parameters)
        for flag in (name, f"{name}_unfeasible"):
            flags = flags | F.coalesce(flag, F.lit(False)) if flag in want.columns else flags
    want = want.withColumn("masked", F.col("sv").isNotNull() & flags)

    def rows(df):
        return sorted((tuple(r) for r in df.select("channel", "ping_idx", "sample_idx", "masked", "transient", "background").collect()), key=lambda r: (str(r[0]), *r[1:3]))

    for tasks in (None, 3):
        got = echo.denoise(own, stages, mask_unfeasible=True, tasks=tasks)
        assert set(got.columns) == {*want.columns, "sv_clean"}
        assert rows(got) == rows(want)
        assert not [n for n, _ in stages if got.where(n).isEmpty()]
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("FlatMapGroupsInArrow") == 1
    with pytest.warns(UserWarning, match="'transient' left out"):
        alone = echo.denoise(own, [("transient", {"nothing": 1}), stages[2]])
    assert alone.where("attenuation").count() == want.where("attenuation").count()


def test_mvbs_is_a_linear_mean(spark):
    x = noise()
    got = {(r["t_bin"], r["depth_bin"]): r["sv"] for r in grid.mvbs(cube(spark, x), 10, 5_000_000).collect()}
    for (t, d), v in got.items():
        part = x[int(t / 1e6) : int(t / 1e6) + 5, int(d) : int(d) + 10]
        assert abs(v - 10 * np.log10(np.mean(10 ** (part / 10)))) < 1e-9


def test_regrid_is_linear(spark):
    x = noise(pings=2, depth=10)
    got = back(grid.regrid(cube(spark, x, step=1.5), 0.5).withColumn("sample_idx", (F.col("depth") * 2).cast("int")), "sv", (2, 28))
    for p in range(2):
        assert np.allclose(got[p], np.interp(np.arange(28) * 0.5, np.arange(10) * 1.5, x[p]))


def test_samples_are_not_broadcast(spark):
    """Exploded samples look as small as their pings to the planner."""
    pings = spark.range(40).select((F.col("id") % 2).alias("channel"), F.floor(F.col("id") / 2).cast("int").alias("ping_idx"))
    own = pings.withColumn("sample_idx", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumns({"depth": F.col("sample_idx") * 1.0, "sv": -60.0 + (F.col("ping_idx") * 7 + F.col("sample_idx")) % 11})
    masks = own.select("channel", "ping_idx", "sample_idx", (F.col("sample_idx") % 3 == 0).alias("mask"))
    for got in (echo.apply_masks(own, masks), echo.transient_block(own, 1, 1, below_m=0, block=8), echo.impulse_mask(own)):
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert "BuildLeft" not in plan and not any("BroadcastHashJoin" in x and "sample_idx" in x for x in plan.splitlines()), plan
        assert got.count() == 400


def test_transient_block_keeps_kinds_and_nulls(spark):
    rows = [("a", p, s, float(s), -70.0 if (p, s) != (3, 2) else -20.0, None if p % 2 else p, None if s else "x") for p in range(7) for s in range(5)]
    own = spark.createDataFrame(rows, "channel string, ping_idx int, sample_idx int, depth double, sv double, n int, note string")
    got = echo.transient_block(own, 1, 1, below_m=0, block=4)
    assert got.dtypes == [*own.dtypes, ("transient", "boolean")]
    assert sorted(got.select(*own.columns).collect(), key=lambda r: r[1:3]) == sorted(own.collect(), key=lambda r: r[1:3])
    assert [(r.ping_idx, r.sample_idx) for r in got.where("transient").collect()] == [(3, 2)]


def test_schools_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(5)
    x = np.where(rng.random((60, 30)) < 0.45, -50.0, -90.0)
    s = cube(spark, x).withColumn("m", F.col("sv") > -70)
    key = lambda r: (r.channel, r.ping_idx, r.lo, r.hi, r.label)
    for diagonal in (False, True):
        runs = echo.vertical_runs(s, "m").collect()
        # by brute force: spread the least id until nothing changes
        label, wide, more = {r.id: r.id for r in runs}, int(diagonal), True
        pairs = [(a.id, b.id) for a in runs for b in runs if b.ping_idx == a.ping_idx + 1 and a.lo <= b.hi + wide and b.lo <= a.hi + wide]
        while more:
            more = False
            for a, b in pairs:
                least = min(label[a], label[b])
                more |= label[a] != least or label[b] != least
                label[a] = label[b] = least
        want = sorted((r.channel, r.ping_idx, r.lo, r.hi, label[r.id]) for r in runs)
        for block in (1, 7, 256):
            assert sorted(map(key, echo.schools(s, "m", diagonal, block).collect())) == want, (diagonal, block)


def test_windows_of_samples_need_no_exchange(spark):
    """The stand-in is dealt by channel, and its tasks grow with the events."""
    from soundings.plans import standins

    s = standins.samples(spark, "/root/testdata/sf0.001")
    plan = echo.median_3x3(s)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_median_counts_null_as_more_than_any_value(spark):
    x = np.round(noise(3, 14, 11))
    x[np.random.default_rng(4).random(x.shape) < 0.4] = np.nan
    want = np.sort(np.lib.stride_tricks.sliding_window_view(np.pad(x, 1, mode="symmetric"), (3, 3)).reshape(*x.shape, 9), axis=-1)[..., 4]
    out = echo.median_3x3(cube(spark, x))
    assert np.array_equal(back(out.withColumn("sv_median", F.coalesce("sv_median", F.lit(float("nan")))), "sv_median", x.shape), want, equal_nan=True)
    assert out.where("isnan(sv_median)").isEmpty() and out.columns == [*cube(spark, x).columns, "sv_median"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_steps_on_samples_make_no_arrays_and_look_no_farther_than_they_must(spark):
    """A sort of arrays for each sample, and frames that end with the series, took most of the time."""
    own = cube(spark, noise(pings=3, depth=4)).withColumn("m", F.col("sv") > -70)
    assert "array" not in plan(echo.median_3x3(own))
    assert "unboundedfollowing" not in plan(echo.fill_gaps(own, "m", "f", 2, 3))
    assert "currentrow$(), unboundedfollowing" not in plan(echo.box_mean(own, "sv", "b", 1, 1))
    assert plan(echo.morph(own, "m", "e", 0, 1, grow=False)).count("windowspecdefinition") == 2


@pytest.mark.parametrize(("vertical", "horizontal"), [(0, 0), (2, 0), (0, 3), (3, 2)])
def test_gaps_are_filled_as_by_a_loop(spark, vertical, horizontal):
    m = np.random.default_rng(6).random((12, 15)) < 0.35
    df = cube(spark, np.where(m, 1.0, 0.0)).withColumn("m", F.when(F.col("sv") > 0, True))  # NULL elsewhere

    def fill(rows, most):
        out = rows.copy()
        for row, own in zip(rows, out, strict=True):
            at = np.flatnonzero(row)
            for a, z in zip(at, at[1:]):
                own[a:z] |= z - a - 1 <= most
        return out

    want = fill(fill(m, vertical).T, horizontal).T
    got = back(echo.fill_gaps(df, "m", "f", vertical, horizontal).withColumn("f", F.col("f").cast("int")), "f", m.shape)
    assert (got == want).all()


def test_methods_that_share_the_median_go_over_the_samples_once(spark):
    own = cube(spark, _planted()[0])
    methods = {"gradient": {"over_db": 12}, "maximum": {"least_db": -50, "stop_db": -65}}
    lines = echo.seabed_lines(own, methods, 10, 55)
    got = sorted((r["method"], r["ping_idx"], r["seabed"]) for r in lines.collect())
    assert got == sorted((m, r["ping_idx"], r["seabed"]) for m, p in methods.items() for r in echo.seabed(own, m, low=10, high=55, **p).collect()) and {r[0] for r in got} == set(methods)
    assert plan(lines).count("logicalrdd") == 1
