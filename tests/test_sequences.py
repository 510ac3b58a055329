"""Chains, rounds, halo blocks and means before a row, against plain loops; sizes so small that every border is crossed."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundings.operators import bucketed, echo, timejoin, track


def some_track(n, seed, platforms=3, most=50):
    rng, rows = random.Random(seed), []
    for p in range(platforms):
        t, lat, lon = 0, 0.0, 0.0
        for i in range(n if p else 3 * n):
            t += rng.choice([0, 1, 3, 10, most]) * 1_000_000
            lat, lon = lat + rng.uniform(-1, 1.2), lon + rng.uniform(-1, 1)
            rows.append((p, p * 1000 + i, t, lat, lon))
    return rows


SCHEMA = "platform long, event_id long, t long, lat double, lon double"


@pytest.mark.parametrize(("seconds", "bucket"), [(7, 20_000_000), (60, 5_000_000), (1e6, 86_400_000_000), (0.5, 1_000_000)])
def test_chained_buckets_are_those_of_a_loop(spark, seconds, bucket):
    rows, want = some_track(40, 1), []
    for p in {r[0] for r in rows}:
        own, held = sorted((r for r in rows if r[0] == p), key=lambda r: (r[2], r[1])), []
        for r in own:
            if held and r[2] - held[0][2] >= seconds * 1e6:
                want.append(held[len(held) // 2][1])
                held = []
            held.append(r)
        want.append(held[len(held) // 2][1])
    got = track.decimate(spark.createDataFrame(rows, SCHEMA), seconds, tie=["event_id"], bucket_us=bucket)
    assert sorted(r.event_id for r in got.collect()) == sorted(want) and got.columns == SCHEMA.replace(" long", "").replace(" double", "").split(", ")


def kept_by_loop(own, epsilon, spacing):
    def split(a, z):
        far, at = -1.0, None
        cx, cy = own[z][4] - own[a][4], own[z][3] - own[a][3]
        length = math.sqrt(cx * cx + cy * cy)
        for i in range(a + 1, z):
            x, y = own[i][4] - own[a][4], own[i][3] - own[a][3]
            d = abs(cx * y - cy * x) / length if length else math.sqrt(x * x + y * y)
            if d > far:
                far, at = d, i
        return split(a, at) | split(at, z) if far > epsilon else {a, z}

    out, last = [], None
    for i in sorted(split(0, len(own) - 1)):
        lat, lon = map(math.radians, own[i][3:])
        if last is None or 2 * 3440.065 * math.asin(min(1.0, math.sqrt(math.sin((lat - last[0]) / 2) ** 2 + math.cos(lat) * math.cos(last[0]) * math.sin((lon - last[1]) / 2) ** 2))) >= spacing:
            out.append(own[i][1])
            last = lat, lon
    return out


@pytest.mark.parametrize(("chord_rows", "block", "epsilon", "spacing"), [(0, 2, 0.6, 60.0), (5, 3, 0.3, 400.0), (20_000, 4096, 0.3, 100.0)])
def test_simplified_tracks_are_those_of_the_recursion(spark, chord_rows, block, epsilon, spacing):
    rows = some_track(30, 2) + [(9, 9000, 5, 1.0, 1.0), (10, 9100, 1, 1.0, 1.0), (10, 9101, 2, 1.0, 1.0)] + [(11, 9200 + i, i, 2.0, 2.0) for i in range(12)]
    want = [e for p in {r[0] for r in rows} for e in kept_by_loop(sorted((r for r in rows if r[0] == p), key=lambda r: (r[2], r[1])), epsilon, spacing)]
    got = track.simplify(spark.createDataFrame(rows, SCHEMA).repartition(5), epsilon, spacing, ["platform"], chord_rows=chord_rows, block=block)
    assert sorted(r.event_id for r in got.collect()) == sorted(want)


def pings(spark, n=47, channels=2):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(c, 3 * p + c, s, float(10 * s), float(-70 + 15 * rng.standard_normal())) for c in range(channels) for p in range(n) for s in range(20)], "channel long, ping_idx int, sample_idx int, depth double, sv double")


def rows(df):
    return sorted(tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_series_over_pings_do_not_depend_on_blocks(spark):
    s = pings(spark).cache()
    for make in (
        lambda k: echo.attenuated_pings(s, 50, 150, half=4, below_db=1, block=k),
        lambda k: echo.transient_below(s, (100, 190), 30, half=3, over_db=0.5, until_db=0.2, exclude_above=20, block=k),
        lambda k: echo.seabed_composite(s, 20, 150, margin_db=1, least_db=-75, smooth_window=7, jump=1, block=k).select("channel", "ping_idx", "seabed", "detected"),
        lambda k: echo.seabed_morphological(s, 20, 150, least_db=-75, erode=(0, 0), dilate=(0, 1), smooth_window=7, block=k),
    ):
        whole = rows(make(10_000))
        assert whole and rows(make(2)) == whole and rows(make(5)) == whole


def test_smoothing_is_least_squares_at_any_block(spark):
    rng = np.random.default_rng(5)
    values = {g: rng.standard_normal(n) for g, n in (("a", 23), ("b", 7), ("c", 6), ("d", 1))}
    df = spark.createDataFrame([(g, 10 * i, float(v)) for g, own in values.items() for i, v in enumerate(own)], "g string, t long, v double")
    want = []
    for g, own in values.items():
        for i in range(len(own)):
            a = min(max(i - 3, 0), len(own) - 7)
            want.append((g, 10 * i, float(np.polyval(np.polyfit(np.arange(7), own[a : a + 7], 2), i - a)) if len(own) >= 7 else float(own[i])))
    for block in (1, 4, 4096):
        got = sorted(tuple(r) for r in echo.savitzky_golay(df, "v", "s", 7, 2, ["g"], "t", block=block, width=30).select("g", "t", "s").collect())
        assert [r[:2] for r in got] == [r[:2] for r in sorted(want)] and np.allclose([r[2] for r in got], [r[2] for r in sorted(want)])


def test_rolling_frames_cross_blocks(spark):
    df = spark.createDataFrame([("a", i, float(i * i % 7)) for i in range(20)], "g string, t long, v double")
    spread = lambda v: F.array_max(v) - F.array_min(v)
    assert rows(echo.rolling(df, "v", "x", 3, spread, ["g"], "t", block=2, width=4)) == rows(echo.rolling(df, "v", "x", 3, spread, ["g"], "t"))


def test_runs_hand_each_key_over_once(spark):
    df = spark.createDataFrame([(None if k == 3 else k, i) for k in range(6) for i in range(k * 700)], "k long, i long").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = bucketed.by_runs(df, ["k"], ["i"], lambda own: own.iloc[:1].assign(n=len(own), sorted=bool(own["i"].is_monotonic_increasing)), "k long, i long, n long, sorted boolean").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.k is None, r.k, r.i, r.n, r.sorted) for r in got) == [(False, k, 0, 700 * k, True) for k in (1, 2, 4, 5)] + [(True, None, 0, 2100, True)]


def test_model_means_over_the_days_before(spark):
    day, rng = 86_400_000_000, random.Random(7)
    model = [(p, rng.randint(0, 60 * day), rng.choice([None, rng.random()]), rng.random()) for p in "ab" for _ in range(80)]
    left = [(p, rng.randint(-day, 70 * day), i) for i, p in enumerate("abc" * 30)] + [("a", m[1], 1000 + i) for i, m in enumerate(model[:10])] + [("a", m[1] + 10 * day, 2000 + i) for i, m in enumerate(model[:10])]
    got = timejoin.mean_before(spark.createDataFrame(left, "p string, t long, i long"), spark.createDataFrame(model, "p string, t long, x double, y double"), ["p"], ["x", "y"], 10 * day, bucket_us=7 * day // 3)
    for r in got.collect():
        for c, v in ((2, r.x), (3, r.y)):
            own = [m[c] for m in model if m[0] == r.p and r.t - 10 * day <= m[1] <= r.t and m[c] is not None]
            assert (v is None) == (not own) and (v is None or abs(v - sum(own) / len(own)) < 1e-9)
    near = spark.createDataFrame([("a", 5 * day, 9.0, 9.0)], "p string, t long, x double, y double")
    both = timejoin.with_fallback(spark.createDataFrame([("a", 5 * day + 5, 1), ("a", 30 * day, 2), ("c", 0, 3)], "p string, t long, i long"), near, spark.createDataFrame(model, "p string, t long, x double, y double"), ["p"], ["x", "y"], 10)
    assert {r.i: r.source for r in both.collect()} == {1: "in_situ", 2: "model_mean", 3: "none"}


def test_many_short_groups_are_simplified_as_arrays(spark, monkeypatch):
    """Thousands of groups meet the kernels in a few calls, with no frame for each; the rows are those of the loop."""
    rng, rows = random.Random(5), []
    for p in range(1500):
        rows += [(p, p * 100 + i, i * 1_000_000, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(rng.choice([1, 2, 3, 6, 9]))]
    want = sorted(e for p in range(1500) for e in kept_by_loop([r for r in rows if r[0] == p], 0.4, 30.0))
    calls = spark.sparkContext.accumulator(0)
    split, first_away = track._split_here, track._first_away
    monkeypatch.setattr(track, "_split_here", lambda *a: (calls.add(1), split(*a))[1])
    monkeypatch.setattr(track, "_first_away", lambda *a: (calls.add(1), first_away(*a))[1])
    got = track.simplify(spark.createDataFrame(rows, SCHEMA), 0.4, 30.0, ["platform"])
    assert sorted(r.event_id for r in got.collect()) == want and 0 < calls.value < 100
