"""Time joins and tracks, checked by hand values, numpy and independence of the bucket width."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundings.functions import geo
from soundings.operators import echo, grid, timejoin, track
from soundings.plans import catalog, sequences

MINUTE = 60_000_000


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def walk(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.integers(1, 200, n)) * MINUTE
    rows = [(int(i % 3), i, int(t[i]), float(rng.uniform(-60, 60)), float(rng.uniform(-180, 180)), float(rng.normal())) for i in range(n)]
    return frame(spark, rows, "platform int, event_id int, t long, lat double, lon double, value double")


def test_nearest_with_tolerance(spark):
    ref = frame(spark, [(1, 10 * k * MINUTE, 10 + 0.1 * k) for k in range(5)], "platform int, t long, v double")
    own = frame(spark, [(1, 5 * MINUTE), (1, 26 * MINUTE), (1, 90 * MINUTE), (2, 0)], "platform int, t long")
    got = {(r["platform"], r["t"] // MINUTE): r["match"]["v"] if r["match"] else None for r in timejoin.asof(own, ref, ["platform"], ["v"], "nearest", 600 * 1_000_000).collect()}
    assert got == {(1, 5): 10.0, (1, 26): 10.3, (1, 90): None, (2, 0): None}  # a tie goes backward


def test_interpolation_by_hand(spark):
    ref = frame(spark, [(1, 0, 10.0), (1, 10 * MINUTE, 10.1), (1, 20 * MINUTE, None), (1, 60 * MINUTE, 11.1)], "platform int, t long, v double")
    own = frame(spark, [(1, 5 * MINUTE), (1, 35 * MINUTE), (1, 99 * MINUTE)], "platform int, t long")
    got = {r["t"] // MINUTE: round(r["v"], 6) for r in timejoin.interpolated(own, ref, ["platform"], ["v"]).collect()}
    assert got == {5: 10.05, 35: 10.6, 99: 11.1}
    near = timejoin.interpolated(own, ref, ["platform"], ["v"], 600 * 1_000_000).where("v is null").select("t").collect()
    assert {r["t"] // MINUTE for r in near} == {35, 99}
    ends = {r["t"] // MINUTE: round(r["v"], 6) for r in timejoin.extrapolated(own, ref, ["platform"], "v").collect()}
    assert ends[99] == round(10.1 + (11.1 - 10.1) * 89 / 50, 6)


@pytest.mark.parametrize("bucket", [MINUTE, 1000 * MINUTE, 1 << 60])
def test_buckets_make_no_difference(spark, bucket):
    df = walk(spark)
    sides = df.where("event_id % 4 = 0").select("platform", "t", "value"), df.where("event_id % 4 <> 0").select("platform", "t", "event_id")
    got = sorted((r["event_id"], r["match"]["t"] if r["match"] else None) for r in timejoin.asof(sides[1], sides[0], ["platform"], ["value"], "backward", bucket_us=bucket).collect())
    ref = {}
    for r in sides[0].collect():
        ref.setdefault(r["platform"], []).append(r["t"])
    want = sorted((r["event_id"], max((t for t in ref.get(r["platform"], []) if t <= r["t"]), default=None)) for r in sides[1].collect())
    assert got == want
    seg = sorted((r["event_id"], r["segment"]) for r in track.segments(df, 300, bucket_us=bucket).collect())
    want, last, number = [], {}, {}
    for r in sorted(df.collect(), key=lambda r: r["t"]):
        p = r["platform"]
        number[p] = number.get(p, 0) + (p not in last or r["t"] - last[p] > 300 * MINUTE)
        last[p] = r["t"]
        want.append((r["event_id"], number[p]))
    assert seg == sorted(want)


def test_distance_does_not_depend_on_partitions(spark):
    df = walk(spark)
    a, b = (sorted((r["event_id"], round(r["distance_nmi"], 6)) for r in track.along_track(x, bucket_us=w).collect()) for x, w in ((df, 500 * MINUTE), (df.repartition(7), 1 << 60)))
    assert a == b


def test_great_circle_and_bearing(spark):
    row = spark.range(1).select(
        geo.great_circle_nmi(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("d"), geo.bearing(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("east"), geo.bearing(F.lit(10.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("south"),
    ).first()
    assert abs(row["d"] - 3440.065 * np.pi / 180) < 1e-6 and abs(row["east"] - 90) < 1e-9 and abs(row["south"] - 180) < 1e-9


def test_bin_labels(spark):
    edges = [-10.0, -2.5, 0.0, 10.0]
    rows = frame(spark, [(-99.0,), (-10.0,), (-2.5,), (-2.4,), (0.0,), (5.0,), (None,)], "x double")
    got = [r[0] for r in rows.select(geo.bin_label("lat", geo.right_closed_bin(F.col("x"), edges), edges)).collect()]
    assert got == ["lat_-10_-2.5"] * 3 + ["lat_-2.5_0"] * 2 + ["lat_0_10", "nan"]


def test_point_bytes(spark):
    import struct

    rows = frame(spark, [(1.5, -2.0), (None, 1.0)], "lon double, lat double")
    assert [r[0] for r in rows.select(geo.point_wkb(F.col("lon"), F.col("lat"))).collect()] == [bytearray(struct.pack("<BIdd", 1, 1, 1.5, -2.0)), None]


def test_smoothing_equals_a_local_fit(spark):
    x = np.random.default_rng(3).normal(size=30)
    df = frame(spark, [(1, i, float(v)) for i, v in enumerate(x)], "k int, t int, v double")
    got = [r["s"] for r in echo.savitzky_golay(df, "v", "s", 7, 2, ["k"], "t").orderBy("t").collect()]
    for i in range(30):
        a = min(max(i - 3, 0), 23)
        fit = np.polyfit(np.arange(a, a + 7), x[a : a + 7], 2)
        assert abs(np.polyval(fit, i) - got[i]) < 1e-9


def test_simplified_track_keeps_ends_and_corners(spark):
    rows = [(1, 1, k, k, float(min(k, 50)), float(max(0, k - 50))) for k in range(101)]
    df = frame(spark, rows, "platform int, day int, t long, event_id int, lon double, lat double")
    assert {r["event_id"] for r in track.simplify(df, 1e-5, 0.0).collect()} == {0, 50, 100}


def test_capped_points_keep_ends(spark):
    df = frame(spark, [(1, k) for k in range(100)], "platform int, t long")
    got = sorted(r["t"] for r in track.capped_points(df, 5, ["platform"], ["t"]).collect())
    assert got == [int(np.floor(i * 99 / 4)) for i in range(5)]


def two_days(spark, path):
    """Ten events on each of two days, on one straight line."""
    at = "timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id div 10 as int), 0, cast(id % 10 as int))"
    spark.range(20).selectExpr("id as event_id", "1L as user_id", f"{at} as ts", "1.0 as value", "'x' as event_type").write.parquet(f"{path}/events.parquet")
    return str(path)


def test_day_segments_count_every_row(spark, tmp_path, monkeypatch):
    capped = track.capped_points
    monkeypatch.setattr(track, "capped_points", lambda df, most, by, order: capped(df, min(most, 3), by, order))
    assert [r["n_points"] for r in catalog.snk10_day_segments(spark, two_days(spark, tmp_path)).collect()] == [10, 10]


def test_simplified_query_takes_a_track_day_as_the_group(spark, tmp_path):
    out = sequences.win19_simplified(spark, two_days(spark, tmp_path))
    assert out.columns == ["platform", "event_id"] and sorted(r["event_id"] for r in out.collect()) == [0, 9, 10, 19]


def test_ranked_values_are_exact(spark):
    rng = np.random.default_rng(0)
    for values in (rng.normal(size=500), np.round(rng.normal(size=500), 1), np.full(20, 3.5), np.array([1.0, 1.0 + 1e-15, 1e300, -1e300])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        for rank in (0, len(values) // 3, len(values) - 1):
            assert grid.ranked_value(df, "v", rank, parts=7) == np.sort(values)[rank]


def test_places_and_neighbours_cross_buckets(spark):
    """Rows days apart, many in one day, and blocks smaller than the track."""
    rng = np.random.default_rng(1)
    t = np.sort(np.concatenate((rng.integers(0, 40, 30) * 86_400_000_000, rng.integers(0, 1000, 60))))
    rows = [("a", int(x), i, float(rng.normal()), float(rng.normal())) for i, x in enumerate(t)]
    df = spark.createDataFrame(rows, "platform string, t long, event_id long, lat double, lon double")
    got = {r["event_id"]: r["place"] for r in track.in_time_order(df).collect()}
    assert got == {i: i for i in range(len(t))}
    lat, lon = (np.array([r[k] for r in rows]) for k in (3, 4))
    far = lambda v, i: abs(v[i] - np.median(np.concatenate((v[max(0, i - 4) : i], v[i + 1 : i + 5])))) > 0.5
    out = {r["event_id"]: r["outlier"] for r in track.position_outliers(df, 0.5, order=["t", "event_id"]).collect()}
    assert out == {i: far(lat, i) or far(lon, i) for i in range(len(t))}


def test_extrapolation_beyond_close_fixes_equals_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from soundings.plans import queries

    start = dt.datetime(2024, 1, 1)
    rows = [(66 * u + i, start + (dt.timedelta(microseconds=i * 77777777) if i < 4 else dt.timedelta(days=20, microseconds=(i - 4) * (3 + u))), u, "view" if i >= 4 else "click", float((7 * u + 13 * i) % 509) + 0.29, "{}") for u in range(120) for i in range(7)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(tuple(r) for r in queries.QUERIES["join06_extrapolated"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.sql(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert got == sorted(con.sql(queries.SQL["join06_extrapolated"]).fetchall())


def test_extrapolation_from_a_single_fix_equals_sql(spark, tmp_path):
    """Platforms with no, one and two fixes; rows before, at and after them."""
    duckdb = pytest.importorskip("duckdb")
    from soundings.plans import queries

    start = dt.datetime(2024, 1, 1)
    rows = [(10 * u + i, start + dt.timedelta(days=i), u, "view" if 4 <= i < 4 + u else "click", 35.08 + i, "{}") for u in range(3) for i in range(10)]
    rows += [(30, start + dt.timedelta(days=4), 1, "click", 1.0, "{}")]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(tuple(r) for r in queries.QUERIES["join06_extrapolated"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.sql(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert got == sorted(con.sql(queries.SQL["join06_extrapolated"]).fetchall())
    assert {v for e, v in got if 10 <= e < 20 or e == 30} == {39.08}
