"""Odd CSV, campaign folders, footers and the key index."""

import json
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from soundings.functions.text import csv_cells, named_cells
from soundings.operators import environment, statistics
from soundings.functions.geo import points
from soundings.sources import csvs, geoparquet, keyindex, navigation, store


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("text") and df._jdf.queryExecution().sparkPlan().toString().count("FileScan")


def test_scans_do_not_grow_with_headers(spark, tmp_path):
    for i in range(12):
        head = [f"x{i}", "latitude", *(["longitude"] if i != 3 else []), f"y{i % 4}"]
        (tmp_path / f"sd10{i:02d}_a_2023.csv").write_text(",".join(head) + "\n" + "".join(",".join(str(100 * i + k) if c != "latitude" else str(k) for c in head) + "\n" for k in range(3)) + "1,2,3,4,5,6,7\n")
    got = csvs.read_csv_directory(spark, str(tmp_path))
    assert scans(got) == 2 and got.count() == 33
    assert {r.platform_id: r.x7 for r in got.where("x7 is not null").collect()} == {"sd1007_a_2023": "702"}
    every = csvs.read_csv_directory(spark, str(tmp_path), skip_non_spatial=False)
    assert scans(every) == 2 and every.count() == 36
    assert dict(every.dtypes)["latitude"] == "double" and every.where("x3 is not null").count() == 3


def test_cells_of_quoted_and_ragged_lines(spark):
    lines = ['a,b,c', '"x, y",2', '1,"say ""hi""",3,4', ',,', '', '"", "q" ,z', 'ü,"ß,",']
    want = [['a', 'b', 'c'], ['x, y', '2'], ['1', 'say "hi"', '3', '4'], ['', '', ''], [''], ['', ' "q" ', 'z'], ['ü', 'ß,', '']]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, v string").select("i", csv_cells(F.col("v")).alias("c"), named_cells(F.array(F.lit("k"), F.lit("l"), F.lit("k")), csv_cells(F.col("v"))).alias("m")).orderBy("i").collect()
    assert [r.c for r in got] == want
    assert got[0].m == {"k": "a", "l": "b"} and got[1].m == {"k": "x, y", "l": "2"} and got[4].m == {"k": "", "l": None}


def test_snapshots_and_units_take_odd_rows(spark):
    rows = [("f", 0, "time,TEMP,note"), ("f", 1, 'UTC,degC,"a, b"'), ("f", 2, '2024-01-01,7.5,"n, m",9'), ("f", 3, "2024-01-02"), ("g", 0, "time,TEMP"), ("g", 1, "2024-01-01")]
    lines = spark.createDataFrame(rows, "file string, line_no long, line string")
    data, units = csvs.read_units_csv(lines.where("file = 'f'"))
    assert [r.fields for r in data.orderBy("line_no").collect()] == [{"time": "2024-01-01", "TEMP": "7.5", "note": "n, m"}, {"time": "2024-01-02", "TEMP": None, "note": None}]
    assert units.first().units == {"time": "UTC", "TEMP": "degC", "note": "a, b"}
    snap = csvs.first_snapshot(lines.where("line_no <> 1 or file = 'g'"), {"time": "time", "TEMP": "t"}, (1.0, 2.0)).orderBy("file").collect()
    assert [(r.file, r.time, r.t, r.latitude) for r in snap] == [("f", "2024-01-01", 7.5, 1.0), ("g", "2024-01-01", None, 1.0)]


def test_campaign_scan_leaves_catalogues_out(spark, tmp_path):
    path = str(tmp_path / "camp aign")
    spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, lat_bin string, v double").write.partitionBy("lat_bin").parquet(path)
    spark.createDataFrame([(3, "b", "new")], "id int, lat_bin string, w string").write.mode("append").partitionBy("lat_bin").parquet(path)
    spark.createDataFrame([("x",)], "catalogue string").write.parquet(path + "/stac")
    spark.createDataFrame([("x",)], "catalogue string").write.parquet(path + "/stac/items/lat_bin=a")
    got = store.read_campaign(spark, path)
    assert sorted((r.id, r.lat_bin, r.v, r.w) for r in got.collect()) == [(1, "a", 1.0, None), (2, "b", 2.0, None), (3, "b", None, "new")]
    assert store.read_campaign(spark, path, ["w", "id", "nothing"]).columns == ["w", "id"]
    (tmp_path / "none").mkdir()
    assert store.read_campaign(spark, str(tmp_path / "none")).columns == []


def test_measurement_columns(spark):
    names = ["TEMP_SBE37_MEAN", "RELATIVE_HUMIDITY", "Latitudinal", "HDG_FILTERED_MEAN", "TEMP_SBE37_STDDEV", "x_Std", "A_MIN", "A_MAX", "A_PEAK", "UWND_MEAN", "VWND_X", "WWND_X", "P_WING_A", "WING_A", "HDG", "Sog", "COG", "lower_case", "time", "platform_id", "lat_bin"]
    df = spark.createDataFrame([], ", ".join(f"{n} double" for n in names))
    assert statistics.measurement_columns(df) == ["HDG_FILTERED_MEAN", "Latitudinal", "RELATIVE_HUMIDITY", "TEMP_SBE37_MEAN"]


def test_suffixes_match_by_key(spark):
    names = spark.createDataFrame([("salinity",), ("ity",), ("water_salinity",), ("depth",), ("a_b",)], "name string")
    standard = spark.createDataFrame([("sea_water_salinity",), ("sea_water_practical_salinity",), ("depth",), ("x_a_b",)], "standard string")
    got = environment.standard_names(names, spark.createDataFrame([], "alias string, target string"), standard)
    assert sorted(tuple(r) for r in got.collect()) == [("depth", "depth", 1.0), ("salinity", "sea_water_salinity", 0.85), ("water_salinity", "sea_water_salinity", 0.85)]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


OBSERVED = "latitude double, longitude double, v double, bin string"


def observed(n=50):
    rng = random.Random(1)
    return [(rng.uniform(-60, 60), rng.uniform(-90, 90), float(i), rng.choice(["a", "b", "c/d"])) for i in range(n)] + [(None, 5.0, -1.0, "a"), (1.0, None, -2.0, None)]


def test_footers_hold_the_keys_and_the_box_of_each_file(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(observed(), OBSERVED).repartition(3)
    geoparquet.write_geoparquet(df, path, ["bin"], units={"v": "degC"}, aliases={"v": "temp"}, more={"provider": "x"})
    back = spark.read.parquet(path)
    assert sorted(((r.latitude, r.longitude, r.v, r.bin) for r in back.collect()), key=str) == sorted(observed(), key=str)
    for r in geoparquet.footers(spark, path).collect():
        own = [o for o in observed() if r.file.startswith("bin=" + {"c/d": "c%2Fd", None: "__HIVE_DEFAULT_PARTITION__"}.get(o[3], o[3]) + "/")]
        geo = json.loads(r["keys"]["geo"])
        assert json.loads(r["keys"]["units"]) == {"v": "degC"} and json.loads(r["keys"]["aliases"]) == {"v": "temp"} and r["keys"]["provider"] == "x" and "cf_standard_names" not in r["keys"]
        table = pq.ParquetFile(f"{path}/{r.file}").read()
        if len(own) == table.num_rows and any(o[0] is not None and o[1] is not None for o in own):
            x, y = [o[1] for o in own if o[1] is not None], [o[0] for o in own if o[0] is not None]
            assert geo["columns"]["geometry"]["bbox"] == [min(x), min(y), max(x), max(y)]
        for g, x, y in zip(*(table.column(c).to_pylist() for c in ("geometry", "longitude", "latitude")), strict=True):
            assert g is None if x is None or y is None else (g[:5] == b"\x01\x01\x00\x00\x00" and np.frombuffer(g, "<f8", 2, 5).tolist() == [x, y])
    geoparquet.write_geoparquet(df.limit(5), path, ["bin"], mode="append")
    assert spark.read.parquet(path).count() == 57
    geoparquet.write_geoparquet(df.limit(4), path, [], mode="overwrite")
    assert spark.read.parquet(path).count() == 4 and not list(tmp_path.glob("out/_writing/*"))


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(observed(), OBSERVED)
    geoparquet.write_geoparquet(df, path, ["bin"])
    with pytest.raises(Exception, match="stop here"):
        geoparquet.write_geoparquet(df.withColumn("v", F.when(F.col("v") == 30, F.raise_error(F.lit("stop here")).cast("double")).otherwise(F.col("v"))), path, ["bin"], mode="overwrite")
    assert spark.read.parquet(path).count() == 52 and not list(tmp_path.glob("out/_writing/*"))


def test_points_without_rows():
    assert points(pa.array([], pa.float64()), pa.array([], pa.float64())).to_pylist() == []


def test_a_late_row_opens_the_files_around_it_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "time long, platform string, v double"
    batch = lambda a, z: spark.createDataFrame([(t, f"p{t % 7}", float(t)) for t in range(a, z)], schema).coalesce(1)
    for k in range(6):
        assert store.upsert(spark, path, batch(1000 * k, 1000 * k + 1000), ["time", "platform"], ["v"]) == []
    assert len(keyindex.stored(spark, path)) == 6
    late = spark.createDataFrame([(1500, "p2", 0.0), (5999, "p0", 0.0), (6001, "p0", 1.0), (1500, "other", 0.0)], schema)
    read = store.upsert(spark, path, late, ["time", "platform"], ["v"])
    assert len(read) == 2  # 1500 and 5999; 6001 lies behind all files
    got = spark.read.parquet(path)
    assert got.count() == 6002 and got.where("time = 5999").count() == 1  # p2 was at 1500 and p0 at 5999
    assert store.upsert(spark, path, spark.createDataFrame([(2500, "never", 0.0)], schema), ["time", "platform"], ["v"]) == []


def test_the_index_never_misses(spark, tmp_path):
    path, rng = str(tmp_path / "t"), random.Random(3)
    have = [(rng.choice([None, rng.uniform(0, 100)]), rng.choice([None, "a", "b"]), i) for i in range(400)]
    for k in range(4):
        spark.createDataFrame(have[100 * k : 100 * k + 100], "x double, s string, i int").coalesce(2).write.mode("append").parquet(path)
        if k < 3:  # the last files stay unknown to the index
            keyindex.update(spark, path, ["x", "s"])
    asked = have[5:10] + have[150:153] + [(-5.0, "a", 0), (500.0, None, 0), (None, "c", 0)]
    found = set(keyindex.may_hold(spark, path, spark.createDataFrame(asked, "x double, s string, i int"), ["x", "s"]))
    owners = {r.f for r in spark.read.parquet(path).select("i", F.col("_metadata.file_path").alias("f")).collect() if r.i in (5, 6, 7, 8, 9, 150, 151, 152) or r.i >= 300}
    assert {f.split("/")[-1] for f in owners} <= {f.split("/")[-1] for f in found}
    nothing = keyindex.may_hold(spark, path, spark.createDataFrame([(1000.0, "zz", 0)], "x double, s string, i int"), ["x", "s"])
    assert len(nothing) == len({r.f for r in spark.read.parquet(path).where("i >= 300").select(F.col("_metadata.file_path").alias("f")).collect()})


def test_a_batch_over_many_files_makes_no_more_rows_than_they_have(spark, tmp_path, monkeypatch):
    path, made = str(tmp_path / "t"), []
    monkeypatch.setattr(keyindex, "LEAST_ROWS", 1)
    for k in range(8):  # each file spans the whole range
        spark.range(k, 1600, 8).coalesce(1).write.mode("append").parquet(path)
    keyindex.update(spark, path, ["id"])
    own = keyindex._probes
    monkeypatch.setattr(keyindex, "_probes", lambda h, bits: made.append(1) or own(h, bits))
    assert len(keyindex.may_hold(spark, path, spark.range(0, 1600, 2), ["id"])) == 8 and not made  # 800 keys in the range of each file of 200 rows
    assert len(keyindex.may_hold(spark, path, spark.createDataFrame([(8,), (16,)], "id long"), ["id"])) < 8 and made
    store.upsert(spark, path, spark.range(0, 1700, 2), ["id"], ["id"])
    assert spark.read.parquet(path).count() == spark.read.parquet(path).distinct().count() == 1650


def test_points_are_read_in_either_byte_order():
    raw = [None, b"", b"\x01" * 20, points(pa.array([1.5]), pa.array([-2.5]))[0].as_py(), b"\x00\x00\x00\x00\x01" + np.array([3.5, 4.5], ">f8").tobytes(), b"\x01\x01\x00\x00\x00" + np.array([5.5, 6.5], "<f8").tobytes() + b"more"]
    column = pa.array([b"x" * 30, *raw], pa.binary()).slice(1)
    assert navigation._ordinate(column, 5).to_pylist() == [None, None, None, 1.5, 3.5, 5.5]
    assert navigation._ordinate(column, 13).to_pylist() == [None, None, None, -2.5, 4.5, 6.5]
    assert navigation._ordinate(column.slice(0, 2), 5).to_pylist() == [None, None]


def test_campaign_of_catalogues_alone_is_empty(spark, tmp_path):
    spark.createDataFrame([("x",)], "catalogue string").write.parquet(str(tmp_path / "c/stac/items"))
    assert store.read_campaign(spark, str(tmp_path / "c")).columns == []
    store.write_routed(spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, campaign_id string"), str(tmp_path / "r"))
    assert sorted((r.id, r.campaign_id) for r in store.read_campaign(spark, str(tmp_path / "r")).collect()) == [(1, "a"), (3, "b")]
