"""Scans, sinks, upserts and incremental ingest on files of the test's own."""

from pyspark.sql import functions as F

from soundings.functions import acoustics, text
from soundings.operators import environment, statistics
from soundings.sources import csvs, logs, store
from soundings.streaming import ingest


def put(tmp_path, name, content):
    (tmp_path / name).write_bytes(content.encode("latin-1"))
    return str(tmp_path)


def test_csv_directory(spark, tmp_path):
    put(tmp_path, "sd1030_tpos_2023.csv", "latitude,longitude,v\n1,2,3\nnan,2,3\n4,5\n6,7,8,9\n8,9,None\n")
    df = csvs.read_csv_directory(spark, str(tmp_path))
    assert sorted(tuple(r) for r in df.collect() if r["v"]) == [(1.0, 2.0, "3", "sd1030_tpos_2023")]
    assert df.count() == 3 and dict(csvs.coerce_by_majority(df, 0.3).dtypes)["v"] == "double" and dict(csvs.coerce_by_majority(df, 0.5).dtypes)["v"] == "string"


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    """One folder with columns in another order, other columns, a ship's position, no position at all, quotes, and a block of ``#`` lines."""
    put(tmp_path, "a-1.csv", "latitude,longitude,TEMP\n1,2,3\n10,20,30,40\n")
    put(tmp_path, "b-2.csv", "\nTEMP,latitude,longitude\n20,5,6\nnan,x,6\n")
    put(tmp_path, "c-3.csv", "time,SAL,x\n7,8,9\n")
    put(tmp_path, "d-4.csv", "ship_latitude,ship_longitude,note\n1,2,\"a, b\"\n,,\n")
    put(tmp_path, "e-5.csv", "# dataset: GeoCSV 2.0\n# k: v\nlongitude,latitude,TEMP\n8,9,#1\n")
    cols = ["platform_id", "latitude", "longitude", "TEMP"]
    got = csvs.read_csv_directory(spark, str(tmp_path)).select(*cols).collect()
    assert sorted(tuple(r) for r in got) == [("1", 1.0, 2.0, "3"), ("2", 5.0, 6.0, "20"), ("5", 9.0, 8.0, "#1")]
    every = csvs.read_csv_directory(spark, str(tmp_path), skip_non_spatial=False)
    assert every.count() == 6 and every.where("SAL = '8' and latitude is null and x = '9'").count() == 1
    valid = csvs.read_validated(spark, str(tmp_path))
    assert sorted((r["platform_id"], r["latitude"], r["ship_latitude"], r["note"]) for r in valid.collect()) == [("1", 1.0, None, None), ("2", 5.0, None, None), ("4", None, "1", "a, b"), ("5", 9.0, None, None)]
    assert csvs.read_validated(spark, str(tmp_path), allow_non_spatial=True).count() == 5


def test_lines_are_numbered_within_their_files(spark, tmp_path):
    """Files larger than a block, and several in one task."""
    for k in range(3):
        put(tmp_path, f"{k}.txt", "".join(f"{k}/{i}\n" if i % 7 else "\n" for i in range(400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("500b", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = csvs.read_text(spark, str(tmp_path))
            assert got.count() == 3 * 342 and got.where("line <> concat(substring(file, 1, 1), '/', line_no)").isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_geocsv(spark, tmp_path):
    put(tmp_path, "a.csv", "# dataset: GeoCSV 2.0\n# field_unit: a: b\nlatitude,longitude\n1,2\n# no: header\n")
    data, head = csvs.read_geocsv(spark, str(tmp_path))
    assert sorted(tuple(r) for r in data.collect()) == [("# no: header", None), ("1", "2")] and head.first()["metadata"] == {"dataset": "GeoCSV 2.0", "field_unit": "a: b"}


def test_units_row_and_snapshot(spark, tmp_path):
    put(tmp_path, "u.csv", "time,TEMP\nUTC,degC\n2024-01-01T00:00:00Z,3.5\n2024-01-02T00:00:00Z,4\n")
    lines = csvs.read_text(spark, str(tmp_path))
    data, units = csvs.read_units_csv(lines)
    assert data.count() == 2 and units.first()["units"] == {"time": "UTC", "TEMP": "degC"}
    snap = csvs.first_snapshot(lines.where("line_no <> 1"), {"time": "time", "TEMP": "t"}, (63.0, 10.0)).first()
    assert (snap["t"], snap["latitude"]) == (3.5, 63.0)


def test_nmea(spark, tmp_path):
    put(tmp_path, "n.txt", "2024-02-17T00:00:00.000000Z $GPGGA,000000.00,3242.39160,N,11714.16410,W,1,10,0.8,10.0,M,,,*33\n2024-02-17T00:00:00.000000Z $GPVTG,54.7,T,,M,10.0,N,18.5,K\nnot a line\n2024-02-17T00:00:01.000000Z $GPGGA,bad\n2024-02-17T00:00:02Z $GPXYZ,1\n")
    lines = csvs.read_text(spark, str(tmp_path))
    one = logs.merge_sentences(logs.read_nmea(lines)).collect()
    assert len(one) == 1
    r = one[0]
    assert abs(r["latitude"] - 32.706527) < 1e-4 and abs(r["longitude"] + 117.236068) < 1e-4 and (r["quality"], r["satellites"], r["hdop"], r["height"]) == (1, 10, 0.8, 10)
    assert abs(r["speed_ms"] - 5.14444) < 1e-9 and logs.nmea_files(lines).first()["is_nmea"]
    assert logs.read_nmea(lines, ["VTG"]).count() == 1


def test_instrument_logs(spark, tmp_path):
    put(tmp_path, "s.txt", "06/14/2022,06:25:23.876, 1500.5\n06/14/2022,06:25:24.876, bad\nx\n")
    assert [r["velocity"] for r in logs.read_sound_velocity(csvs.read_text(spark, str(tmp_path))).collect()] == [1500.5]
    lines = lambda *x: spark.createDataFrame([("f", i, line) for i, line in enumerate(x)], "file string, line_no int, line string")
    r = logs.read_winch(lines("2022-06-14T06:25:23.876888Z \x1e\x0103RD,2022-05-14T16:17:36.502,-0000168,00000000,-00004.8,2839", "junk")).collect()
    assert len(r) == 1 and r[0]["wire_out_m"] == -0.168 and r[0]["device"] == "03RD"
    r = logs.read_fluorometer(lines("06/14/2022,06:25:23.876,\x0006/14/22\t06:25:23\t695\t65\t700", "a,b")).collect()
    assert len(r) == 1 and r[0]["value_2"] == "65"
    r = logs.read_cnv(lines("# name 0 = t090C: Temperature", "# name 1 = c0S/m: Conductivity", "*END*", "  3.5  4.25", "  1.5  bad")).collect()
    assert {(x["row"], x["name"], x["value"]) for x in r} == {(0, "t090C", 3.5), (0, "c0S/m", 4.25), (1, "t090C", 1.5), (1, "c0S/m", None)}


def test_upsert_is_idempotent(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, 5, "c")], "time int, latitude int, v string")
    for _ in range(3):
        store.upsert(spark, path, rows, ["time", "latitude"], ["v"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["a", "c"]
    store.upsert(spark, path, spark.createDataFrame([(3, 1, "d"), (2, 5, "z")], "time int, latitude int, v string"), ["time", "latitude"], ["v"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["a", "c", "d"]


def test_incremental_ingest_reads_each_file_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "cp"))
    make = lambda lo, hi: spark.range(lo, hi).selectExpr("id as time", "id * 2 as v")
    make(0, 10).write.parquet(source)
    for n in (10, 10, 15):
        if n == 15:
            make(5, 15).write.mode("append").parquet(source)
        ingest.append_new_files(spark, source, make(0, 1).schema, target, check, ["time"], ["v"]).awaitTermination()
        assert spark.read.parquet(target).count() == n


def test_units_survive_the_store(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (50.0, 60.0, 4.0), (None, 1.0, 5.0)], "latitude double, longitude double, v double")
    store.write_observations(df, path, [0.0, 10.0, 20.0], [0.0, 10.0, 20.0], {"v": "degC"})
    back = store.read_campaign(spark, path)
    assert back.schema["v"].metadata == {"units": "degC"} and {r["lat_bin"] for r in back.collect()} == {"lat_0_10", "lat_10_20", "nan"}


def test_schema_issues():
    from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

    a = StructType().add("time", "timestamp").add("v", DoubleType())
    b = StructType().add("time", "timestamp").add("v", IntegerType()).add("geometry", "binary")
    assert store.schema_issues(a, b) == ["geometry: missing"]
    assert store.schema_issues(a, StructType().add("time", "timestamp").add("v", StringType())) == ["v: double and string"]


def test_sound_speed_checks(spark):
    f = lambda *x: [F.lit(float(v)) for v in x]
    row = spark.range(1).select(acoustics.speed_mackenzie(*f(25, 35, 1000)).alias("m"), acoustics.speed_chen_millero(*f(40, 40, 1000)).alias("c"), acoustics.absorption_francois_garrison(*f(38, 10, 35, 0, 8, 1490)).alias("a")).first()
    assert abs(row["m"] - 1550.744) < 1e-3  # the published check value
    assert abs(row["c"] - 1731.995) < 2e-3  # the published check value
    assert 0.008 < row["a"] < 0.012


def test_environment_helpers(spark):
    p = spark.createDataFrame([(1, 0.0, 10.0, 35.0), (1, 100.0, 8.0, 35.0)], "k int, depth double, t double, s double")
    r = environment.depth_weighted(p, ["k"], 100.0, 38.0).first()
    lo, hi = 1483.0, 1492.0
    assert lo < r["sound_speed"] < hi and 0.008 < r["absorption"] < 0.012
    got = environment.blended_profile(p.where("depth = 0"), p, ["k"]).collect()
    assert {(r["depth"], r["source"]) for r in got} == {(0.0, "in_situ"), (100.0, "model")}
    cols = spark.createDataFrame([("TEMP",), ("salinity",), ("xyz",)], "name string")
    names = environment.standard_names(cols, spark.createDataFrame([("temp", "sea_water_temperature")], "alias string, target string"), spark.createDataFrame([("sea_water_temperature",), ("sea_water_salinity",), ("sea_surface_salinity",)], "standard string"))
    assert {(r["name"], r["standard_name"], r["confidence"]) for r in names.collect()} == {("TEMP", "sea_water_temperature", 1.0), ("salinity", "sea_water_salinity", 0.85)}


def test_names(spark):
    assert text.snake_case("TempDegC (mean)") == "temp_deg_c_mean" and [text.column_category(n) for n in ("wind_speed", "TEMP_SBE37_MEAN", "SOG", "wave_height", "latitude")] == ["met", "ocean", "nav", "ocean", "other"]
    assert statistics.top_variables(["a", "b", "c"], ["c", "x"], 2) == ["c", "a"]
    rows = spark.createDataFrame([("sd1030_tpos_2023_x.csv",), ("ship-42.csv",)], "n string")
    assert [r[0] for r in rows.select(text.platform_of(F.col("n"))).collect()] == ["sd1030_tpos_2023", "42"]
    assert str(rows.select(text.name_date(F.lit("D20230530-T0102.raw"))).first()[0]) == "2023-05-30"
    assert rows.select(text.lenient_number(F.lit("1,234.5dB"))).first()[0] == 1234.5


def test_providers(spark):
    from soundings.sources import providers

    catalogue = spark.createDataFrame([("ctd", "TEMP"), ("gps", "lat"), ("adcp", "u")], "sensor string, variable string")
    assert {r[0] for r in providers.sensors_present(["TEMP", "lat", "x"], catalogue).collect()} == {"ctd", "gps"}
    assert text.categories(["HDG", "x"]) == {"HDG": "nav", "x": "other"}
    providers.register(providers.Provider("mine", ("a", "b"), {"a": "time"}))
    heads = spark.createDataFrame([("f", ["a", "b"]), ("g", ["q"])], "file string, columns array<string>")
    assert {tuple(r)[:2] for r in providers.recognise(heads).collect()} == {("f", "mine"), ("g", "generic")}
    own = providers.enrich(spark.createDataFrame([("2024-01-01T00:00:00Z", 1)], "a string, b int"), "mine")
    assert str(own.first()["time"]) == "2024-01-01 00:00:00"
