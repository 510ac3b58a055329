"""Reports, track features and providers on small tables."""

import json

from pyspark.sql import functions as F

from soundings.operators import statistics, track
from soundings.sources import providers, store


def test_report_has_all_sections_and_goes_to_markdown(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 2.0, 5.0, None), ("a", 2, None, 3.0, 7.0, None), (None, 3, -4.0, 9.0, None, None)], "platform string, t long, lat double, lon double, TEMP_SBE37_MEAN double, other double")
    got = {(r.section, r.name): tuple(r)[2:] for r in statistics.dataset_report(df, ["TEMP_SBE37_MEAN", "other"]).collect()}
    assert got["overall", "rows"] == (3, None, None, None, None) and got["overall", "lat"][:3] == (2, -4.0, 1.0)
    assert got["variable", "TEMP_SBE37_MEAN"] == (2, 5.0, 7.0, 6.0, 100 * 2 / 3) and got["variable", "other"] == (0, None, None, None, 0.0)
    assert got["platform", "a"] == (2, 1.0, 2.0, None, None) and got["platform", "none"][0] == 1
    assert sum(v[0] for k, v in got.items() if k[0] == "category") == 2
    lines = [r.value for r in statistics.report_markdown(statistics.dataset_report(df, ["other"]), "Title").orderBy("place").collect()]
    assert lines[0] == "# Title" and lines[1] == "## Overall" and [x for x in lines if x.startswith("## ")] == ["## Overall", "## Platform", "## Variable", "## Category"]
    empty = {(r.section, r.name): r.n for r in statistics.dataset_report(df.limit(0), ["other"]).collect()}
    assert empty["overall", "rows"] == 0 and empty["variable", "other"] == 0


def test_track_features_of_all_kinds(spark):
    rows = [(1, i, 60_000_000 * i, 10.0 + i, 20.0 + i, float(i), "2024-01-01") for i in range(12)]
    df = spark.createDataFrame(rows, "platform long, event_id long, t long, lat double, lon double, value double, day string")
    seg = track.segments(df, 60, tie=["event_id"])
    found = store.track_features(track.segment_summary(seg, ["value"], tie=["event_id"]), track.arrows(seg, tie=["event_id"]), track.day_markers(seg), ["mean_value"], F.lit("x.png"))
    own = [json.loads(r.value) for r in found.collect()]
    kinds = [f["properties"]["type"] for f in own]
    assert kinds.count("segment") == 1 and kinds.count("arrow") == 4 and kinds.count("day_marker") == 2
    line = next(f for f in own if f["properties"]["type"] == "segment")
    assert line["geometry"]["type"] == "LineString" and line["geometry"]["coordinates"][0] == [20.0, 10.0] and line["properties"]["image"] == "x.png" and line["properties"]["mean_value"] == 5.5
    assert {f["properties"]["kind"] for f in own if f["properties"]["type"] == "day_marker"} == {"start", "end"}
    dense = store.density_features(df.withColumn("lat", F.when(F.col("event_id") > 1, F.col("lat") + 1e-9)), {"value": 1}, ["platform", "t"]).collect()
    assert len(dense) == 10 and json.loads(dense[0].value)["geometry"]["coordinates"] == [22.0, 12.0]


def test_providers_by_their_best_sign(spark):
    cases = {
        "sd1030_tpos.csv": (["a"], None, "saildrone", 0.8), "b.csv": (["trajectory", "SOG", "wing_angle"], None, "saildrone", 0.7), "c.csv": (["ship_latitude", "ship_longitude", "iso_time"], "", "r2r", 0.8),
        "d.csv": (["x"], "# source_repository: y", "r2r", 0.4), "PYLOS_1.csv": (["x"], None, "emso", 0.6), "f.csv": (["QV:TEMP"], None, "emodnet", 0.6), "g.csv": (["TEMP", "PSAL"], None, "generic", 0.0),
        "h.csv": (["TEMP", "PSAL", "CPHL"], None, "norsoop", 0.6), "i.csv": (["Temperature", "Conductivity", "Pressure", "Salinity", "SBE63"], None, "oceanlab", 0.3), "j.csv": (["reference_designator"], None, "ooi", 0.7),
        "k.csv": (["variable", "platform_type", "product_doi"], None, "cmems", 0.7), "m.csv": ([], "plocan", "plocan", 0.7),
    }
    heads = spark.createDataFrame([(f, c, m) for f, (c, m, _, _) in cases.items()], "file string, columns array<string>, metadata string")
    assert {r.file: (r.provider, round(r.score, 6)) for r in providers.detect(heads).collect()} == {f: v[2:] for f, v in cases.items()}
    assert providers.detect(heads.drop("metadata"), least=0.75).where("provider <> 'generic'").count() == 2
    own = providers.enrich(spark.createDataFrame([("1.5", "2", "2024-01-01T00:00:00Z", "9")], "ship_latitude string, ship_longitude string, iso_time string, nsv string"), "r2r")
    assert {"latitude", "longitude", "time", "num_satellites"} <= set(own.columns)
