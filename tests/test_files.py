"""Large files: hashes as streams, JSON arrays cut across splits."""

import hashlib
import json
import random

import pytest

from soundings.plans import coverage, definitions
from soundings.sources import csvs, files, navigation


def records(n, seed):
    rng = random.Random(seed)
    names = ["plain", 'with "quotes"', "brace } in", "{ and [ in", "back\\slash\\", '\\"}', "ü {}", "", None, 'ends with "}']
    out = []
    for i in range(n):
        places = [{"lat": rng.uniform(-9, 9), "lon": float(i), "dt": rng.choice(["2024-01-01T00:00:00Z", "no } time", '"'] ), "knt": k / 2} for k in range(rng.choice([0, 1, 2, 9]))]
        own = [("source_path", rng.choice(names)), ("location_data", rng.choice([places, places, None]) if not places else places), ("file_name", rng.choice(names)), ("id", str(i))]
        rng.shuffle(own)
        out.append(dict(own))
    return out


@pytest.mark.parametrize(("split", "indent"), [(300, None), (1 << 20, 2)])
def test_arrays_are_cut_into_records_across_splits(spark, tmp_path, split, indent):
    want = []
    for k in range(3):
        own = records(14, k) if k < 2 else []
        (tmp_path / f"f{k}.json").write_text(json.dumps(own, indent=indent, ensure_ascii=bool(k)) + "\n" * k)
        want += [(r["source_path"], r["file_name"], p["lat"], p["lon"], p["knt"]) for r in own for p in r["location_data"] or []]
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = navigation.read_locations(spark, str(tmp_path)).select("source_path", "file_name", "lat", "lon", "knt").collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_large_files_are_hashed_as_streams(spark, tmp_path):
    with (tmp_path / "large").open("wb") as f:  # sparse: beyond what a row can hold
        f.truncate((2 << 30) + 12345)
        f.seek(1 << 30)
        f.write(b"here")
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "sub dir" / "100% a=b").write_bytes(b"small")
    (tmp_path / "none").write_bytes(b"")  # scans list no empty files
    want = hashlib.sha256()
    with (tmp_path / "large").open("rb") as f:
        while part := f.read(8 << 20):
            want.update(part)
    got = {r.name: (r.sha256, r.length) for r in files.content_hashes(spark, str(tmp_path)).collect()}
    assert got == {"large": (want.hexdigest(), (2 << 30) + 12345), "100% a=b": (hashlib.sha256(b"small").hexdigest(), 5)}


def test_many_small_files_are_written_whole_without_a_folder_for_each(spark, tmp_path):
    rows = [(f"{k % 3}/no {k}%.log", i, None if (k, i) == (7, 2) else f"{k},é{i}") for k in range(40) for i in range(k % 9 + 1)]
    random.Random(1).shuffle(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # files go on from batch to batch
    try:
        own = spark.createDataFrame(rows, "file string, i int, value string")
        assert files.write_text_files(own, f"file://{tmp_path}/logs", "file", ["i"]) == len(rows)
        assert files.write_text_files(own.where("false"), f"file://{tmp_path}/none", "file", ["i"]) == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    found = {str(f.relative_to(tmp_path / "logs")): f.read_text() for f in (tmp_path / "logs").rglob("*") if f.is_file()}
    want = {}
    for name, _, v in sorted(rows, key=lambda r: r[:2]):
        want[name] = want.get(name, "") + (v or "") + "\n"
    assert found == want and len(list((tmp_path / "logs").iterdir())) == 3
    assert {r.name: r.sha256 for r in files.content_hashes(spark, str(tmp_path / "logs")).collect()} == {n.split("/")[-1]: hashlib.sha256(t.encode()).hexdigest() for n, t in want.items()}


def test_json_files_follow_the_events_not_the_platforms(spark, tmp_path, monkeypatch):
    own = spark.range(600).selectExpr("id as event_id", "cast(timestamp_seconds(1700000000 + 7 * id) as timestamp_ntz) as ts", "id % 300 as user_id", "'view' as event_type", "id * 0.5D as value", "'{}' as props")
    own.write.parquet(str(tmp_path / "events.parquet"))
    seen, read = [], navigation.read_locations
    monkeypatch.setattr(coverage.navigation, "read_locations", lambda spark, path: seen.append(files.listed(spark, path, "part-*").count()) or read(spark, path))
    monkeypatch.setattr(coverage, "EVENTS", 100)
    got = coverage.src17_json(spark, str(tmp_path)).collect()
    assert 1 < seen[0] <= 6
    assert sorted((r.file_name, r.t, r.knt) for r in got) == sorted((str(i % 300), (1700000000 + 7 * i) * 1_000_000, i / 2) for i in range(600) if i % 7)


def test_parts_of_many_events_are_many_files(spark, tmp_path, monkeypatch):
    own = spark.range(1000).selectExpr("id as event_id", "cast(timestamp_seconds(1700000000 + 7 * id) as timestamp_ntz) as ts", "id % 30 as user_id", "'view' as event_type", "id * 0.5D as value", "'{}' as props")
    own.write.parquet(str(tmp_path / "events.parquet"))
    seen, read = [], csvs.read_geocsv
    monkeypatch.setattr(definitions.csvs, "read_geocsv", lambda spark, path: seen.append(files.listed(spark, path, "part-*").count()) or read(spark, path))
    monkeypatch.setattr(definitions, "EVENTS", 25)
    got = definitions.src02_geocsv(spark, str(tmp_path)).collect()
    assert seen[0] >= 40
    assert sorted(map(tuple, got)) == sorted((str(i), r, str(i % 4), 4) for i, r in [(int(g.event_id), g.latitude) for g in got]) and {int(g.event_id) for g in got} == set(range(1000))


def test_a_header_meets_its_lines_block_by_block(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"sd{k}.csv").write_text("# top: x\n\n" + ("b,a" if k else "a,b") + "\n" + "".join(f"{i},{-i}\n" for i in range(500)))
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    for c, v in zip(before, ("700", "1", "-1"), strict=True):
        spark.conf.set(c, v)
    try:
        found = csvs.Headed(spark, str(tmp_path))
        plan = found.rows._jdf.queryExecution().executedPlan().toString()
        got = found.named(list(found.headers)).select("a", "b").collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sorted((int(r.a), int(r.b)) for r in got) == sorted([(i, -i) for i in range(500)] + [(-i, i) for i in range(500)])
    assert "ShuffledHashJoin [path#" in plan and ", block#" in plan.split("ShuffledHashJoin [path#")[1].split("]")[0]
