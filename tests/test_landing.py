import json
import os
import random
import re
import subprocess
import sys
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from terrace import lookup
from terrace.registry import JSON_LINES, landing_specs
from terrace.sources import landing
from terrace.sources.bronze import read_bronze
from terrace.sources.documents import read_documents
from terrace.sources.landing import RESULT, land, landing_status, missing_sources, read_rejected
from terrace.sources.manifests import (
    manifest_entries,
    read_manifests,
    run_summary,
    write_manifest,
)

HOSPITAL, WORLD = "sciensano/covid_hospitalizations", "who/global_covid"
DAY = "2024-01-15"


def drop(root, source, name, text):
    os.makedirs(f"{root}/{source}", exist_ok=True)
    with open(f"{root}/{source}/{name}", "w", encoding="utf-8") as out:
        out.write(text)


def records(n, start=0):
    return [{"DATE": DAY, "PROVINCE": f"Liège {i}", "TOTAL_IN": i} for i in range(start, start + n)]


def csv_text(n, start=0):
    lines = [f'{DAY},BE,"Country, {i}",EURO,{i}' for i in range(start, start + n)]
    return "\n".join(["Date_reported,Country_code,Country,WHO_region,New_cases", *lines]) + "\n"


def texts_under(folder, read=True):
    landed = sorted(f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("part-"))
    if not read:
        return [f for f in landed if os.path.getsize(f)]
    texts = [open(f, encoding="utf-8", newline="").read() for f in landed]
    return [t for t in texts if t]


def outcome(frame):
    return {r["source"]: (r["status"], r["key"], r["error"]) for r in frame.collect()}


def test_files_land_unchanged_and_a_rerun_replaces_them(spark, tmp_path):
    text = json.dumps(records(3), ensure_ascii=False, indent=2)
    drop(tmp_path / "in", HOSPITAL, "a.json", text)
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        found = outcome(land(spark, [lookup(HOSPITAL)], str(tmp_path / "in"), bronze, DAY))
    key = f"{bronze}/{HOSPITAL}/year=2024/month=01/day=15"
    assert found == {HOSPITAL: ("success", key, None)}
    landed = texts_under(key)
    assert len(landed) == 1 and json.loads(landed[0]) == records(3)
    # The text of every record is kept.
    assert [r for r in re.findall(r"\{[^}]*\}", landed[0])] == re.findall(r"\{[^}]*\}", text)


def test_each_file_stays_a_document_of_its_own(spark, tmp_path):
    for i in range(5):
        drop(tmp_path / "in", HOSPITAL, f"{i}.json", json.dumps(records(2, 2 * i), indent=1))
        drop(tmp_path / "in", WORLD, f"{i}.csv", csv_text(2, 2 * i))
    bronze = str(tmp_path / "bronze")
    land(spark, [lookup(HOSPITAL), lookup(WORLD)], str(tmp_path / "in"), bronze, DAY)
    hospital = read_bronze(spark, lookup(HOSPITAL), bronze, DAY)
    assert sorted(int(r["TOTAL_IN"]) for r in hospital.collect()) == list(range(10))
    world = read_bronze(spark, lookup(WORLD), bronze, DAY)
    assert sorted(int(r["New_cases"]) for r in world.collect()) == list(range(10))


@pytest.mark.parametrize("n", [3, 5000])
@pytest.mark.parametrize("form", ["document", "lines", "csv"])
def test_files_of_every_size_land_alike(spark, tmp_path, form, n):
    spec = lookup(HOSPITAL)
    if form == "document":
        text = json.dumps([{"DATE": DAY, "N": 1.50, "X": " x "}] * n) + "\n[{}]"
    elif form == "lines":
        spec = replace(spec, options=JSON_LINES)
        text = "\n".join(json.dumps(r, ensure_ascii=False) for r in records(n))
    else:
        spec, text = lookup(WORLD), "Date_reported,Country\n" + f'{DAY}, x ,surplus\n{DAY},\n' * n
    drop(tmp_path / "in", spec.name, "file", text)
    bronze = str(tmp_path / "bronze")
    found = outcome(land(spark, [spec], str(tmp_path / "in"), bronze, DAY))
    key = found[spec.name][1]
    texts = texts_under(key)
    if form == "lines":
        assert sorted("".join(texts).splitlines()) == sorted(text.splitlines())
    elif form == "csv":
        assert texts == [text]
    else:
        found = [r for t in texts for r in json.loads(t)]
        assert found == [{"DATE": DAY, "N": 1.5, "X": " x "}] * n
        assert [(r["record"], r["reason"]) for r in read_rejected(spark, bronze, HOSPITAL).collect()] == [
            ("[{}]", "not part of a JSON array or object")
        ]


@pytest.fixture
def small_splits(spark):
    """Files are cut every few hundred bytes, as large ones are at block bounds."""
    settings = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_split_csv_keeps_its_header_in_every_file(spark, tmp_path, small_splits):
    texts = [csv_text(200), "\ufeff" + csv_text(1, 200), "\n  \n" + csv_text(50, 201), csv_text(0), ""]
    for i, text in enumerate(texts):
        drop(tmp_path / "in", WORLD, f"{i}.csv", text)
    bronze, spec = str(tmp_path / "bronze"), lookup(WORLD)
    found = outcome(land(spark, [spec], str(tmp_path / "in"), bronze, DAY))
    landed = texts_under(found[WORLD][1])
    assert len(landed) > 10 and all(t.startswith("Date_reported,") and t.count("Date_reported") == 1 for t in landed)
    rows = read_bronze(spark, spec, bronze, DAY)
    assert sorted(int(r["New_cases"]) for r in rows.collect()) == list(range(251))

    drop(tmp_path / "in", WORLD, "7.csv", "Date_reported,Land\n" + f"{DAY},x\n")
    status, _, error = outcome(land(spark, [spec], str(tmp_path / "in"), bronze, DAY))[WORLD]
    assert status == "failed" and error
    assert read_bronze(spark, spec, bronze, DAY).count() == 251


def test_csv_without_rows_leaves_a_snapshot_with_a_header(spark, tmp_path):
    drop(tmp_path / "in", WORLD, "a.csv", csv_text(0))
    bronze = str(tmp_path / "bronze")
    land(spark, [lookup(WORLD)], str(tmp_path / "in"), bronze, DAY)
    rows = read_bronze(spark, lookup(WORLD), bronze, DAY)
    assert rows.columns[0] == "Date_reported" and rows.count() == 0


def random_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rng.choices('ab{}[],:"\\ \u00e9\ud55c\n/\'', k=rng.randrange(12)))
    if kind < 5:
        return rng.choice([None, True, 1.25, -7, 10**20])
    if kind < 7:
        return {f"k{i}{rng.choice(['', '}', chr(34)])}": random_value(rng, depth + 1) for i in range(rng.randrange(4))}
    return [random_value(rng, depth + 1) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("seed", range(3))
def test_documents_cut_anywhere_give_their_records(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    want = []
    for i in range(8):
        found = [{"i": n, "v": random_value(rng)} for n in range(rng.choice([0, 1, 5, 60]))]
        text = json.dumps(found, indent=rng.choice([None, 0, 3]), ensure_ascii=rng.random() < 0.5)
        if i == 0:
            found = [{"whole": random_value(rng), "long": "x}{" * 2000}]
            text = json.dumps(found[0], indent=1)
        drop(tmp_path, "in", f"{i}.json", rng.choice(["", " \n", "\ufeff"]) + text + rng.choice(["", "\n", " \t"]))
        want += [(f"{i}.json", r) for r in found]
    read = read_documents(spark, str(tmp_path / "in"), chunk=rng.choice([1, 100, 5000])).collect()
    assert [r for r in read if r["reason"]] == []
    got = [(r["path"].rsplit("/", 1)[-1], json.loads(r["record"])) for r in read]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_what_is_broken_is_put_aside_with_its_reason(spark, tmp_path):
    broken = {
        "a.json": '[{"A": 1}, {"A": 2',
        "b.json": '[{"A": 3}, 7, "x", null, {"A": tru}, {"A": 4}]',
        "c.json": '{"A": 5} {"A": 6}',
        "d.json": "no json",
        "e.json": '[{"A": 7}] ]} [',
        "f.json": '[{"A": "8',
        "g.json": "[]",
        "h.json": '[{"A": 9},{"A": 10}',
    }
    for name, text in broken.items():
        drop(tmp_path / "in", HOSPITAL, name, text)
    spec, bronze = replace(lookup(HOSPITAL), name=HOSPITAL), str(tmp_path / "bronze")
    assert outcome(land(spark, [spec], str(tmp_path / "in"), bronze, DAY))[HOSPITAL][0] == "success"
    landed = [r["A"] for r in read_bronze(spark, spec, bronze, DAY).collect()]
    assert sorted(map(int, landed)) == [1, 3, 4, 5, 7, 9]
    wrong = read_rejected(spark, bronze, HOSPITAL).collect()
    early, kind, outside = "the document ends before the record does", "not an object", "not part of a JSON array or object"
    assert sorted((r["path"].rsplit("/", 1)[-1], r["record"], r["reason"]) for r in wrong) == [
        ("a.json", '{"A": 2', early), ("b.json", '"x"', kind), ("b.json", "7", kind), ("b.json", "null", kind),
        ("b.json", '{"A": tru}', "not valid JSON"), ("c.json", '{"A": 6}', outside), ("d.json", "no json", outside),
        ("e.json", "]} [", outside), ("f.json", '{"A": "8', early), ("h.json", '{"A": 10}', early),
    ]
    assert {(r["year"], r["month"], r["day"]) for r in wrong} == {(2024, 1, 15)}
    # A landing without faults takes the old ones away.
    for name in broken:
        drop(tmp_path / "in", HOSPITAL, name, '[{"A": 1}]')
    land(spark, [spec], str(tmp_path / "in"), bronze, DAY)
    assert read_bronze(spark, spec, bronze, DAY).count() == 8
    assert not os.path.isdir(f"{bronze}/_rejected/{HOSPITAL}/year=2024/month=01/day=15")


LARGE = """
import sys
from pyspark.sql import SparkSession
from terrace import lookup
from terrace.sources.landing import land
root = sys.argv[1]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.memory", "512m")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.files.maxPartitionBytes", "16m")
         .config("spark.checkpoint.dir", root + "/shared").config("spark.sql.warehouse.dir", root + "/warehouse").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
specs = [lookup("sciensano/covid_hospitalizations"), lookup("who/global_covid")]
for row in land(spark, specs, root + "/in", root + "/bronze", "2024-01-15").collect():
    assert row["status"] == "success", row
"""


def test_files_larger_than_a_row_could_be_land_with_a_small_heap(spark, tmp_path):
    """An array and a CSV of 160 MB each, one line the array, with a heap that holds no such row and its copies."""
    one = json.dumps({"DATE": DAY, "PROVINCE": "Liège", "TEXT": "x{[" * 300}, ensure_ascii=False)
    n = 160_000_000 // len(one)
    drop(tmp_path / "in", HOSPITAL, "a.json", "[" + ",".join([one] * n) + "]")
    drop(tmp_path / "in", WORLD, "a.csv", "Date_reported,Country\n" + (f"{DAY},{'y' * 900}\n" * n))
    done = subprocess.run([sys.executable, "-c", LARGE, str(tmp_path)], capture_output=True, text=True, timeout=600, cwd=os.path.dirname(os.path.dirname(__file__)))
    assert done.returncode == 0, done.stderr[-3000:]
    for source in (HOSPITAL, WORLD):
        spec = lookup(source)
        assert len(texts_under(f"{tmp_path}/bronze/{source}/year=2024/month=01/day=15", read=False)) > 1
        assert read_bronze(spark, spec, str(tmp_path / "bronze"), DAY, declared=True).count() == n


def test_a_failed_landing_keeps_the_snapshot(spark, tmp_path, monkeypatch):
    drop(tmp_path / "in", HOSPITAL, "a.json", json.dumps(records(2)))
    spec, bronze = lookup(HOSPITAL), str(tmp_path / "bronze")
    land(spark, [spec], str(tmp_path / "in"), bronze, DAY)
    failing = F.raise_error(F.lit("no more")).cast("string")
    monkeypatch.setattr(landing, "snapshot_keys", lambda d: {"year": failing, "month": failing, "day": failing})
    assert outcome(land(spark, [spec], str(tmp_path / "in"), bronze, DAY))[HOSPITAL][0] == "failed"
    monkeypatch.undo()
    assert read_bronze(spark, spec, bronze, DAY).count() == 2


def test_one_failed_source_does_not_stop_the_others(spark, tmp_path):
    drop(tmp_path / "in", WORLD, "data.csv", csv_text(1))
    results = land(spark, landing_specs(), str(tmp_path / "in"), str(tmp_path / "b"), DAY)
    found = outcome(results)
    assert len(found) == 6
    assert found[WORLD][0] == "success"
    assert found["sciensano/covid_mortality"][0] == "failed"
    assert "PATH_NOT_FOUND" in found["sciensano/covid_mortality"][2]

    write_manifest(results, str(tmp_path / "b"), DAY, f"{DAY}T02:00:00+00:00", "test")
    write_manifest(results, str(tmp_path / "b"), DAY, f"{DAY}T02:00:00+00:00", "test")
    runs = read_manifests(spark, str(tmp_path / "b"))
    first = runs.first()
    assert (first["run_date"], first["env"], len(first["results"])) == (DAY, "test", 6)
    assert [tuple(r) for r in run_summary(manifest_entries(runs)).collect()] == [(DAY, 1, 6)]


def test_manifests_written_elsewhere_are_read(spark, tmp_path):
    folder = tmp_path / "_manifests" / DAY
    os.makedirs(folder)
    run = {
        "run_date": DAY, "run_timestamp": f"{DAY}T02:00:00+00:00", "env": "dev",
        "results": [
            {"source": WORLD, "status": "success", "key": "k"},
            {"source": "sciensano", "status": "failed", "error": "API timeout"},
        ],
    }
    (folder / "manifest.json").write_text(json.dumps(run, indent=2))
    os.makedirs(tmp_path / "_manifests" / "2024-01-16")
    empty = {**run, "run_date": "2024-01-16", "results": []}
    (tmp_path / "_manifests" / "2024-01-16" / "manifest.json").write_text(json.dumps(empty))
    entries = manifest_entries(read_manifests(spark, str(tmp_path)))
    assert sorted(map(tuple, run_summary(entries).collect())) == [(DAY, 1, 2), ("2024-01-16", 0, 0)]


def test_an_empty_drop_does_not_wipe_the_snapshot(spark, tmp_path):
    drop(tmp_path / "in", HOSPITAL, "a.json", json.dumps(records(2)))
    os.makedirs(tmp_path / "none" / HOSPITAL)
    spec, bronze = lookup(HOSPITAL), str(tmp_path / "bronze")
    land(spark, [spec], str(tmp_path / "in"), bronze, DAY)
    found = outcome(land(spark, [spec], str(tmp_path / "none"), bronze, DAY))
    assert found[HOSPITAL][0] == "failed" and "nothing dropped" in found[HOSPITAL][2]
    assert read_bronze(spark, spec, bronze, DAY).count() == 2


def test_status_of_expected_sources(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "source string")
    landed = spark.createDataFrame([("a",), ("a",), ("z",)], "source string")
    assert sorted(map(tuple, landing_status(expected, landed, "source").collect())) == [
        ("a", "success", None, 2), ("b", "failed", "nothing landed", 0),
    ]
    assert [r[0] for r in missing_sources(expected, landed, "source").collect()] == ["b"]


def test_result_columns():
    assert RESULT.fieldNames() == ["source", "status", "key", "error"]
