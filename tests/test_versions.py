"""Tables replaced in one step, zones found by their directories, snapshots that expire."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from terrace.operators.quality import NotNull
from terrace.operators.snapshots import latest_of_table
from terrace.plans.checks import QualityFailure
from terrace.plans.gold import GOLD_TABLES, build_gold
from terrace.sources import versions
from terrace.sources.catalog import discover_tables, register_zone
from terrace.sources.files import qualified, read_small, write_new
from terrace.sources.gold import read_gold, stage_gold, write_gold
from terrace.sources.metrics import written_rows
from terrace.sources.retention import expire_snapshots
from terrace.sources.silver import read_silver, write_silver

NOW = "2024-02-01T00:00:00"
HOSPITAL = GOLD_TABLES[0].source


@pytest.fixture
def frame(spark):
    def build(*rows):
        return spark.createDataFrame(rows, "n int, region string")

    return build


def rows_of(spark, root, table="t"):
    return sorted((r["n"], r["region"]) for r in read_gold(spark, str(root), table).collect())


# --- versions ---------------------------------------------------------------


def test_a_reader_sees_the_old_table_or_the_new_one(spark, frame, tmp_path):
    root = str(tmp_path)
    assert write_gold(frame((1, "a"), (2, "b")), root, "t", versioned=True) == 2
    begun = read_gold(spark, root, "t")
    staged = stage_gold(frame((3, "a"), (4, "c"), (5, "c")), root, "t")
    assert rows_of(spark, root) == [(1, "a"), (2, "b")]
    assert staged.publish() == 3
    assert rows_of(spark, root) == [(3, "a"), (4, "c"), (5, "c")]
    # What was planned before goes on with the files it knows.
    assert sorted(map(tuple, begun.collect())) == [(1, "a"), (2, "b")]


def test_a_run_that_dies_before_or_after_the_step_loses_nothing(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_gold(frame((1, "a")), root, "t", versioned=True)
    stage_gold(frame((2, "a")), root, "t")  # and no more
    assert rows_of(spark, root) == [(1, "a")]
    monkeypatch.setattr(versions, "_forget", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        write_gold(frame((3, "b")), root, "t")
    assert rows_of(spark, root) == [(3, "b")]
    monkeypatch.undo()
    write_gold(frame((4, "c")), root, "t")
    assert rows_of(spark, root) == [(4, "c")]


def test_old_versions_go_and_the_one_before_stays(spark, frame, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        write_gold(frame((n, "a"), (n, None)), root, "t", versioned=True)
    kept = sorted(os.listdir(f"{root}/t/_versions"))
    assert [k for k in kept if k.endswith(".json")] == ["0000000003.json", "0000000004.json"]
    assert len([d for d in os.listdir(f"{root}/t") if d.startswith("version=")]) == 2
    assert {tuple(r) for r in read_gold(spark, root, "t").collect()} == {(3, "a"), (3, None)}


def test_regions_are_replaced_beside_those_that_stay(spark, frame, tmp_path):
    root = str(tmp_path)
    write_gold(frame((1, "a/b"), (2, "x"), (3, "it's")), root, "t", versioned=True)
    wider = frame((9, "x")).withColumn("extra", F.lit("e"))
    for n in range(3):
        write_gold(wider.withColumn("n", F.lit(9 + n)), root, "t", replace="regions")
    found = read_gold(spark, root, "t")
    assert sorted((r["n"], r["region"], r["extra"]) for r in found.collect()) == [(1, "a/b", None), (3, "it's", None), (11, "x", "e")]
    database = "versions_test"
    assert register_zone(spark, database, root) == ["t"]
    assert sorted(tuple(r) for r in spark.table(f"{database}.t").select("n", "region").collect()) == [(1, "a/b"), (3, "it's"), (11, "x")]
    write_gold(frame((5, "x"), (6, None)), root, "t")
    register_zone(spark, database, root)
    assert {tuple(r) for r in spark.table(f"{database}.t").select("n", "region").collect()} == {(5, "x"), (6, None)}
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_of_two_runs_the_slower_one_is_refused(spark, frame, tmp_path):
    root = str(tmp_path)
    write_gold(frame((1, "a")), root, "t", versioned=True)
    slow, fast = stage_gold(frame((2, "a")), root, "t"), stage_gold(frame((3, "a")), root, "t")
    fast.publish()
    with pytest.raises(versions.TableChanged):
        slow.publish()
    assert rows_of(spark, root) == [(3, "a")] and not os.path.exists(f"{root}/t/{slow.directory}")


def test_an_empty_table_has_its_columns(spark, frame, tmp_path):
    write_gold(frame((1, "a")), str(tmp_path), "t", versioned=True)
    assert write_gold(frame((1, "a")).limit(0), str(tmp_path), "t") == 0
    found = read_gold(spark, str(tmp_path), "t")
    assert found.columns == ["n", "region"] and found.count() == 0


def test_small_files_are_whole_or_not_there(spark, tmp_path):
    path = f"{tmp_path}/x"
    assert write_new(spark, path, "é1") and not write_new(spark, path, "2")
    assert read_small(spark, path) == "é1" and [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["x"]


def test_failed_checks_leave_gold_as_it_was(spark, hospital_rows, tmp_path):
    root, table = str(tmp_path), GOLD_TABLES[:1]
    suites = {HOSPITAL: [NotNull("date", 0.6)]}
    good = hospital_rows([("2024-01-22", "p", "a", 5, 1, 1, 1)])
    bad = hospital_rows([("2024-01-22", "p", "a", 7, 1, 1, 1), (None, "p", "a", 1, 1, 1, 1)])
    write_silver(good, f"{root}/s", HOSPITAL, "2024-01-22")
    assert build_gold(spark, f"{root}/s", f"{root}/g", NOW, tables=table, suites=suites) == {table[0].name: 1}
    write_silver(bad, f"{root}/s", HOSPITAL, "2024-01-23")
    with pytest.raises(QualityFailure, match="not_null_date"):
        build_gold(spark, f"{root}/s", f"{root}/g", NOW, tables=table, suites=suites)
    assert read_gold(spark, f"{root}/g", table[0].name).first()["total_hospitalized"] == 5
    heads = [d for d in os.listdir(f"{root}/g/{table[0].name}") if d.startswith("version=")]
    assert len(heads) == 1


def test_rows_are_counted_by_the_footers(spark, frame, tmp_path):
    frame((1, "a"), (2, "b")).write.partitionBy("region").parquet(str(tmp_path / "t"))
    assert written_rows(spark, str(tmp_path / "t")) == 2
    assert write_silver(frame((1, "a"), (2, "b"), (2, "b")), str(tmp_path), "s", "2024-01-01") == 3


# --- zones ------------------------------------------------------------------


def test_a_root_may_be_spelled_in_any_way(spark, frame, tmp_path, monkeypatch):
    zone = tmp_path / "lake" / "gold"
    write_gold(frame((1, "a")), str(zone), "deep/t1")
    frame((2, "b")).write.parquet(str(zone / "t2"))
    monkeypatch.chdir(tmp_path)
    for i, root in enumerate((str(zone), f"{zone}/", f"{tmp_path}//lake///gold//", f"file:{zone}", f"file://{zone}/", os.path.relpath(zone, os.getcwd()))):
        if not root.startswith(("/", "file:")):
            # A relative root is resolved by the file system, whose working directory is the JVM's.
            root = os.path.relpath(zone, spark.sparkContext._jvm.java.lang.System.getProperty("user.dir"))
        found = {r["location"]: r["partition_columns"] for r in discover_tables(spark, root).collect()}
        assert found == {"deep/t1": ["region"], "t2": []}, root
        assert register_zone(spark, f"spelled_{i}", root) == ["t1", "t2"]
        assert spark.table(f"spelled_{i}.t1").count() == spark.table(f"spelled_{i}.t2").count() == 1
        spark.sql(f"DROP DATABASE spelled_{i} CASCADE")
    assert qualified(spark, f"{zone}/").startswith("file:/") and not qualified(spark, f"{zone}/").endswith("/")


def test_directories_without_files_are_no_tables(spark, frame, tmp_path):
    for name in ("empty", "keyed/k=1", "late/k=1", "late/k=2", "_hidden/t", "other"):
        os.makedirs(tmp_path / name)
    frame((1, "a")).write.parquet(str(tmp_path / "late/k=2/j=x"))
    frame((1, "a")).write.parquet(str(tmp_path / "_hidden/t/u"))
    (tmp_path / "other" / "a.csv").write_text("x")
    found = {r["location"]: r["partition_columns"] for r in discover_tables(spark, str(tmp_path)).collect()}
    assert found == {"late": ["k", "j"]}
    assert discover_tables(spark, str(tmp_path / "none")).count() == 0


def test_the_newest_snapshot_of_a_table_takes_one_scan(spark, frame, tmp_path):
    for day in ("2023-12-31", "2024-02-09", "2024-02-10"):
        write_silver(frame((int(day[-2:]), "a"), (1, day)), str(tmp_path), "s", day)
    register_zone(spark, "newest_test", str(tmp_path))
    newest = latest_of_table(spark, "newest_test.s")
    assert {(r["n"], r["day"]) for r in newest.collect()} == {(10, "10"), (1, "10")}
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(newest.inputFiles()) < 3 * len(os.listdir(tmp_path / "s"))
    assert all("day=10" in f for f in newest.inputFiles())
    for day in ("2023-12-31", "2024-02-09", "2024-02-10"):
        spark.sql("ALTER TABLE newest_test.s DROP PARTITION (year='{}', month='{}', day='{}')".format(*day.split("-")))
    assert latest_of_table(spark, "newest_test.s").count() == 0
    spark.sql("DROP DATABASE newest_test CASCADE")


# --- retention --------------------------------------------------------------


def test_snapshots_expire_by_their_date(spark, frame, tmp_path):
    root, day = str(tmp_path), dt.date(2024, 5, 1)
    for age in (0, 90, 91, 95, 96, 400):
        write_silver(frame((age, "a")), root, "x/y", day - dt.timedelta(age))
    os.makedirs(f"{root}/_rejected/x/y/year=2023/month=01/day=01")
    os.makedirs(f"{root}/x/y/year=2023/month=02/day=31")
    shutil.copytree(f"{root}/x/y", f"{root}/untouched")

    def status(**more):
        found = expire_snapshots(spark, root, ["x/y", "absent"], day, zone="bronze", grace_days=5, **more).collect()
        return {(day - r["snapshot"]).days: r["status"] for r in found}

    kept = {0: "kept", 90: "kept", 91: "in grace", 95: "in grace"}
    assert status() == kept | {96: "expired", 400: "expired"}
    assert read_silver(spark, root, "x/y", "all").count() == 6
    assert status(dry_run=False) == kept | {96: "removed", 400: "removed"}
    assert sorted(r["n"] for r in read_silver(spark, root, "x/y", "all").collect()) == [0, 90, 91, 95]
    assert status() == kept
    assert not os.path.exists(f"{root}/_rejected/x/y/year=2023/month=01/day=01")
    assert os.path.isdir(f"{root}/x/y/year=2023/month=02/day=31") and os.path.isdir(f"{root}/untouched/year=2023")
    with pytest.raises(ValueError, match="bronze or silver"):
        expire_snapshots(spark, root, ["x/y"], day, zone="gold")
