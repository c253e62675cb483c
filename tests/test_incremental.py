import datetime as dt
import json
import os
import shutil

import pytest

from terrace import lookup
from terrace.layout import snapshot_dir
from terrace.plans.silver import backfill_silver
from terrace.sources.silver import read_silver
from terrace.streaming import incremental, process_new_snapshots

HOSPITAL, WORLD = "sciensano/covid_hospitalizations", "who/global_covid"
NOW = "2024-02-01T00:00:00"


def put(root, source, day, name, text):
    folder = snapshot_dir(root, source, day)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write(text)


def rows(*provinces):
    return json.dumps([{"DATE": "2024-01-15", "PROVINCE": p, "NEW_IN": 1} for p in provinces])


def run(spark, root, source=HOSPITAL, **more):
    return process_new_snapshots(
        spark, source, f"{root}/bronze", f"{root}/silver", f"{root}/seen", NOW, **more
    )


def silver(spark, root):
    return sorted(
        (r["day"], r["province"]) for r in read_silver(spark, f"{root}/silver", HOSPITAL, "all").collect()
    )


def test_new_then_new_then_nothing(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("x", "x", "y"))
    first = run(spark, root)
    assert [(r.rows_read, r.rows_written) for r in first] == [(3, 2)]
    put(f"{root}/bronze", HOSPITAL, "2024-01-16", "a.json", rows("x"))
    second = run(spark, root)
    assert [(r.rows_read, r.rows_written) for r in second] == [(1, 1)]
    assert run(spark, root) == []
    assert silver(spark, root) == [(15, "x"), (15, "y"), (16, "x")]


def test_late_file_is_deduplicated_within_its_snapshot(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("x", "y"))
    put(f"{root}/bronze", HOSPITAL, "2024-01-16", "a.json", rows("x"))
    run(spark, root)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "b.json", rows("y", "z"))
    late = run(spark, root)
    assert [(r.rows_read, r.rows_written) for r in late] == [(4, 3)]
    assert silver(spark, root) == [(15, "x"), (15, "y"), (15, "z"), (16, "x")]


def test_small_batches_lead_to_the_batch_result(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        put(f"{root}/bronze", HOSPITAL, f"2024-01-1{n}", "a.json", rows("x", f"p{n}"))
        put(f"{root}/bronze", HOSPITAL, f"2024-01-1{n}", "b.json", rows("x", f"q{n}"))
    runs = run(spark, root, max_files_per_batch=3, declared=True)
    assert len(runs) > 1
    backfill_silver(spark, HOSPITAL, f"{root}/bronze", f"{root}/whole", NOW, declared=True)
    whole = read_silver(spark, f"{root}/whole", HOSPITAL, "all")
    parts = read_silver(spark, f"{root}/silver", HOSPITAL, "all").select(whole.columns)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0
    assert whole.count() == 12


def test_a_batch_run_again_leaves_the_same_rows(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("x", "y"))
    run(spark, root)
    process_new_snapshots(
        spark, HOSPITAL, f"{root}/bronze", f"{root}/silver", f"{root}/seen-anew", NOW
    )
    assert silver(spark, root) == [(15, "x"), (15, "y")]


def test_csv_source(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", WORLD, "2024-01-15", "data.csv", "Date_reported,New_cases\n2024-01-15,7.9\n")
    run(spark, root, WORLD)
    row = read_silver(spark, f"{root}/silver", lookup(WORLD).name).first()
    assert (row["date_reported"], row["new_cases"]) == ("2024-01-15", 7)


def test_snapshot_that_lost_its_rows_is_emptied(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("x", "y"))
    put(f"{root}/bronze", HOSPITAL, "2024-01-16", "a.json", rows("z"))
    run(spark, root)
    undated = json.dumps([{"DATE": None, "PROVINCE": "x", "NEW_IN": 1}])
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", undated)
    again = backfill_silver(spark, HOSPITAL, f"{root}/bronze", f"{root}/silver", NOW)
    assert (again.rows_read, again.rows_written) == (2, 1)
    assert silver(spark, root) == [(16, "z")]


def test_late_file_with_an_old_time_stamp_and_a_rewritten_file_are_news(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("x"))
    run(spark, root)
    put(f"{root}/bronze", HOSPITAL, "2024-01-16", "a.json", rows("late"))
    late = f"{snapshot_dir(f'{root}/bronze', HOSPITAL, '2024-01-16')}/a.json"
    os.utime(late, (1_500_000_000, 1_500_000_000))
    assert len(run(spark, root)) == 1
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("new"))
    assert len(run(spark, root)) == 1
    assert run(spark, root) == []
    assert silver(spark, root) == [(15, "new"), (16, "late")]


def test_a_removed_file_cleans_its_snapshot_again(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2024-01-15", "2024-01-16"):
        put(f"{root}/bronze", HOSPITAL, day, "a.json", rows("x"))
        put(f"{root}/bronze", HOSPITAL, day, "b.json", rows("y"))
    run(spark, root)
    os.remove(f"{snapshot_dir(f'{root}/bronze', HOSPITAL, '2024-01-15')}/b.json")
    assert [(r.rows_read, r.rows_written) for r in run(spark, root)] == [(1, 1)]
    assert silver(spark, root) == [(15, "x"), (16, "x"), (16, "y")]
    assert run(spark, root) == []
    # Back again under its name: news, as is any other file.
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "b.json", rows("z"))
    run(spark, root)
    assert silver(spark, root) == [(15, "x"), (15, "z"), (16, "x"), (16, "y")]


def test_a_snapshot_of_which_nothing_is_left_stays_in_silver(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("x"))
    put(f"{root}/bronze", HOSPITAL, "2024-01-16", "a.json", rows("y"))
    run(spark, root)
    shutil.rmtree(snapshot_dir(f"{root}/bronze", HOSPITAL, "2024-01-15"))
    assert run(spark, root) == [] and run(spark, root) == []
    assert silver(spark, root) == [(15, "x"), (16, "y")]
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("back"))
    run(spark, root)
    assert silver(spark, root) == [(15, "back"), (16, "y")]
    shutil.rmtree(f"{root}/bronze")
    assert run(spark, root) == [] and silver(spark, root) == [(15, "back"), (16, "y")]


def test_the_ledger_is_compacted_and_says_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "ENTRIES", 3)
    root = str(tmp_path)
    for n in range(5):
        put(f"{root}/bronze", HOSPITAL, f"2024-01-1{n}", "a.json", rows(f"p{n}"))
        if n == 3:
            os.remove(f"{snapshot_dir(f'{root}/bronze', HOSPITAL, '2024-01-11')}/a.json")
        assert len(run(spark, root)) == 1
        held = os.listdir(f"{root}/seen/files")
        assert len(held) <= 2, held
    assert any(h.startswith("whole=") for h in held)
    assert run(spark, root) == [] and len(silver(spark, root)) == 5


def test_one_run_at_a_time_holds_the_checkpoint(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bronze", HOSPITAL, "2024-01-15", "a.json", rows("x"))
    began = dt.datetime.now(dt.UTC) - dt.timedelta(hours=1)
    os.makedirs(f"{root}/seen")
    claim = tmp_path / "seen" / "claim"
    claim.write_text(json.dumps({"run": "other", "began": began.isoformat()}))
    with pytest.raises(incremental.RunInProgress):
        run(spark, root)
    assert claim.exists() and not os.path.exists(f"{root}/silver")
    assert len(run(spark, root, claim_hours=0.5)) == 1
    assert not claim.exists()
